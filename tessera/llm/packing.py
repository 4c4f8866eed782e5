"""Best-fit packing of tokenised documents by bin completion.

Tokens are counted where the documents are. Packing itself needs only how many
pieces there are of each length, a table of at most ``capacity`` rows whatever
the corpus, so the search runs on that histogram and finds *fillings* with a
number of copies. Pieces are then dealt to the fillings' places by their rank
among pieces of equal length, as joins.
"""

from __future__ import annotations

import bisect
import random
import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BUCKETS, arrow_rows, ordered_buckets, ranked, stored

assert array("I").itemsize == 4 and sys.byteorder == "little"

CAPACITY = 4096
END_ID = 1
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


class WordIds:
    """Token ids of words as little-endian bytes, with a bounded cache.

    The vocabulary drops white space and never joins across it, so a text's
    ids are the ids of its blank-separated words, one after the other. It
    lower-cases, and cuts between letters and signs, so words are stored in
    lower case and without the comma or stop behind them.
    """

    #: a sign before a comma or stop: both may belong to one run of signs
    SIGNS = re.compile(r"[\W_][,.] ")

    def __init__(self, path: str, max_words: int = 300_000):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.max_words, self.seen = Tokenizer.from_file(path), max_words, {}
        self.model = self.tokenizer.model
        # how the vocabulary writes each byte of a letter
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x180)}

    def learn(self, words: list[str]) -> None:
        """Adds the ids of new words.

        Words of plain lower-case letters are one unit for the vocabulary and go
        to its model as they are; others take the tokenizer's whole way.
        """
        rest = []
        for w in words:
            if w.isalpha() and w.islower() and max(w) < "\u0180" and w == w.lower():
                plain = w if w.isascii() else w.translate(self.written)
                self.seen[w] = array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()
            else:
                rest.append(w)
        if not rest:
            return
        found = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
        ids = [array("I") for _ in rest]
        for i, word in zip(found.ids, found.word_ids, strict=True):
            ids[word].append(i)
        for w, own in zip(rest, ids, strict=True):
            self.seen[w] = own.tobytes()

    def split(self, text: str) -> list[str]:
        if "<|" not in text:  # special tokens are matched as written
            text = text.encode().lower().decode()  # A-Z only
        text = text.replace("\n", " ")
        if not self.SIGNS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def of(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            words = self.split(text)
            try:  # most texts have no new word: one look a word
                ids = b"".join(map(self.seen.__getitem__, words))
            except KeyError:
                if len(self.seen) > self.max_words:
                    self.seen.clear()
                self.learn([w for w in dict.fromkeys(words) if w not in self.seen])
                ids = b"".join(map(self.seen.__getitem__, words))
            yield ids


def token_pieces(docs: DataFrame, vocabulary: Callable[[], str], capacity: int = CAPACITY,
                 end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document (null text: empty)."""

    def rows(cols: dict, words: WordIds) -> dict:
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        end, width = end_id.to_bytes(4, "little"), 4 * capacity
        texts = [t or "" for t in cols[text_col]]
        for doc, ids in zip(cols[id_col], words.of(texts), strict=True):
            ids += end
            for piece, lo in enumerate(range(0, len(ids), width)):
                part = ids[lo:lo + width]
                out["doc_id"].append(doc)
                out["piece"].append(piece)
                out["start"].append(lo // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
        return out

    return arrow_rows(docs, [id_col, text_col], PIECES, rows, text_col=text_col,
                      setup=lambda: WordIds(vocabulary()))


# --- the search, on the histogram of lengths -------------------------------------

class Stock:
    """The pieces left, by length, and which sums the shorter ones can make.

    Bit x of ``sums(i)`` says whether pieces of the ``i`` shortest lengths sum to
    x, so a completion that is looked for is only followed where it exists.
    """

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.counts = {s: n for s, n in histogram.items() if n > 0}
        self.lengths, self.capacity = sorted(self.counts), capacity
        self.at = {s: i for i, s in enumerate(self.lengths)}
        self.mask, self.tables = (1 << capacity + 1) - 1, [1]
        rng = random.Random(0)
        self.marks = {s: rng.getrandbits(64) for s in self.lengths}
        self.state = 0  # a hash of what was taken

    def take(self, size: int, n: int) -> None:
        """Removes ``n`` pieces, or returns them if ``n`` is negative."""
        before = self.counts[size]
        self.counts[size] = before - n
        self.state += n * self.marks[size]
        if min(before, before - n) < self.capacity // size:  # more than fit change no sum
            del self.tables[self.at[size] + 1:]

    def sums(self, i: int) -> int:
        for size in self.lengths[len(self.tables) - 1:i]:
            bits, n, step = self.tables[-1], min(self.counts[size], self.capacity // size), 1
            while n > 0:
                k = min(step, n)
                bits |= bits << k * size & self.mask
                n, step = n - k, 2 * step
            self.tables.append(bits)
        return self.tables[i]

    def exact(self, i: int, target: int) -> Iterator[tuple[int, ...]]:
        """All ways to make ``target`` of the ``i`` shortest lengths, large pieces first."""
        if target == 0:
            yield ()
            return
        for j in range(min(i, bisect.bisect_right(self.lengths, target)) - 1, -1, -1):
            if not self.sums(j + 1) >> target & 1:
                return
            size = self.lengths[j]
            for k in range(min(self.counts[size], target // size), 0, -1):
                if self.sums(j) >> target - k * size & 1:
                    for rest in self.exact(j, target - k * size):
                        yield (size,) * k + rest

    def dominated(self, filling: tuple[int, ...], waste: int) -> bool:
        """Whether a longer piece left could stand for one or two of the filling's or be added."""
        def left(lo: int, hi: int) -> bool:
            sizes = self.lengths[bisect.bisect_left(self.lengths, lo):
                                 bisect.bisect_right(self.lengths, hi)]
            return any(self.counts[s] > filling.count(s) for s in sizes)

        own = sorted(set(filling))
        pairs = {a + b for i, a in enumerate(own) for b in own[i:]
                 if a != b or filling.count(a) > 1}
        return (left(1, waste) or any(left(x + 1, x + waste) for x in own if waste)
                or any(left(x, x + waste) for x in pairs))

    def completions(self, room: int, most_waste: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """(pieces, waste) of the undominated fillings of ``room``, least waste first."""
        top, upto = bisect.bisect_right(self.lengths, room), room
        while True:
            upto = (self.sums(top) & (2 << upto) - 1).bit_length() - 1
            if room - upto > most_waste:
                return
            for filling in self.exact(top, upto):
                yield filling, room - upto
            if upto == 0:
                return
            upto -= 1


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: each length goes to the fullest sequences it fits."""
    opened: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # room -> [(filling, copies)]
    rooms: list[int] = []  # those that are open, ascending
    for size in sorted(histogram, reverse=True):
        n = histogram[size]
        while n > 0:
            at, filling, copies = bisect.bisect_left(rooms, size), (), n
            if at < len(rooms):
                filling, copies = opened[rooms[at]].pop()
            each = min((capacity - sum(filling)) // size, n)
            used = min(copies, n // each)
            if at < len(rooms):
                if used < copies:
                    opened[rooms[at]].append((filling, copies - used))
                elif not opened[rooms[at]]:
                    del opened[rooms.pop(at)]
            n -= used * each
            more = filling + (size,) * each
            room = capacity - sum(more)
            if room not in opened:
                bisect.insort(rooms, room)
            opened.setdefault(room, []).append((more, used))
    return [f for group in opened.values() for f in group]


def fewest(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """A number of sequences that no packing can go below.

    For each length k of at most half a sequence: pieces beyond capacity - k stand
    alone, others beyond the half need a sequence each, and what pieces from k on
    do not find room for there needs more.
    """
    total, half = sum(size * n for size, n in histogram.items()), capacity // 2
    large = sorted(s for s in histogram if s > half)
    n_large = sum(histogram[s] for s in large)
    free = sum((capacity - s) * histogram[s] for s in large)
    small = total - sum(s * histogram[s] for s in large)
    best = max(-(-total // capacity), n_large)
    for k in sorted(s for s in histogram if s <= half):
        while large and large[-1] > capacity - k:
            alone = large.pop()
            free -= (capacity - alone) * histogram[alone]
        best = max(best, n_large - (free - small) // capacity)
        small -= k * histogram[k]
    return best


def plan_fillings(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = 10_000,
                  tries: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, copies)] that use every piece of ``histogram``.

    Bin completion: around the largest piece left stand its undominated fillings,
    least waste first and, of equal waste, large pieces first. The first one is
    an exact best completion; it is taken as often as the counts allow. The best-fit
    packing and the first descent are incumbents. If they need more sequences than
    :func:`fewest`, the search goes back over its choices for a packing that meets
    the bound: a branch ends where its waste exceeds what that number leaves. An
    incumbent that stays above the bound is mended in parts, see :func:`mended`.

    The first descent is never cut short. Each search ends after ``steps`` fillings
    and mending after ``tries`` searches; up to there a search is complete (up to
    a 64-bit hash of the states met). No limit leaves a piece out; what they may
    cost is at most the plan's number of sequences less ``fewest(histogram)``.
    """
    total, bound = sum(size * n for size, n in histogram.items()), fewest(histogram, capacity)
    plan = min(best_fit(histogram, capacity), search(histogram, capacity, None, None),
               key=sequences)
    if sequences(plan) > bound:
        plan = search(histogram, capacity, bound * capacity - total, [steps]) or plan
    rng = random.Random(0)
    for _ in range(tries):
        if sequences(plan) == bound:
            break
        plan = mended(plan, capacity, steps, rng)
    return plan


def sequences(plan: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(copies for _, copies in plan)


def mended(plan: list[tuple[tuple[int, ...], int]], capacity: int, steps: int,
           rng: random.Random, others: int = 10) -> list[tuple[tuple[int, ...], int]]:
    """``plan`` with one sequence less if some of its sequences can be packed anew so, or as it was.

    Chosen are the emptiest sequences, until they waste a whole one, and ``others`` at random.
    """
    left, chosen, waste = Counter(), [], 0
    for filling, copies in plan:
        left[filling] += copies
    for filling in sorted(left, key=sum):
        n = min(left[filling], -(-(capacity - waste) // max(capacity - sum(filling), 1)))
        chosen += [filling] * n
        left[filling] -= n
        waste += n * (capacity - sum(filling))
        if waste >= capacity:
            break
    if waste < capacity:
        return plan
    for filling in rng.sample([f for f in left if left[f]], min(others, len(+left))):
        chosen.append(filling)
        left[filling] -= 1
    pieces = Counter(size for filling in chosen for size in filling)
    spare = (len(chosen) - 1) * capacity - sum(map(sum, chosen))
    if fewest(pieces, capacity) >= len(chosen):
        return plan
    found = search(pieces, capacity, spare, [steps])
    if found is None:
        return plan
    for filling, copies in found:
        left[filling] += copies
    return list((+left).items())


def search(histogram: dict[int, int], capacity: int, spare: int | None,
           steps: list[int] | None) -> list[tuple[tuple[int, ...], int]] | None:
    """Fillings that use all pieces and waste ``spare`` at most; None if none was found.

    Without ``spare`` the first descent, which goes back nowhere. ``steps`` holds
    the number of fillings still to be looked at and is counted down.
    """
    stock = Stock(histogram, capacity)
    failed: set[tuple[int, int]] = set()

    def choices(last: int, spare: int) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(filling, copies, waste, place of the largest length) at the present stock."""
        while last >= 0 and not stock.counts[stock.lengths[last]]:
            last -= 1
        top = stock.lengths[last]
        stock.take(top, 1)
        for rest, waste in stock.completions(capacity - top, spare):
            if steps is not None:
                steps[0] -= 1
                if stock.dominated(rest, waste):
                    if steps[0] <= 0:
                        break
                    continue
            stock.take(top, -1)
            filling = (top, *rest)
            most = min(stock.counts[s] // filling.count(s) for s in set(filling))
            if waste:
                most = min(most, spare // waste)
            for copies in sorted({most, 1}, reverse=True):
                yield filling, copies, waste, last
            stock.take(top, 1)
            if steps is not None and steps[0] <= 0:
                break
        stock.take(top, -1)

    whole = spare if spare is not None else sum(histogram.values()) * capacity
    left = sum(histogram.values())
    plan: list[tuple[tuple[int, ...], int, int]] = []
    if not left:
        return []
    stack = [choices(len(stock.lengths) - 1, whole)]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            failed.add((stock.state, whole))
            if not plan or (steps is not None and steps[0] <= 0):
                return None
            filling, copies, waste = plan.pop()
            for s in set(filling):
                stock.take(s, -copies * filling.count(s))
            left, whole = left + copies * len(filling), whole + copies * waste
            continue
        filling, copies, waste, last = step
        for s in set(filling):
            stock.take(s, copies * filling.count(s))
        left, whole = left - copies * len(filling), whole - copies * waste
        plan.append((filling, copies, waste))
        if not left:
            return [(f, n) for f, n, _ in plan]
        if (stock.state, whole) in failed:
            stack.append(iter(()))
        else:
            stack.append(choices(last, whole))
    return None


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (see :func:`token_pieces`).

    ``pieces`` is stored with a number for each row, by which copies of one piece are
    dealt over buckets. Defined cases: repeated rows are pieces like any other; an
    empty table gives none.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= capacity rows
    histogram = {int(r["length"]): int(r["n"]) for r in found}
    places, sequence, rank = {}, 0, dict.fromkeys(histogram, 0)
    for filling, copies in plan_fillings(histogram, capacity):
        offsets, at = {}, 0
        for size in filling:
            offsets.setdefault(size, []).append(at)
            at += size
        for size, offs in offsets.items():
            n = copies * len(offs)
            places.setdefault(size, []).append((rank[size], rank[size] + n, sequence, offs))
            rank[size] += n
        sequence += copies
    n_pieces = sum(histogram.values())
    rows = pieces.withColumn("__h", F.xxhash64("doc_id", "piece", "ids_crc32"))
    rows = ranked(ordered_buckets(rows, "__h", "__row", n_pieces), ["length"], BUCKETS,
                  ["__h", "doc_id", "piece", "ids_crc32"], "__rank")
    table = spark.createDataFrame(
        list(places.items()), "length long, __places array<struct<lo: long, hi: long, "
                              "sequence: long, offsets: array<long>>>")
    # the table of places has at most `capacity` rows whatever the corpus
    rows = rows.join(F.broadcast(table), "length")
    place = F.element_at(F.filter("__places", lambda p: (p["lo"] <= F.col("__rank"))
                                  & (F.col("__rank") < p["hi"])), 1)
    rows = rows.withColumn("__place", place)
    rows = rows.withColumn("__k", F.size("__place.offsets"))
    nth = F.col("__rank") - F.col("__place.lo")
    return (rows.withColumn("sequence_id", F.col("__place.sequence")
                            + F.expr("(__rank - __place.lo) div __k"))
            .withColumn("offset", F.element_at("__place.offsets",
                                               (nth % F.col("__k") + F.lit(1)).cast("int")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


def pack_documents(docs: DataFrame, vocabulary: Callable[[], str], capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece.

    Defined cases: null and empty texts are one piece of the end id alone;
    null ids and repeated rows are packed like any other; an empty table gives
    no piece; other columns are not read, whatever their names.
    """
    return pack(token_pieces(docs, vocabulary, capacity, id_col=id_col, text_col=text_col), capacity)
