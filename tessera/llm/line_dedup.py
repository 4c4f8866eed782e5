"""Line dedup within a word edit distance that grows with the line's length.

Two lines are near if ``edits(n)`` word edits, n being the words of the longer
one, make them equal: one edit below 20 words, a tenth of the words from there.

Up to 19 words (one edit): a line's variants are the line itself and the line
without any one of its words. Two lines within one word edit share a variant:
without the word at the same place (one replaced), or one line is a variant of
the other (one left out). Variants travel as 128-bit hashes; per variant only
the earliest line is kept, so no pairs are made inside a group; the earliest
line found for a line is verified on the words of both. A pigeonhole comes
first: lines within one edit agree on their first or second half, so only lines
that share a half with another line emit variants.

From 20 words on, variants of whole lines would be too many. An edit changes one
word or gap, so of word pairs no two of which overlap or touch (start at places
next to each other) it breaks one at most, and k edits leave ``SHARED`` of any
k + ``SHARED`` such pairs. A line's marks are its first word pairs (numbered by
occurrence) in one fixed order, up to the one that makes them hold so many apart
from each other: two near lines share ``SHARED`` marks at least. The order puts
rare pairs first, by counters over all long lines; any fixed order gives right
results. A mark travels with its line's form (``LineWords.forms``), which rules out
most lines that meet by chance: what is left of a group of up to ``CLOSE`` lines with
a mark falls into clusters of alike forms, a larger group is one cluster. Lines that
share marks enough are compared by their words: in clusters of up to ``FEW`` lines all
of them, in larger ones each with the cluster's ``FEW`` earliest; lines that are still
without a near line then meet the others of larger clusters by how they differ from one
of these (``met_by_differences``). No line within the bound is lost by it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import _cut, join_checked, release, small_batches, stored
from tessera.llm.set_join import CELL_BITS, CELLS, packed_counters, rarity
from tessera.llm.shingles import POWERS, mix, text_bytes, word_hashes

#: Lines of fewer words must be equal: one word would be too large a part.
MIN_WORDS = 8
#: From twice as many words on, so many words allow one edit.
PER_EDIT = 10
LONG = 2 * PER_EDIT
#: Marks that two near long lines share at least.
SHARED = 2
#: Clusters of so many lines with a common mark are compared line by line at once.
FEW = 16
#: In groups of so many lines with a common mark all forms are compared.
CLOSE = 1000
#: Forms that are compared at once, about.
FORMS_AT_ONCE = 200_000
#: A form has the number of words, up to ``FORM_WORDS``, and below 16 for each of so many cells.
FORM_WORDS = (1 << 12) - 1
FORM_CELLS = 13
#: Lines of so many words have a wide form too: a cell for about so many of their words.
WIDE = 200
WORDS_A_CELL = 12
#: Words of the shorter of two near lines at least, if the longer one is long.
LEAST_LONG = LONG - LONG // PER_EDIT
LEAST_ID = -(2**63)
#: Bytes of text hashed at once, which takes many times as much memory.
PART = 500_000
LINES = "doc long, t long, pos int, h1 long, h2 long, keys array<long>, n int, block int, times binary"
MARKS = "mark long, ref long"
FORMED = f"{MARKS}, form long, wide binary"
MEETINGS = "mark long, a long, b long"
#: Marks that are grouped at once.
MARKS_AT_ONCE = 20_000
#: A task forgets which lines it has given marks of after so many.
REMEMBERED = 200_000
WORDS = "doc long, t long, pos int, words binary, sketch array<long>"
#: Longs of a line's sketch, which has a bit for each of its words.
SKETCH = 4
NEAR = "doc long, t long, pos int, words binary, v1 array<long>, v2 array<long>"
SALTS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


class LineWords:
    """Word hashes of texts, by line, with hashes of any stretch of words."""

    def __init__(self, column: pa.Array) -> None:
        raw, at = text_bytes(column)
        self.words, self.at = word_hashes(raw, at)
        breaks = raw == 10
        # a word's line: how many line ends of its own text come before it
        low = (raw != 32) & ~((raw >= 9) & (raw <= 13)) if len(raw) else breaks
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        begins = low.copy()
        if len(raw):
            begins[1:] &= ~low[:-1] | edge[1:-1]
        seen = np.r_[0, np.cumsum(breaks)]
        first = np.flatnonzero(begins)
        self.text = np.repeat(np.arange(len(at) - 1), np.diff(self.at))
        self.line = seen[first] - seen[at[:-1]][self.text] if len(first) else np.empty(0, np.int64)
        self.n_lines = seen[at[1:]] - seen[at[:-1]] + 1
        new = np.ones(len(first), bool)
        new[1:] = (self.text[1:] != self.text[:-1]) | (self.line[1:] != self.line[:-1])
        self.lo = np.flatnonzero(new)
        self.hi = np.r_[self.lo[1:], len(first)] if len(first) else self.lo
        self.up, self.down = POWERS.to(len(first) + 1)
        self.sums = []
        for salt in SALTS:
            s = np.zeros(len(first) + 1, np.uint64)
            np.cumsum(mix(self.words ^ salt) * self.up[:len(first)], out=s[1:])
            self.sums.append(s)

    def stretch(self, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of words lo..hi, the same wherever the stretch stands."""
        s = self.sums[which]
        return (s[hi] - s[lo]) * self.down[lo]

    def whole(self, which: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix(self.stretch(which, lo, hi) + (hi - lo).astype(np.uint64))

    def variants(self, which: int, lo: int, hi: int) -> np.ndarray:
        """Hashes of the line without its i-th word, for each i."""
        i = np.arange(lo, hi)
        front = self.stretch(which, np.full(hi - lo, lo), i)
        back = self.stretch(which, i + 1, np.full(hi - lo, hi)) * self.up[i - lo]
        return mix(front + back + np.uint64(hi - lo - 1))

    def pairs(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, hash, start, once) of the word pairs of the lines in ``use``.

        A hash numbers its pair by occurrence in its line; ``once``: it has only one.
        """
        n = (self.hi - self.lo)[use]
        line = np.repeat(use, n - 1)
        start = np.arange(len(line)) + np.repeat(self.lo[use] - (np.cumsum(n - 1) - (n - 1)), n - 1)
        pair = self.whole(0, start, start + 2)
        order = np.lexsort((pair, line))
        line, pair, start = line[order], pair[order], start[order]
        new = np.ones(len(pair) + 1, bool)
        new[1:-1] = (pair[1:] != pair[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(new[:-1])
        times = np.arange(len(pair)) - np.repeat(first, np.diff(np.r_[first, len(pair)]))
        return (line, mix(pair + times.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)), start,
                new[:-1] & new[1:])

    def marks(self, use: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, mark): the first pairs of the lines in ``use`` by ``level`` of their counter, then hash."""
        line, pair, start, once = self.pairs(use)
        cell = (pair >> np.uint64(64 - CELL_BITS)).astype(np.int64)
        mark = level[cell].astype(np.uint64) << np.uint64(56) | pair & np.uint64((1 << 56) - 1)
        order = np.lexsort((mark, line))
        line, mark, start, once = line[order], mark[order], start[order], once[order]
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.r_[first, len(line)])
        rank = np.arange(len(line)) - np.repeat(first, sizes)
        # pairs apart from each other: in two rounds those that precede their neighbours in the order
        last = len(line)
        at = np.full(len(self.words) + 2, last)  # by start + 1; a line's last word starts none
        at[start[once] + 1] = rank[once]
        apart = once & (rank < at[start]) & (rank < at[start + 2])
        at[start[apart]] = at[start[apart] + 2] = last
        apart = apart | (at[start + 1] == rank) & (rank < at[start]) & (rank < at[start + 2])
        before = np.cumsum(apart) - apart
        before -= np.repeat(before[first], sizes)
        # the longest line within its bound of n words has 10 / 9 as many, so n // 9 edits
        k = (self.hi - self.lo)[line] // (PER_EDIT - 1)
        keep = (before < k + SHARED) & (rank < 2 * k + SHARED)
        return line[keep], mark[keep]

    def forms(self, use: np.ndarray) -> np.ndarray:
        """Of the lines in ``use``: how many words they have, and, modulo 16, how many in each cell."""
        n = (self.hi - self.lo)[use]
        line = np.repeat(np.arange(len(use)), n)
        at = np.arange(len(line)) + np.repeat(self.lo[use] - (np.cumsum(n) - n), n)
        cell = (mix(self.words[at]) % np.uint64(FORM_CELLS)).astype(np.int64)
        times = np.bincount(line * FORM_CELLS + cell, minlength=len(use) * FORM_CELLS)
        form = np.minimum(n, FORM_WORDS).astype(np.uint64)
        for i, own in enumerate(times.reshape(len(use), FORM_CELLS).T):
            form |= (own & 15).astype(np.uint64) << np.uint64(12 + 4 * i)
        return form

    def wide_forms(self, use: np.ndarray) -> list[bytes | None]:
        """Of the lines in ``use`` that have ``WIDE`` words: how many, and, modulo 16, how many in each cell.

        The number of cells is a power of two; a byte has the cells i and i + half of them.
        """
        out: list[bytes | None] = [None] * len(use)
        for i in np.flatnonzero((self.hi - self.lo)[use] >= WIDE):
            lo, hi = self.lo[use[i]], self.hi[use[i]]
            half = 1 << (int(hi - lo) // WORDS_A_CELL).bit_length() - 1
            cell = (mix(self.words[lo:hi]) % np.uint64(2 * half)).astype(np.int64)
            times = np.bincount(cell, minlength=2 * half) & 15
            out[i] = np.int32(hi - lo).tobytes() + (times[:half] | times[half:] << 4).astype(np.uint8).tobytes()
        return out


def wide_alike(one: bytes, two: bytes) -> bool:
    """``alike`` of two wide forms; that with more cells is folded."""
    n, m = (int(np.frombuffer(x, np.int32, 1)[0]) for x in (one, two))
    a, b = (np.frombuffer(x, np.uint8, offset=4) for x in (one, two))
    a, b = (np.concatenate([x & 15, x >> 4]) for x in (a, b))
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a.reshape(2, -1).sum(0, dtype=np.uint8) & 15
    d = (a - b) & 15
    return int(np.minimum(d, 16 - d).sum()) <= 2 * max(1, max(n, m) // PER_EDIT) - abs(n - m)


def alike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which lines may be within the bound by their forms: all that are, and few others.

    An edit changes one cell by one if it changes the number of words, else two cells.
    """
    n, m = ((x & np.uint64(FORM_WORDS)).astype(np.int64) for x in (one, two))
    longer, apart = np.maximum(n, m), np.abs(n - m)
    left = 2 * np.maximum(1, longer // PER_EDIT) - apart
    for i in range(FORM_CELLS):
        at = np.uint64(12 + 4 * i)
        d = (((one >> at) - (two >> at)) & np.uint64(15)).astype(np.int64)
        left -= np.minimum(d, 16 - d)
    return (left >= 0) & (apart <= np.maximum(1, longer // PER_EDIT)) | (longer == FORM_WORDS)


def alike_pairs(first: np.ndarray, sizes: np.ndarray, form: np.ndarray,
                wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all alike lines in the groups that begin at ``first``."""
    found = [(np.empty(0, np.int64),) * 2]
    has = np.array([x is not None for x in wide], bool)
    for size in np.unique(sizes[sizes > 1]):
        one, two = np.triu_indices(size, 1)
        of_size = first[sizes == size]
        step = max(1, FORMS_AT_ONCE // len(one))
        for lo in range(0, len(of_size), step):
            at = of_size[lo:lo + step, None]
            i, j = (at + one).ravel(), (at + two).ravel()
            near = alike(form[i], form[j])
            for k in np.flatnonzero(near & has[i] & has[j]):
                near[k] = wide_alike(wide[i[k]], wide[j[k]])
            found.append((i[near], j[near]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def clusters(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place that each of ``n`` places is linked with by the links (i, j)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


class NewLines:
    """Which long lines of a batch a task has not met before (it forgets after ``REMEMBERED``)."""

    def __init__(self) -> None:
        self.met: set[int] = set()

    def of(self, x: LineWords) -> tuple[np.ndarray, np.ndarray]:
        """(line, digest) of the new ones."""
        use = np.flatnonzero(x.hi - x.lo >= LEAST_LONG)
        h1 = x.whole(0, x.lo[use], x.hi[use])
        if len(self.met) > REMEMBERED:
            self.met.clear()
        new = np.zeros(len(use), bool)
        for i, h in enumerate(h1.tolist()):
            if h not in self.met:
                new[i] = True
                self.met.add(h)
        return use[new], h1[new]


def _ids(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("doc"),
            F.xxhash64(F.col(text_col).cast("string")).alias("t")]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def line_table(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """One row per line with words: its digest and hashes of its ends; and each task's pair counters.

    Two lines of n and of n or n + 1 words within one edit agree on their first
    or last g(n) words, g(n) being at most half of n. A line gives both ends
    for its own length and for one word less. Lines too short to have
    neighbours give none; long lines have marks instead, and their word pairs
    are counted, as (block, times) in rows where all else is null.
    """
    schema = to_arrow_schema(StructType.fromDDL(LINES))
    g = lambda n: np.maximum(3, n // 4 * 2)

    def run(batches):
        counters, new = np.zeros(CELLS, np.int32), NewLines()
        for batch in batches:
            for part in _cut(batch, "text", PART):
                x = LineWords(part.column(2))
                np.add.at(counters, (x.pairs(new.of(x)[0])[1] >> np.uint64(64 - CELL_BITS))
                          .astype(np.int64), 1)
                lo, hi = x.lo, x.hi
                n, row = hi - lo, x.text[lo]
                ends, have = [], []
                for short in (0, 1):
                    use = (n >= min_words - 1 + short) & ((short == 0) | (g(n) != g(n - 1)))
                    use &= n < LONG
                    size = np.where(use, g(n - short), 0)
                    tag = mix(size.astype(np.uint64) * np.uint64(2))
                    ends += [mix(x.stretch(0, lo, lo + size) + tag),
                             mix(x.stretch(0, hi - size, hi) + tag + np.uint64(1))]
                    have += [use, use]
                have = np.array(have).T
                keys = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(have.sum(1))], pa.int32()),
                    _signed(np.array(ends).T[have]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     pa.array(x.line[lo], pa.int32()), _signed(x.whole(0, lo, hi)),
                     _signed(x.whole(1, lo, hi)), keys, pa.array(n, pa.int32()),
                     pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())],
                    schema=schema)
        yield from packed_counters(counters, schema)
        del counters, new
        release()

    return docs.select(*_ids(docs, id_col, text_col),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, LINES)


def mark_table(texts: DataFrame, levels: bytes) -> DataFrame:
    """(mark, ref, form, wide): the marks of long lines; a line that a task has met before gives none again."""
    schema = to_arrow_schema(StructType.fromDDL(FORMED))
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        level, lines = np.frombuffer(shared.value, np.uint8), NewLines()
        for batch in batches:
            for part in _cut(batch, "text", PART):
                x = LineWords(part.column(0))
                use, h1 = lines.of(x)
                line, mark = x.marks(use, level)
                at = np.searchsorted(use, line)
                yield pa.RecordBatch.from_arrays(
                    [_signed(mark), _signed(h1[at]), _signed(x.forms(use)[at]),
                     pa.array(x.wide_forms(use), pa.binary()).take(pa.array(at))], schema=schema)
        del lines
        release()

    return texts.mapInArrow(run, FORMED)


def meetings(marks: DataFrame) -> DataFrame:
    """Which lines share a mark and have alike forms, in one shuffle of ``marks``.

    Alike lines of a cluster of up to ``FEW`` are a row (null, a, b) each; in a larger
    cluster each line is a row (mark, a, null), with a number of its own for the mark if
    it is not the cluster of the group's first line. A group of more than ``CLOSE`` lines
    is one cluster, and without a form every two lines are alike. A task holds no more
    than it groups at once.
    """
    schema = to_arrow_schema(StructType.fromDDL(MEETINGS))

    def rows(mark, a, b):
        return pa.RecordBatch.from_arrays([mark, pa.array(a), b], schema=schema)

    def crowd(mark, ref):
        return rows(pa.array(mark), ref, pa.nulls(len(ref), pa.int64()))

    def portions(batches):
        own, n = [], 0
        for batch in batches:
            own.append(batch)
            n += len(batch)
            if n >= MARKS_AT_ONCE:
                yield own, False
                own, n = [], 0
        yield own, True

    def run(batches):
        # of the last mark so far, if it has not too many lines
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, object))
        full = None  # the last mark and its last line, if it has
        for own, end in portions(batches):
            held = [np.concatenate([x, *(batch.column(i).to_numpy(zero_copy_only=False).view(x.dtype)
                                         for batch in own)]) for i, x in enumerate(held)]
            mark, ref = held[:2]
            new = np.ones(len(mark), bool)
            new[1:] = (mark[1:] != mark[:-1]) | (ref[1:] != ref[:-1])
            held = mark, ref, form, wide = [x[new] for x in held]
            if full is not None:
                n = int(np.searchsorted(mark, full[0], "right"))
                lo = int(n > 0 and ref[0] == full[1])
                if n > lo:
                    yield crowd(mark[lo:n], ref[lo:n])
                full = (full[0], ref[n - 1]) if n else full
                held = mark, ref, form, wide = [x[n:] for x in held]
            if not len(mark):
                continue
            full = None
            first = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])
            sizes = np.diff(np.r_[first, len(mark)])
            if not end and sizes[-1] > CLOSE:
                full = (mark[-1], ref[-1])
            many = np.repeat(sizes > CLOSE, sizes)
            if many.any():
                yield crowd(mark[many], ref[many])
            keep = first[-1] if not end and full is None else len(mark)
            whole = (sizes <= CLOSE) & (first < keep)
            i, j = alike_pairs(first[whole], sizes[whole], form, wide)
            label = clusters(len(mark), i, j)
            many = np.bincount(label, minlength=len(mark))[label] > FEW
            if many.any():
                number = mix(mark.view(np.uint64) ^ mix(ref[label].view(np.uint64))).view(np.int64)
                number = np.where(label == np.repeat(first, sizes), mark, number)
                yield crowd(number[many], ref[many])
            i, j = i[~many[i]], j[~many[i]]
            if len(i):
                yield rows(pa.nulls(len(i), pa.int64()), ref[i], pa.array(ref[j]))
            held = [x[keep:] for x in held]
        release()

    if "form" not in marks.columns:
        marks = marks.withColumns({"form": F.lit(FORM_WORDS).cast("long"),
                                   "wide": F.lit(None).cast("binary")})
    dealt = marks.repartition("mark").sortWithinPartitions("mark", "ref")
    return dealt.mapInArrow(run, MEETINGS)


def _neighbourhoods(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str,
                    kind: str = NEAR) -> DataFrame:
    """Words and (if ``kind`` has them) variants of the lines (doc, t, pos) in ``wanted``."""
    schema = to_arrow_schema(StructType.fromDDL(kind))
    variants = ((0, "v1"), (1, "v2")) if kind == NEAR else ()
    by_text = stored(wanted.groupBy("doc", "t").agg(F.collect_set("pos").alias("positions")),
                     "wanted")
    texts = join_checked(docs.select(*_ids(docs, id_col, text_col),
                                     F.col(text_col).cast("string").alias("text")),
                         by_text, ["doc", "t"]).select("doc", "t", "text", "positions")

    def run(batches):
        for batch in batches:
            for part in _cut(batch, "text", PART):
                x = LineWords(part.column(2))
                at = {(r, p): i for i, (r, p) in enumerate(zip(
                    x.text[x.lo].tolist(), x.line[x.lo].tolist(), strict=True))}
                out = {f.name: [] for f in schema}
                for r, (doc, t, positions) in enumerate(zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(),
                        part.column(3).to_pylist(), strict=True)):
                    for p in positions:
                        lo, hi = (int(v[at[r, p]]) for v in (x.lo, x.hi))
                        out["doc"].append(doc)
                        out["t"].append(t)
                        out["pos"].append(p)
                        out["words"].append(x.words[lo:hi].tobytes())
                        if kind == WORDS:
                            bits = np.zeros(64 * SKETCH, bool)
                            bits[mix(x.words[lo:hi]) % np.uint64(64 * SKETCH)] = True
                            out["sketch"].append(np.packbits(bits).view(np.int64))
                        for which, name in variants:
                            own = x.whole(which, np.array([lo]), np.array([hi]))
                            out[name].append(np.r_[own, x.variants(which, lo, hi)].view(np.int64))
                        if len(out["doc"]) >= 2000:
                            yield pa.RecordBatch.from_pydict(out, schema=schema)
                            out = {f.name: [] for f in schema}
                yield pa.RecordBatch.from_pydict(out, schema=schema)
        release()

    return texts.mapInArrow(run, kind)


def edits(words: int) -> int:
    """Word edits by which a line may differ from a shorter or equally long one."""
    return max(1, words // PER_EDIT)


def word_distance_within(one: list, two: list, most: int) -> bool:
    """Are two lists of words within ``most`` edits? Furthest places on diagonals."""
    n, m = len(one), len(two)
    if abs(n - m) > most or max(len(set(one).difference(two)), len(set(two).difference(one))) > most:
        return False
    reached: dict[int, int] = {}  # by diagonal j - i, the furthest i with so many edits
    for used in range(most + 1):
        now = {}
        for d in range(-used, used + 1):
            i = max(reached.get(d, -1) + 1, reached.get(d + 1, -1) + 1, reached.get(d - 1, -1)) \
                if used else 0
            i = min(i, n, m - d)
            if i < max(0, -d):
                continue
            while i < n and i + d < m and one[i] == two[i + d]:
                i += 1
            if i == n and i + d == m:
                return True
            now[d] = i
        reached = now
    return False


def _numbered(words: bytes | np.ndarray) -> np.ndarray:
    """Hashes of a line's words (or word pairs), each numbered by occurrence: a set."""
    own = np.sort(np.frombuffer(words, np.uint64))
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    first = np.flatnonzero(new)
    times = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
    return mix(own + times.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def words_within(one: np.ndarray, two: np.ndarray, most: int) -> bool:
    """``word_distance_within``, but first by place and by word pairs, of which an edit changes two."""
    if len(one) == len(two) and (one != two).sum() <= most:
        return True
    if abs(len(one) - len(two)) > most:
        return False
    own, other = (_numbered(mix(x[:-1]) + x[1:]) for x in (one, two))
    if max(len(own), len(other)) - len(np.intersect1d(own, other, assume_unique=True)) > 2 * most:
        return False
    return word_distance_within(one.tolist(), two.tolist(), most)


def _earlier_neighbours(near: DataFrame, min_words: int) -> DataFrame:
    """(line, witness): the earliest line before a short ``line`` within one word edit.

    Lines of ``min_words`` - 1 words take part as the shorter line of a pair only.
    """
    rows = near.select(F.struct("doc", "t", "pos").alias("line"), F.octet_length("words").alias("n"),
                       F.posexplode(F.arrays_zip("v1", "v2")).alias("i", "v"))
    rows = rows.filter((F.col("i") == 0) | (F.col("n") >= 8 * min_words))
    rows = stored(rows.select("line", "i", "v.v1", "v.v2"), "variants")
    # i = 0: the line itself; i > 0: without its i-th word
    place = (rows.groupBy("v1", "v2", "i").agg(F.min("line").alias("first"),
                                               F.max("line").alias("last"))
             .groupBy("v1", "v2").agg(
                 F.min(F.when(F.col("i") == 0, F.col("first"))).alias("whole"),
                 F.min(F.when(F.col("i") > 0, F.col("first"))).alias("part"),
                 F.map_from_entries(F.collect_list(F.when(
                     (F.col("i") > 0) & (F.col("first") < F.col("last")),
                     F.struct("i", "first")))).alias("replaced"),
                 F.min("first").alias("a"), F.max("last").alias("b"))
             .filter("a < b").drop("a", "b"))
    found = rows.join(place, ["v1", "v2"])
    witness = F.when(F.col("i") == 0, F.col("part")).otherwise(
        F.least(F.col("whole"), F.element_at("replaced", F.col("i"))))
    return (found.withColumn("witness", witness).filter("witness < line")
            .groupBy("line").agg(F.min("witness").alias("witness")))


def _verified(pairs: DataFrame, words: DataFrame, min_words: int) -> DataFrame:
    """(line): the lines of ``pairs`` that are within the bound of a witness."""
    side = lambda x: words.select(F.struct("doc", "t", "pos").alias(x),
                                  F.col("words").alias(f"words_{x}"))
    # a line's rows come together, and one witness that is near enough will do
    pairs = pairs.join(side("witness"), "witness").join(side("line"), "line") \
        .select("line.*", "words_line", "words_witness")
    kind = "doc long, t long, pos int"
    schema = to_arrow_schema(StructType.fromDDL(kind))

    def verify(batches):
        last, found = None, False
        for batch in batches:
            keep = []
            ids = zip(*(batch.column(c).to_pylist() for c in ("doc", "t", "pos")), strict=True)
            for line, one, two in zip(ids, batch.column("words_line").to_pylist(),
                                      batch.column("words_witness").to_pylist(), strict=True):
                if line != last:
                    last, found = line, False
                n = max(len(one), len(two)) // 8
                near = not found and n >= min_words and words_within(
                    np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64), edits(n))
                found = found or near
                keep.append(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("doc", "t", "pos")],
                schema=schema)
        release()

    return pairs.mapInArrow(verify, kind).select(F.struct("doc", "t", "pos").alias("line")).distinct()


def met_by_differences(stars: DataFrame, words: DataFrame) -> DataFrame:
    """(x, y): lines that differ from a common centre alike enough to be within the bound of each other.

    ``stars`` has (centre, x, left), lines as (line, n); x are those with ``left``,
    y all of the centre's. Let D be the numbered words in which a line differs
    from the centre. k edits change at most e = 2k words, so lines within k edits
    have all but e of D_x and D_y in common, (|D_x| + |D_y| - e) / 2 at least.
    Ordered by how rarely an element is a difference from this centre, the first
    common one stands at most (|D_x| - |D_y| + e) / 2 deep in D_x, and the other
    way round in D_y. Words that most of a group lack or add come last and bring
    nobody together. Lines with |D_x| + |D_y| <= e need have nothing in common:
    these (other orders of the centre's words) meet by the centre alone.
    """
    kind = "centre struct<line: struct<doc: long, t: long, pos: int>, n: int>, " \
        "x struct<line: struct<doc: long, t: long, pos: int>, n: int>, left boolean, d int, elements array<long>"
    schema = to_arrow_schema(StructType.fromDDL(kind))
    of = lambda x: words.select(F.struct("doc", "t", "pos").alias(f"{x}_line"),
                                F.col("words").alias(f"words_{x}"))
    centres = stored(of("centre").join(stars.select(F.col("centre.line").alias("centre_line")).distinct(),
                                       "centre_line"), "centre_words")
    rows = stars.withColumn("x_line", F.col("x.line")).withColumn("centre_line", F.col("centre.line")) \
        .join(of("x"), "x_line")
    rows = join_checked(rows, centres, ["centre_line"], most_rows=20_000) \
        .select("centre", "x", "left", "words_centre", "words_x")

    def run(batches):
        for batch in batches:
            own = [np.setxor1d(_numbered(one), _numbered(two), assume_unique=True).view(np.int64)
                   for one, two in zip(batch.column("words_centre").to_pylist(),
                                       batch.column("words_x").to_pylist(), strict=True)]
            flat = pa.array(np.concatenate([*own, np.empty(0, np.int64)]))
            at = pa.array(np.r_[0, np.cumsum([len(o) for o in own])], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).cast(schema.field(c).type) for c in ("centre", "x", "left")),
                 pa.array([len(o) for o in own], pa.int32()),
                 pa.ListArray.from_arrays(at, flat).cast(schema.field("elements").type)], schema=schema)
        release()

    rows = stored(rows.mapInArrow(run, kind), "differences")
    each = rows.select("centre", "x", F.explode("elements").alias("element"))
    often = each.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    order = (each.join(often, ["centre", "element"], "left").groupBy("centre", "x")
             .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"),
                                                       "element"))).alias("order")))
    # the longest line within its bound of n words has 10 / 9 as many, so n // 9 edits
    most = F.lit(2) * F.greatest(F.lit(1), F.floor(F.col("x.n") / F.lit(PER_EDIT - 1))).cast("int")
    spread = (rows.select("centre", "x", "left", "d").join(order, ["centre", "x"])
              .select("centre", "x", "left", "d", F.posexplode(F.slice("order", F.lit(1), most + F.lit(1)))
                      .alias("at", "e")).filter("e.often > 1")
              .select("centre", F.col("e.element").alias("element"), "x", "left", "d", "at"))
    alone = rows.filter(F.col("d") <= most).select(
        "centre", F.lit(None).cast("long").alias("element"), "x", "left", "d", F.lit(0).alias("at"))
    spread = stored(spread.union(alone), "spread")
    as_y = spread.select("centre", "element", F.col("x").alias("y"), F.col("d").alias("d_y"),
                         F.col("at").alias("at_y"))
    e = F.lit(2) * F.greatest(F.lit(1), F.floor(F.greatest("x.n", "y.n") / F.lit(PER_EDIT)))
    before = F.col("y.line") < F.col("x.line")
    asking = spread.filter("left")
    more = F.col("d") - F.col("d_y")
    common = (asking.filter("element is not null").join(as_y, ["centre", "element"])
              .filter(before & (F.col("at") * 2 <= more + e) & (F.col("at_y") * 2 <= e - more)))
    apart = (asking.filter("element is null").drop("element")
             .join(as_y.filter("element is null").drop("element"), "centre")
             .filter(before & (F.col("d") + F.col("d_y") <= e)))
    return common.select("x", "y").union(apart.select("x", "y")).distinct()


def _long_near_lines(docs: DataFrame, kinds: DataFrame, counters: DataFrame, min_words: int,
                     id_col: str, text_col: str) -> DataFrame:
    """(line): the long lines within the bound of an earlier one."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    met = stored(meetings(mark_table(texts, rarity(counters))), "marks")
    known = kinds.filter(F.col("n_words") >= LEAST_LONG) \
        .select(F.col("h1").alias("ref"), F.struct("line", F.col("n_words").alias("n")).alias("x"))
    crowds = met.filter("mark is not null").select("mark", F.col("a").alias("ref"))
    crowded = stored(crowds.join(known, "ref").select("mark", "x"), "crowded")
    other = F.col("x").alias("y")
    bound = F.greatest(F.lit(1), F.floor(F.greatest("x.n", "y.n") / F.lit(PER_EDIT)))
    near = (F.col("y.line") < F.col("x.line")) & (F.abs(F.col("x.n") - F.col("y.n")) <= bound)
    both = (F.col("x.line").alias("line"), F.col("y.line").alias("witness"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = stored(pairs.select(*both).distinct(), f"{name}_pairs")
        wanted = pairs.select("line.*").union(pairs.select("witness.*")).distinct()
        words = stored(_neighbourhoods(docs, wanted, id_col, text_col, WORDS)
                       .dropDuplicates(["doc", "t", "pos"]), f"{name}_words")
        # a bit that only one line has is a word that only it has, which costs an edit
        side = lambda x: words.select(F.struct("doc", "t", "pos").alias(x), F.struct(
            F.octet_length("words").alias("n"),
            *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH)]).alias(f"{x}_s"))
        alone = lambda a, b: sum(F.bit_count(F.col(f"{a}_s.s{i}").bitwiseAND(
            F.bitwise_not(F.col(f"{b}_s.s{i}")))) for i in range(SKETCH))
        allowed = F.floor(F.greatest("line_s.n", "witness_s.n") / F.lit(8 * PER_EDIT))
        allowed = F.greatest(F.lit(1), allowed)
        pairs = pairs.join(side("line"), "line").join(side("witness"), "witness") \
            .filter((alone("line", "witness") <= allowed) & (alone("witness", "line") <= allowed)) \
            .select("line", "witness")
        return stored(_verified(stored(pairs, f"{name}_alike"), words, min_words), f"{name}_near")

    # small groups: lines that share marks enough, those in crowded groups counted for both
    hidden = stored(crowds.groupBy("ref").agg(F.count(F.lit(1)).alias("hidden")), "hidden")
    few = met.filter("mark is null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"))
    for at in ("a", "b"):
        few = join_checked(few, hidden.toDF(at, f"h_{at}"), [at], "left")
    more = F.least(F.coalesce("h_a", F.lit(0)), F.coalesce("h_b", F.lit(0)))
    few = few.filter(F.col("met") + more >= F.lit(SHARED)).select("a", "b")
    few = few.join(known.toDF("a", "x_a"), "a").join(known.toDF("b", "x_b"), "b") \
        .select(F.greatest("x_a", "x_b").alias("x"), F.least("x_a", "x_b").alias("y")).filter(near)
    # larger ones: each line with the earliest of the group
    early = Window.partitionBy("mark").orderBy("x")
    earliest = (crowded.withColumn("rank", F.row_number().over(early)).filter(F.col("rank") <= FEW)
                .select("mark", other))
    one = verified(few.union(crowded.join(earliest, "mark").filter(near).select("x", "y")), "first")
    # the others' near lines share crowded marks only: met by how they differ from a centre, one of
    # the earliest, which all of its group have been compared with
    left = (crowded.select("x").distinct()
            .join(one.withColumnRenamed("line", "gone"), F.col("x.line") == F.col("gone"), "left_anti"))
    often = crowded.groupBy(other).agg(F.count(F.lit(1)).alias("hidden"))
    centre = (earliest.join(often, "y").groupBy("mark")
              .agg(F.max_by("y", F.struct("hidden", "y")).alias("centre")))
    stars = crowded.join(centre, "mark").filter("x <> centre").select("centre", "x").distinct() \
        .join(left.withColumn("left", F.lit(True)), "x", "left") \
        .withColumn("left", F.coalesce("left", F.lit(False)))
    stars = stored(stars, "stars")
    asking = stars.filter("left").select("centre").distinct()
    stars = stored(stars.join(asking, "centre"), "asked_stars")
    wanted = stars.select("x.line.*").union(stars.select("centre.line.*")).distinct()
    words = stored(_neighbourhoods(docs, wanted, id_col, text_col, WORDS)
                   .dropDuplicates(["doc", "t", "pos"]), "star_words")
    two = verified(met_by_differences(stars, words).filter(near).select("x", "y"), "second")
    return one.union(two).distinct()


def duplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc, t, positions): the lines to drop, by document and text digest."""
    table = stored(line_table(docs, min_words, id_col, text_col), "lines")
    counters = table.filter("block is not null").select("block", "times")
    lines = table.filter("block is null").drop("block", "times")
    kinds = stored(lines.groupBy("h1", "h2").agg(F.min(F.struct("doc", "t", "pos")).alias("line"),
                                                 F.count(F.lit(1)).alias("n"),
                                                 F.first("n").alias("n_words")), "kinds")
    keys = lines.select("h1", F.explode("keys").alias("key"))
    shared = (keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
              .filter("a < b").select("key"))
    wanted = keys.join(shared, "key").select("h1").distinct()
    wanted = kinds.join(wanted, "h1").select("line.*")
    near = stored(_neighbourhoods(docs, wanted, id_col, text_col).dropDuplicates(["doc", "t", "pos"]),
                  "near")
    near_dropped = _verified(_earlier_neighbours(near, min_words), near, min_words) \
        .union(_long_near_lines(docs, kinds, counters, min_words, id_col, text_col)).distinct() \
        .withColumn("near", F.lit(True))
    verdict = (kinds.select("h1", "h2", "line", "n").join(near_dropped, "line", "left")
               .filter("n > 1 or near")
               .select("h1", "h2", F.col("line").alias("first"),
                       F.coalesce("near", F.lit(False)).alias("near")))
    return stored(lines.select("doc", "t", "pos", "h1", "h2").join(verdict, ["h1", "h2"])
                  .filter(F.col("near") | (F.struct("doc", "t", "pos") != F.col("first")))
                  .groupBy("doc", "t").agg(F.collect_set("pos").alias("positions")), "dropped")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without the lines that an earlier line (nearly) repeats.

    Lines are compared by their words, A-Z lower-cased and split at ASCII white
    space. A line goes if an equal line stands earlier, by (id, text, place),
    or, from ``min_words`` words on, an earlier line differs by at most
    ``edits`` (of the longer line's words) words replaced, added or left out.
    The earliest line always stays.
    ``counts``: names for two more columns, lines before and lines dropped.

    Defined cases: lines without words stay as they are; a null text stays
    null and has no lines; a null id counts as the least id; rows that repeat
    an id and its text are one document and keep the same lines; an empty
    table gives an empty result; other columns are passed on untouched.
    """
    small_batches(docs.sparkSession)
    dropped = duplicate_lines(docs, min_words, id_col, text_col)
    doc, t = _ids(docs, id_col, text_col)
    dropped = dropped.toDF("__doc", "__t", "__positions")
    joined = join_checked(docs, dropped, (doc == F.col("__doc")) & (t == F.col("__t")), "left")
    def without(texts: pd.Series, positions: pd.Series) -> pd.Series:
        out = []
        for text, drop in zip(texts, positions, strict=True):
            if text is not None:
                gone = set(drop.tolist())
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            out.append(text)
        return pd.Series(out, dtype=object)

    # only texts that lose lines go to Python
    touched = F.col("__positions").isNotNull()
    text = F.col(text_col).cast("string")
    rebuilt = F.pandas_udf(without, "string")(F.when(touched, text), F.col("__positions"))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1)
    more = {} if counts is None else {
        counts[0]: F.coalesce(n_lines, F.lit(0)),
        counts[1]: F.coalesce(F.size("__positions"), F.lit(0))}
    return (joined.withColumns(more).withColumn("__rebuilt", rebuilt)
            .withColumn(text_col, F.when(touched, F.col("__rebuilt")).otherwise(F.col(text_col)))
            .select(*docs.columns, *more))
