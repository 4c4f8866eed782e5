"""Benchmark decontamination by pigeonhole edit matching.

A test item of n words may differ from a passage by ``k = floor(rate * n)``
word edits. Split into k + 1 pieces, at least one piece is then untouched, so
exact hits of pieces (an Aho-Corasick automaton over the whole text) give every
place worth a look; Myers' bit-parallel distance over the words around a hit
decides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows

WORD = re.compile(r"[^\W_]+")
#: Bytes of benchmark text that go to the executors at once.
BLOCK_BYTES = 8_000_000
HITS = "doc_id long, item_id long, first_word long, n_words long, distance int"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall((text or "").lower())


def pieces_of(n_words: int, errors: int) -> list[tuple[int, int]]:
    """``errors`` + 1 near-equal stretches (start, end) of ``n_words`` words."""
    parts = min(errors + 1, n_words)
    cuts = [n_words * i // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def myers(pattern: list[str], window: list[str]) -> list[int]:
    """Least edits between ``pattern`` and a stretch of ``window`` ending at each word."""
    at: dict[str, int] = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, out = full, 0, m, []
    for w in window:
        same = at.get(w, 0)
        xv = same | minus
        xh = (((same & plus) + plus) ^ plus) | same
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = (down | ~(xv | up)) & full
        minus = up & xv
        out.append(score)
    return out


class ItemMatcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick
        self.items, self.budget, starts = [], [], {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k, i = int(rate * len(words)), len(self.items)
            self.items.append((item_id, words))
            self.budget.append(k)
            for lo, hi in pieces_of(len(words), k):
                starts.setdefault(f" {' '.join(words[lo:hi])} ", []).append((i, lo, hi))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in starts.items():
            self.automaton.add_word(piece, uses)
        if starts:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, first word, words, distance) of the best match at each place."""
        import bisect
        if not self.items:
            return []
        words = words_of(text)
        line = f" {' '.join(words)} "
        places: dict[int, set[int]] = {}
        blanks: list[int] | None = None
        for end, uses in self.automaton.iter(line):
            if blanks is None:
                blanks = [i for i, c in enumerate(line) if c == " "]
            word_end = bisect.bisect_left(blanks, end)  # words before this blank
            for i, _, hi in uses:
                places.setdefault(i, set()).add(word_end - hi)
        out = []
        for i, found in places.items():
            (item_id, pattern), k = self.items[i], self.budget[i]
            m, group = len(pattern), []
            for start in [*sorted(found), None]:
                if group and (start is None or start - group[-1] > 2 * k):
                    lo = max(group[0] - k, 0)
                    scores = myers(pattern, words[lo:group[-1] + m + k])
                    best = min(scores, default=m)
                    if best <= k:
                        last = lo + scores.index(best)
                        out.append((item_id, max(last - m + 1, 0), m, best))
                    group = []
                if start is not None:
                    group.append(start)
        return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, rate: float = 0.2,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text") -> DataFrame:
    """One row per place where a document holds a benchmark item.

    A place matches if it differs from the item by at most ``rate`` times the
    item's words, in word edits, after lower-casing and leaving out all but
    letters and digits. The automaton reads whole documents.

    Benchmarks beyond :data:`BLOCK_BYTES` are matched block by block, each
    small enough to go to every executor; the documents are read once a block.

    Defined cases: null or wordless texts match nothing, and items without
    words match nothing; equal items are found each under its own id; rows of
    ``docs`` with equal ids add their hits to that id; null ids are kept as
    null; empty tables on either side give no hits; further columns are unread.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        held = spark.sparkContext.broadcast(sorted((tuple(r) for r in own.collect()), key=str))

        def rows(cols: dict, matcher: ItemMatcher) -> dict:
            found = [(doc, *hit) for doc, text in zip(cols["doc_id"], cols["text"], strict=True)
                     for hit in matcher.hits(text)]
            names = ("doc_id", "item_id", "first_word", "n_words", "distance")
            return dict(zip(names, zip(*found, strict=True), strict=True)) if found \
                else {n: [] for n in names}

        named = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.col(text_col).cast("string").alias("text"))
        part = arrow_rows(named, ["doc_id", "text"], HITS, rows, text_col="text",
                          setup=lambda held=held: ItemMatcher(held.value, rate))
        out = part if out is None else out.union(part)
    return out


def contamination(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, its places, items and least distance."""
    per = hits.groupBy(F.col("doc_id").alias("__id")).agg(
        F.count(F.lit(1)).alias("n_places"), F.min("distance").alias("least_distance"),
        F.array_join(F.array_sort(F.collect_set("item_id")), ",").alias("items"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return (ids.join(per, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
            .select("doc_id", F.col("n_places").isNotNull().alias("contaminated"),
                    F.coalesce("n_places", F.lit(0)).alias("n_places"), "least_distance",
                    F.coalesce("items", F.lit("")).alias("items")))


def without_contaminated(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id has no hit."""
    bad = hits.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__id"]), "left_anti")
