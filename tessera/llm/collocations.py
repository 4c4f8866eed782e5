"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

Words and prefixes travel as 64-bit hashes (a word's hash holds its language),
and every level reads the texts once:

1. words are counted; those that occur often enough are phrases of one word;
2. for each longer length, a task keeps one stripe a prefix, (next word,
   count) pairs in arrays, for the places where the words but the last and the
   words but the first are both frequent phrases already;
3. stripes are shuffled by buckets of prefixes and those of one prefix merged
   elementwise. The merged stripe gives the
   frequent extensions; their largest count is what may subsume the prefix,
   and, read by the words after the first, what may subsume the suffix.

Which phrases are frequent is looked up in a table of ``CELLS`` bytes at any
size of the corpus. Phrases that share a cell with a frequent one are counted
too and fall out when stripes are merged, so nothing is lost by its bound. A
cell also tells how often its phrases occur: the stripe of a prefix above
``SEGMENT`` occurrences is dealt over segments of next words, so no task
merges a hot prefix alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import _cut, release, small_batches, stored
from tessera.llm.shingles import POWERS, mix, text_bytes

CELL_BITS = 22
CELLS = 1 << CELL_BITS
#: A task merges its own stripes once it holds this many entries.
HELD = 1_500_000
#: Most entries in one row of packed stripes.
ROW_ENTRIES = 8192
#: Occurrences of a prefix that a segment of its stripe may stand for.
SEGMENT = 1 << 20
#: Stripes are dealt to buckets of about this many occurrences, which bounds what a merge holds.
BUCKET = 1 << 24
LEAST_BUCKETS = 512
BASE = np.uint64(0xD6E8FEB86659FD93)

WORD, BLANK, STOP = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = STOP

WORDS = "key long, cell int, lang string, word binary, n long"
STRIPES = "bucket int, prefixes array<long>, lengths array<int>, nexts array<long>, counts array<int>"
EXTENSIONS = "prefix long, next long, key long, cell int, f long"


def cells(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


class Words:
    """The words of a batch of texts, and how far each one's piece goes on."""

    def __init__(self, part: pa.RecordBatch) -> None:
        raw, at = text_bytes(part.column("text"))
        self.low = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32)).astype(np.uint8)
        kind = KIND[self.low]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        begins = kind == WORD
        ends = begins.copy()
        if len(raw):
            begins[1:] &= (kind[:-1] != WORD) | edge[1:-1]
            ends[:-1] &= (kind[1:] != WORD) | edge[1:-1]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = POWERS.to(len(raw) + 1)
        sums = np.r_[np.uint64(0), np.cumsum((self.low + np.uint64(1)) * up[:len(raw)])]
        word = mix((sums[self.last] - sums[self.first]) * down[self.first]
                   + (self.last - self.first).astype(np.uint64))
        text = np.searchsorted(at, self.first, side="right") - 1
        langs = part.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[text] if len(text) else np.empty(0, np.int64)
        salt = np.array([_name_hash(x) for x in self.langs], np.uint64)
        self.hash = mix(word ^ salt[self.lang]) if len(text) else word
        # words left in the piece, this one included
        stops = np.r_[0, np.cumsum(kind == STOP)]
        if len(text):
            cut = (stops[self.first[1:]] != stops[self.last[:-1]]) | (text[1:] != text[:-1])
            piece_end = np.r_[np.flatnonzero(cut), len(text) - 1]
            here = np.arange(len(text))
            self.left = piece_end[np.searchsorted(piece_end, here)] - here + 1
        else:
            self.left = np.empty(0, np.int64)

    def keys(self, size: int) -> np.ndarray:
        """Key of the ``size`` words from each place on (whether or not they share a piece)."""
        n = max(len(self.hash) - size + 1, 0)
        key = np.zeros(n, np.uint64)
        for j in range(size):
            key = key * BASE + self.hash[j:j + n]
        return key

    def text(self, i: int) -> bytes:
        return self.low[self.first[i]:self.last[i]].tobytes()


def _name_hash(name: str) -> int:
    import hashlib
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, cell, lang, word, n) of every word."""
    schema = to_arrow_schema(StructType.fromDDL(WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                words = Words(part)
                keys, at, n = np.unique(words.hash, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(cells(keys).astype(np.int32)),
                     pa.array([words.langs[x] for x in words.lang[at]], pa.string()),
                     pa.array([words.text(i) for i in at], pa.binary()), pa.array(n)], schema=schema)
        release()

    return (texts.mapInArrow(run, WORDS).groupBy("key", "cell", "lang", "word")
            .agg(F.sum("n").alias("n")))


def frequent_cells(phrases: DataFrame) -> bytes:
    """A byte a cell: 0 without a frequent phrase, else 1 + log2 of the most occurrences of one."""
    levels = np.zeros(CELLS, np.uint8)
    found = (phrases.groupBy("cell").agg(F.max("f").alias("f"))  # at most CELLS rows
             .select("cell", (F.floor(F.log2("f")) + 1).cast("int").alias("level")).toArrow())
    levels[found["cell"].to_numpy()] = found["level"].to_numpy()
    return levels.tobytes()


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Stripes summed elementwise: (prefix, next, count), sorted, each pair once."""
    prefix, following, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(prefix):
        return prefix, following, count
    order = np.lexsort((following, prefix))
    prefix, following, count = prefix[order], following[order], count[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (following[1:] != following[:-1])
    starts = np.flatnonzero(new)
    return prefix[starts], following[starts], np.add.reduceat(count, starts)


NONE = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))


def stripes(texts: DataFrame, size: int, frequent: bytes, n_buckets: int) -> DataFrame:
    """Each task's stripes for phrases of ``size`` words, packed.

    A row holds the stripes of one bucket, one after the other: ``prefixes``,
    the number of entries of each (``lengths``), and their entries (``nexts``,
    ``counts``). A stripe's bucket comes from the hashes of its prefix and segment.
    """
    schema = to_arrow_schema(StructType.fromDDL(STRIPES))
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def rows(stripe: tuple[np.ndarray, ...], levels: np.ndarray) -> Iterator[pa.RecordBatch]:
        prefix, following, count = stripe
        spread = np.maximum(levels[cells(prefix)].astype(np.int64) - SEGMENT.bit_length(), 0)
        segment = mix(following) & ((np.uint64(1) << spread.astype(np.uint64)) - np.uint64(1))
        bucket = mix(prefix + segment * BASE) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        prefix, following, count, bucket = (x[order] for x in (prefix, following, count, bucket))
        new = np.ones(len(prefix), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        start = np.flatnonzero(new)
        place = np.arange(len(prefix)) - np.repeat(start, np.diff(np.r_[start, len(prefix)]))
        new = place % ROW_ENTRIES == 0
        starts = np.r_[np.flatnonzero(new), len(prefix)]
        heads = new.copy()
        heads[1:] |= prefix[1:] != prefix[:-1]
        for lo in range(0, len(starts) - 1, 64):
            at = starts[lo:lo + 65]
            begin, end = at[0], at[-1]
            head = np.flatnonzero(heads[begin:end]) + begin
            of_heads = pa.array(np.searchsorted(head, at), pa.int32())
            of_entries = pa.array(at - begin, pa.int32())
            lists = [(of_heads, prefix[head].view(np.int64)),
                     (of_heads, np.diff(np.r_[head, end]).astype(np.int32)),
                     (of_entries, following[begin:end].view(np.int64)),
                     (of_entries, count[begin:end].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[at[:-1]].astype(np.int32)),
                 *(pa.ListArray.from_arrays(offsets, pa.array(values)).cast(f.type)
                   for (offsets, values), f in zip(lists, list(schema)[1:], strict=True))],
                schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        held, waiting, n = NONE, [], 0
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                words = Words(part)
                keys = words.keys(size - 1)
                often = levels[cells(keys)] > 0
                at = np.flatnonzero(words.left >= size)
                at = at[often[at] & often[at + 1]]
                waiting.append(_merged([(keys[at], words.hash[at + size - 1],
                                         np.ones(len(at), np.int64))]))
                n += len(waiting[-1][0])
                if n >= HELD:
                    held, waiting, n = _merged([held, *waiting]), [], 0
                    if len(held[0]) >= HELD:
                        yield from rows(held, levels)
                        held = NONE
        held = _merged([held, *waiting])
        if len(held[0]):
            yield from rows(held, levels)
        del held, waiting
        release()

    return texts.mapInArrow(run, STRIPES)


def extensions(parts: DataFrame, least: int) -> DataFrame:
    """Merged stripes: (prefix, next, key, cell, f) where f, the sum, is at least ``least``."""
    schema = to_arrow_schema(StructType.fromDDL(EXTENSIONS))

    def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        merged = _merged(parts)
        prefix, following, f = (x[merged[2] >= least] for x in merged)
        keys = prefix * BASE + following
        return pa.RecordBatch.from_arrays(
            [pa.array(prefix.view(np.int64)), pa.array(following.view(np.int64)),
             pa.array(keys.view(np.int64)), pa.array(cells(keys).astype(np.int32)),
             pa.array(f)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, n = None, [], 0
        for batch in batches:
            for bucket, row in zip(batch.column(0).to_pylist(), range(batch.num_rows), strict=True):
                if bucket != at and parts:
                    yield rows(parts)
                    parts, n = [], 0
                at = bucket
                prefixes, lengths, nexts, counts = (
                    batch.column(i)[row].values.to_numpy() for i in range(1, 5))
                parts.append((np.repeat(prefixes, lengths).view(np.uint64), nexts.view(np.uint64),
                              counts.astype(np.int64)))
                n += len(nexts)
                if n >= HELD:
                    parts = [_merged(parts)]
                    n = len(parts[0][0]) // 2  # what stays distinct is not merged at every row
        if parts:
            yield rows(parts)
        release()

    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, EXTENSIONS)


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, percent: int = 100,
                 top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language, by their weakest cut.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends and split at
    blanks. A phrase that occurs ``least`` times or more is a candidate; cut
    after k words it scores floor(1000 * a * n / (l * r)) with a, l and r the
    occurrences of the phrase and its two parts and n those of all words; its
    lowest-scoring cut counts (ties: least k). A candidate goes if a longer
    phrase around it occurs in at least ``percent`` of its places; looking one
    word to the left and right is enough, as phrases between the two occur at
    least as often as the longer one.

    Returns lang, rank, phrase, a, l, r, n, score. Order: score and a
    descending, then the phrase's bytes.

    Defined cases: a null text is empty; a null lang is ``und``; texts without
    words add nothing; repeated rows count each time; other columns are not
    read; an empty table gives an empty result. Counts are exact but for two
    words (or two frequent phrases) that share a 64-bit hash. Memory of a task
    is bounded by ``HELD`` entries and its longest text.
    """
    texts = _texts(docs, text_col, lang_col)
    words = stored(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = stored(words.filter(F.col("n") >= least)
                   .select("key", "cell", "lang", F.col("word").cast("string").alias("word"),
                           F.array("key").alias("words"), F.col("n").alias("f")), "phrases")
    levels = [often.select("key", "cell", "words", "f")]
    n_words = sum(r.n for r in totals.agg(F.sum("n").alias("n")).collect() if r.n)
    n_buckets = max(LEAST_BUCKETS, n_words // BUCKET)
    for size in range(2, longest + 1):
        if levels[-1].isEmpty():
            break
        found = extensions(stripes(texts, size, frequent_cells(levels[-1]), n_buckets), least)
        heads = levels[-1].select(F.col("key").alias("prefix"), F.col("words").alias("head"))
        levels.append(stored(found.join(heads, "prefix").select(
            "key", "cell", F.concat("head", F.array("next")).alias("words"), "f"), "phrases"))
    known = levels[0]
    for level in levels[1:]:
        known = known.union(level)
    known = known.select("words", "f")
    length = F.size("words")
    longer = known.filter(length > 2)
    around = (longer.select(F.slice("words", 1, length - 1).alias("words"), "f")
              .union(longer.select(F.slice("words", 2, length - 1).alias("words"), "f"))
              .groupBy("words").agg(F.max("f").alias("most")))
    kept = (known.filter(length > 1).withColumnRenamed("f", "a").join(around, "words", "left")
            .filter(F.coalesce(F.lit(100) * F.col("most") < F.lit(percent) * F.col("a"), F.lit(True)))
            .drop("most"))
    spelled = (kept.select("words", F.posexplode("words").alias("at", "key"))
               .join(often.select("key", "lang", "word"), "key").groupBy("words", "lang")
               .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled")))
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), length - 1)))
            .withColumn("one", F.slice("words", F.lit(1), F.col("k")))
            .withColumn("two", F.slice("words", F.col("k") + 1, length - F.col("k"))))
    part = lambda x, name: known.select(F.col("words").alias(x), F.col("f").alias(name))
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    # the score is at most 1000 * n / a, well inside 64 bits; its terms need not be
    cuts = (cuts.join(part("one", "l"), "one").join(part("two", "r"), "two").join(spelled, "words")
            .join(totals, "lang").withColumns({
                "over": F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"),
                "under": exact("l") * exact("r")})
            .withColumn("score", F.expr("over div under")))
    best = (cuts.groupBy("words", "lang", "spelled", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", F.array_join(F.col("spelled.word"), " ").alias("phrase"),
                    "a", "cut.l", "cut.r", "n", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    "score"))
