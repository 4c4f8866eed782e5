"""Document fingerprints by Order MinHash.

Every k-mer of a text gets its occurrence number, so repeats count. Each of
``m`` hash functions selects the ``l`` numbered k-mers of least value, puts them
back in text order and hashes the tuple. Two texts agree on a function when
the same k-mers are selected in the same order, which falls with their edit
distance and not merely with their sets.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import small_batches
from tessera.llm.shingles import mix

FUNCTIONS, TUPLE, KMER = 64, 2, 5
#: Columns that put documents in order; rows that agree on ``KEY`` are alike.
ORDER = ("high", "low", "t", "row")
KEY = ORDER[:3]
OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")


class OrderMinHash:
    def __init__(self, functions: int = FUNCTIONS, tuple_size: int = TUPLE, k: int = KMER,
                 seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.m, self.l, self.k = functions, tuple_size, k
        self.flip = rng.integers(0, 2**32, (functions, 1), dtype=np.uint32)
        self.times = rng.integers(0, 2**31, (functions, 1), dtype=np.uint32) * np.uint32(2) \
            + np.uint32(1)

    def kmers(self, cp: np.ndarray) -> np.ndarray:
        """Hashes of all k-mers of the code points, in text order."""
        n = max(len(cp) - self.k + 1, 1)
        x, wide = np.zeros(n, np.uint64), cp.astype(np.uint64)
        for j in range(min(self.k, len(cp))):
            x = x * np.uint64(0x100000001B3) + wide[j:j + n] + np.uint64(1)
        return mix(x)

    @staticmethod
    def numbered(kmers: np.ndarray) -> np.ndarray:
        """32-bit values of (k-mer, how often it came before)."""
        n = len(kmers)
        bits = np.uint64(max(n - 1, 1).bit_length())
        order = np.sort(kmers >> bits << bits | np.arange(n, dtype=np.uint64))
        at = (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.ones(n, bool)
        new[1:] = order[1:] >> bits != order[:-1] >> bits
        first = np.flatnonzero(new)
        nth = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        out = np.empty(n, np.uint32)
        out[at] = (mix(kmers[at] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                   >> np.uint64(32)).astype(np.uint32)
        return out

    def signature(self, text: str) -> np.ndarray:
        """``m`` 16-bit tuple hashes; of no length for an empty text."""
        if not text:
            return np.empty(0, np.uint16)
        kmers = self.kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
        x = self.numbered(kmers)
        take = min(self.l, len(x))
        chosen = np.empty((self.m, take), np.int64)
        rows = np.arange(self.m)
        # as many functions at once as fit a processor's cache
        step = max(1, min(self.m, 400_000 // len(x)))
        for lo in range(0, self.m, step):
            part = slice(lo, lo + step)
            values = (x[None, :] ^ self.flip[part]) * self.times[part]
            values ^= values >> np.uint32(15)
            values *= np.uint32(0x2C1B3C6D)
            for t in range(take):
                least = values.argmin(1)
                chosen[part, t] = least
                values[rows[:len(least)], least] = np.uint32(2**32 - 1)
        chosen.sort(axis=1)
        tuples = np.zeros(self.m, np.uint64)
        for t in range(take):
            tuples = mix(tuples * np.uint64(0x100000001B3) + kmers[chosen[:, t]])
        return (tuples >> np.uint64(48)).astype(np.uint16)


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of functions that agree; empty texts are like empty texts only."""
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    return float((one == two).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) characters replaced by ``following``'s first ones."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def cuts_below(cuts: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted ``cuts`` are at most each key (columns, first one first)."""
    low = np.searchsorted(cuts[0], keys[0], side="left")
    high = np.searchsorted(cuts[0], keys[0], side="right")
    if len(cuts) == 1:
        return high
    out = low.copy()
    for at in np.unique(low[high > low]):
        rows = np.flatnonzero((low == at) & (high > low))
        out[rows] += cuts_below([c[at:high[rows[0]]] for c in cuts[1:]],
                                [k[rows] for k in keys[1:]])
    return out


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``ORDER``: the id's halves, a hash of the text and one of the row.

    None has more than 53 bits, so that Spark's quantiles, which are doubles, are exact.
    """
    k = F.coalesce("doc_id", F.lit(-2**63).cast("long"))
    return rows.select("*", F.shiftright(k, 32).alias("high"),
                       k.bitwiseAND(F.lit(2**32 - 1)).alias("low"),
                       F.shiftright(F.xxhash64("text"), 11).alias("t"),
                       F.shiftright(F.xxhash64(F.monotonically_increasing_id()), 11).alias("row"))


def range_cuts(rows: DataFrame, n: int) -> list[np.ndarray]:
    """Fewer than 3 * n cuts that part ``rows`` (see :func:`ranked`) about evenly by ``ORDER``.

    Quantiles of the first column cut the rows; a value that fills several
    ranges is cut again by the quantiles of the next column among its own rows.
    So neither copies of an id nor of a whole row make a large range.
    """
    spark, least = rows.sparkSession, np.iinfo(np.int64).min
    cuts: set[tuple] = set()
    hot: dict[tuple, int] = {(): n} if n > 1 else {}
    for depth, column in enumerate(ORDER):
        before = list(ORDER[:depth])
        wider: dict[tuple, int] = {}
        # by powers of two: one job each, for fewer than n values together
        sizes = {k: max(parts, 1 << (parts - 1).bit_length() if k else n) for k, parts in hot.items()}
        for size in set(sizes.values()):
            own = rows
            if before:
                keys = spark.createDataFrame([k for k, x in sizes.items() if x == size],
                                             ", ".join(f"{c} long" for c in before))
                own = rows.join(F.broadcast(keys), before)
            q = F.percentile_approx(column, [i / size for i in range(1, size)], max(1000, 10 * size))
            for r in own.groupBy(*before).agg(q.alias("q")).collect():
                for value, times in Counter(r["q"] or []).items():
                    here = (*(r[c] for c in before), value)
                    cuts.add((*here, *[least] * (len(ORDER) - len(here))))
                    if times > 1:
                        wider[here] = times + 1
        hot = wider
    return [np.array([c[i] for c in sorted(cuts)], np.int64) for i in range(len(ORDER))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row of ``docs``, of its edited text, and their likeness.

    The edited text takes its second half from the next document by id (after
    the last: the first). Rows are dealt into ranges of (id, hash of the text,
    row), one range a task, and sorted there; the first row of the next range
    comes along to each, so texts are shuffled once and no task sees the whole
    order. There are as many ranges as shuffle partitions, or as the input has
    splits if these are more.

    Defined cases: a null text is empty, and an empty text has an empty
    fingerprint; texts shorter than a k-mer are one k-mer; null ids rank like
    the smallest long; rows with equal ids follow each other by a hash of their
    text; a single row is its own next; an empty table gives an empty result;
    other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = ranked(rows)
    # texts' hashes are read for cuts only where an id fills several ranges
    cuts = range_cuts(rows, n)
    held_cuts = spark.sparkContext.broadcast(cuts)  # fewer than 3 * n

    def range_of(high: pd.Series, low: pd.Series, t: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(cuts_below(held_cuts.value, [x.to_numpy() for x in (high, low, t, row)]))

    rows = rows.withColumn("part", F.pandas_udf(range_of, "int")(*ORDER)).drop("row")
    # the first row of each range: at most 3 * n rows
    firsts = sorted((r["part"], *r["f"]) for r in rows.groupBy("part").agg(
        F.min(F.struct(*KEY)).alias("f")).collect())
    goes_to = spark.createDataFrame(
        [(firsts[i - 1][0], *f[1:]) for i, f in enumerate(firsts)],
        "part int, " + ", ".join(f"{c} long" for c in KEY))
    # rows of one id and hash are alike: one text of them serves every range it opens
    texts = (rows.join(F.broadcast(goes_to.select(*KEY).distinct()), list(KEY), "left_semi")
             .groupBy(*KEY).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")))
    heads = texts.join(F.broadcast(goes_to), list(KEY)).select(
        "doc_id", "text", *KEY, "part", F.lit(1).alias("head"))
    dealt = (rows.withColumn("head", F.lit(0)).unionByName(heads)
             .repartitionById(len(cuts[0]) + 1, F.col("part"))
             .sortWithinPartitions("part", "head", *KEY))
    schema = to_arrow_schema(StructType.fromDDL(OUT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, held = OrderMinHash(), None
        for batch in batches:
            out: list[tuple] = []
            for doc, text, head in zip(*(batch.column(c).to_pylist() for c in
                                         ("doc_id", "text", "head")), strict=True):
                own = make.signature(text)
                if held is not None:
                    before, whole, sign = held
                    changed = edited(whole, text)
                    again = make.signature(changed)
                    out.append((before, len(whole), hashlib.sha256(changed.encode()).hexdigest(),
                                text_of(sign), text_of(again), likeness(sign, again),
                                likeness(sign, own)))
                held = None if head else (doc, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in
                 zip(zip(*out, strict=True), schema, strict=True)]
                if out else [pa.array([], f.type) for f in schema], schema=schema)

    return dealt.select("doc_id", "text", "head").mapInArrow(run, OUT)
