"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tessera.llm
from tessera.session import checkpoint_dir, scratch_path

# Functions of this subpackage travel to the executors by value, so a cluster
# needs no installed copy and no zip of it.
cloudpickle.register_pickle_by_value(tessera.llm)

#: Whether a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage (a lost executor costs no recomputation of what came
    before) and lets several consumers read one result. What the job shuffled is
    removed at its end: else it stays until the driver happens to collect its garbage,
    and a long job's shuffles, many times its input, pile up on the executors' disks.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(df: DataFrame, columns: Sequence[str], schema: str,
               rows: Callable[[dict[str, list]], dict[str, Iterable]],
               max_chars: int = 2_000_000, text_col: str | None = None,
               setup: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``rows`` to column lists, batch by batch, in Arrow.

    ``rows`` gets {column: list} (and what ``setup`` returned, once a task, as
    a second argument if given) and returns {column: values} for ``schema``.
    Batches are cut so that ``text_col`` holds about ``max_chars`` bytes, hence
    memory is bounded by that and the longest single text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (setup(),) if setup else ()
        for batch in batches:
            for part in _cut(batch, text_col, max_chars):
                out = rows(dict(zip(part.schema.names,
                                    (c.to_pylist() for c in part.columns), strict=True)), *made)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in out_schema], schema=out_schema)
        del made
        release()

    return df.select(*columns).mapInArrow(run, schema)


def by_value(spark: SparkSession, thing: object) -> Callable[[], object]:
    """Broadcasts ``thing`` with the code of its classes; call the result in a task to have it.

    A plain broadcast would name the classes' modules, which a worker without an
    installed copy of the package cannot import.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    def load() -> object:
        import pickle
        return pickle.loads(held.value)
    return load


def release() -> None:
    """Gives a worker's unused memory back: it may wait long for its next task."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts travel to Python in batches of at most ``rows``, which bounds both sides' memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _cut(batch: pa.RecordBatch, text_col: str | None, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``max_bytes`` of ``text_col`` each."""
    import numpy as np
    import pyarrow.compute as pc

    if text_col is None or batch.num_rows == 0:
        yield batch
        return
    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // max_bytes
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for lo, hi in zip(starts[:-1], starts[1:], strict=True):
        yield batch.slice(lo, hi - lo)


def join_checked(rows: DataFrame, table: DataFrame, on: Sequence[str] | Column, how: str = "inner",
                 most_rows: int = 200_000) -> DataFrame:
    """``rows`` joined with a stored ``table``, broadcast only if it is small.

    The table's rows are counted (from the files' footers); up to ``most_rows``
    the wide rows stay where they are, beyond that both sides are shuffled.
    """
    small = table.count() <= most_rows
    return rows.join(F.broadcast(table) if small else table, on, how)


def rows_of(rows: DataFrame, ids: DataFrame, fewest: int = 200_000, most: int = 4_000_000) -> DataFrame:
    """``rows`` (an id, a long, comes first) whose id is in the stored table ``ids`` (one column, distinct).

    Beyond what is joined by broadcast, up to ``most`` ids (8 bytes each) go to the tasks
    as a sorted list, and no row is shuffled that is not wanted; more are joined.
    """
    import numpy as np

    if not fewest < ids.count() <= most:
        return join_checked(rows, ids, [rows.columns[0]], most_rows=fewest)
    own = np.sort(ids.toArrow().column(0).drop_null().to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(own.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.int64)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            asked = batch.column(0).to_numpy()
            at = np.searchsorted(known, asked)
            yield batch.filter(pa.array(known[np.minimum(at, len(known) - 1)] == asked))
        release()

    return rows.mapInArrow(run, rows.schema)


def hash_bucket(h: Column, n: int) -> Column:
    """Bucket 0..n-1 of a 64-bit hash, ascending with the hash."""
    unit = h.cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return F.least(F.floor(unit * F.lit(float(n))), F.lit(n - 1)).cast("int")


def bucket_count(n_rows: int) -> int:
    """About the square root: buckets, and rows in a bucket, stay small together."""
    return max(1, math.isqrt(max(n_rows, 0)))


def ordered_buckets(rows: DataFrame, h: str, row: str, n_rows: int) -> DataFrame:
    """Adds ``BUCKETS``: ascending with the hash ``h``, about sqrt(n) rows each.

    Rows of one hash that would fill a bucket by themselves (copies of one row,
    which are interchangeable) are dealt over several by ``row``, a number that
    must be stored with them. There are fewer such hashes than buckets.
    """
    n = bucket_count(n_rows)
    rows = rows.withColumn("__bucket", hash_bucket(F.col(h), n))
    heavy = (rows.groupBy("__bucket", h).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > F.lit(2 * n))
             .groupBy("__bucket")
             .agg(F.collect_list(F.struct(F.col(h).alias("h"), "n")).alias("__heavy")))
    rows = rows.join(F.broadcast(heavy), "__bucket", "left")
    own = F.get(F.filter("__heavy", lambda x: x["h"] == F.col(h)), F.lit(0))
    below = F.coalesce(F.size(F.filter("__heavy", lambda x: x["h"] < F.col(h))), F.lit(0))
    rows = rows.withColumn("__own", own["n"])
    part = F.when(F.col("__heavy").isNull(), F.lit(0)).otherwise(
        below * F.lit(2) + F.col("__own").isNotNull().cast("int"))
    deal = F.coalesce(F.pmod(F.xxhash64(row), F.ceil(F.col("__own") / F.lit(n))), F.lit(0))
    return (rows.withColumn("__part", part).withColumn("__deal", deal.cast("long"))
            .drop("__heavy", "__own"))


BUCKETS = ("__bucket", "__part", "__deal")


def ranked(rows: DataFrame, keys: Sequence[str], buckets: Sequence[str], order: Sequence[str],
           rank: str, total: str | None = None) -> DataFrame:
    """0-based ``rank`` of each row within ``keys`` by (``buckets``, ``order``).

    No window ever holds a whole key: rows are numbered inside (keys, buckets)
    and shifted by the number of rows in lower buckets, which comes from a
    pre-aggregated count. ``total``: name of a column for the key's row count.
    ``keys`` may be empty; neither they nor the buckets may hold nulls.
    """
    cols, inside = list(keys), [*keys, *buckets]
    per = rows.groupBy(*inside).agg(F.count(F.lit(1)).alias("__n"))
    by = Window.partitionBy(*cols) if cols else Window.partitionBy()
    per = per.withColumn("__before", F.sum("__n").over(
        by.orderBy(*buckets).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))
    if total:
        per = per.withColumn(total, F.sum("__n").over(by))
    inner = Window.partitionBy(*inside).orderBy(*order)
    return (rows.join(per.drop("__n"), inside)
            .withColumn(rank, F.col("__before") + F.row_number().over(inner) - F.lit(1))
            .drop("__before"))
