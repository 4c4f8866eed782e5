"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled by a seeded hash and ranked inside their source; the rank plus
an offset of the source's own (0 to 1, by its hash), divided by the source's size,
is the row's fractional rank. Sorted by it, every
stretch of rows holds the sources in the corpus' proportions, so cutting the
order into equal stretches gives shards that all match the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BUCKETS, bucket_count, ordered_buckets, ranked, stored


def interleaved_shards(docs: DataFrame, n_shards: int = 8, seed: int = 0, id_col: str = "doc_id",
                       text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Shard and slot of every row; law ``rows``: shard sizes are at most one apart.

    Defined cases: a null text counts as empty (size 1); a null source is a
    source of its own; null ids and repeated rows are rows like any other
    (equal rows are interchangeable); an empty table gives an empty result;
    columns of ``docs`` that are not named here are not read.

    Only (id, source, size, checksum, hash) is stored and shuffled, never the text.
    Ranks come from hash buckets, about sqrt(n) of them with sqrt(n) rows each,
    so a source with a third of all rows is spread over all tasks; so are copies of
    one row, and by the offsets many sources of a row or two.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(F.when(F.col(source_col).isNull(), F.lit("0")).otherwise(F.lit("1")),
                 F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("__source"))
    rows = rows.withColumn("__h", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("__source"),
                                             F.col("text_crc32"), F.col("size")))
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
    n = rows.count()
    buckets = bucket_count(n)
    tie = ["__h", "doc_id", "text_crc32", "size"]
    rows = ranked(ordered_buckets(rows, "__h", "__row", n), ["__source"], BUCKETS, tie,
                  "__rank", total="__of")
    offset = F.pmod(F.xxhash64(F.lit(seed), "__source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = rows.withColumn("__at", (F.col("__rank") + offset) / F.col("__of"))
    rows = rows.withColumn("__bucket", F.least(F.floor(F.col("__at") * F.lit(float(buckets))),
                                               F.lit(buckets - 1)).cast("int"))
    rows = ranked(rows, [], ["__bucket"], ["__at", "__source", *tie], "__i")
    n, k = max(n, 1), n_shards
    return (rows
            .withColumn("shard", F.expr(f"cast((__i * {k}L) div {n}L as int)"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.expr(f"__i - (shard * {n}L + {k - 1}L) div {k}L").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
