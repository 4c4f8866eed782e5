"""Delimited files with newlines inside quotes, read by many tasks a file (SRC-2 / SRC-3).

Spark's CSV source reads such a file in one task. Here its text source reads
the lines split by split, and whether a line begins inside quotes follows from
the number of quotes before it: counted per split, summed up over the splits of
the file (one row a split), then line by line inside the split. Lines of one
record are put together again and ``from_csv`` parses the records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPLIT = ("file", "block")


def _inside(flag: Column, before: Column) -> Column:
    return (flag + before) % 2 == 1


def quoted_lines(spark: SparkSession, path: str, sep: str, encoding: str) -> DataFrame:
    """Lines of all files with their place: file, block, n, value, odd, inside, record, stray.

    ``odd``: the line holds an odd number of quotes; ``inside``: it begins
    inside quotes; ``record``: how many records began in its split up to it (0: none
    yet, it goes on with one of an earlier split). ``stray``: it should open a
    quoted field that goes on, but its last quote does not stand at a field's
    start. Text is shuffled once, by split, so a task holds one split's lines.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    # the text source hands out a line's bytes as they are, whatever its encoding
    text = F.decode(F.col("value").cast("binary"), encoding)
    lines = (spark.read.text(path)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"),
                     (F.col("value") if encoding.upper() == "UTF-8" else text).alias("value"))
             .withColumn("odd", (quotes % 2).cast("long")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = (lines.groupBy(*SPLIT).agg(F.sum("odd").alias("n_odd"))
              .select(*SPLIT, F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)).alias("open")))
    own = Window.partitionBy(*SPLIT).orderBy("at")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    # without doubled quotes, the last one of a line that stays open begins a field
    opening = rf'(?:^|{re.escape(sep)})"[^"]*$'
    plain = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    return (lines.withColumn("n", F.row_number().over(own))
            .withColumn("odd_before", F.coalesce(F.sum("odd").over(before), F.lit(0)))
            .join(splits, list(SPLIT))
            .withColumn("inside", _inside(F.col("odd_before"), F.col("open")))
            .withColumn("record", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(own))
            .withColumn("stray", ~F.col("inside") & (F.col("odd") == 1)
                        & ~plain.rlike(opening))
            .select(*SPLIT, "n", "value", "odd", "inside", "record", "stray"))


def stray_quotes(lines: DataFrame) -> DataFrame:
    """Files whose quotes do not pair up, a row each: file, odd_total, n_stray.

    The number of quotes decides nothing there: a quote stands inside an
    unquoted field, or a quoted field is never closed.
    """
    return (lines.groupBy("file").agg((F.sum("odd") % 2 == 1).alias("odd_total"),
                                      F.count_if("stray").alias("n_stray"))
            .filter("odd_total OR n_stray > 0"))


def records(lines: DataFrame) -> DataFrame:
    """One row per record of :func:`quoted_lines`: file, block, record, value.

    A record of one line stays where it is. Only lines of longer ones are shuffled
    again, by the place where the record begins.
    """
    whole = ~F.col("inside") & (F.col("odd") == 0)
    single = lines.filter(whole).select(*SPLIT, "record", "value")
    # the record that was open when a split began: the last one that began before it
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    begun = (lines.groupBy(*SPLIT).agg(F.max("record").alias("last"))
             .select(*SPLIT, F.last(F.when(F.col("last") > 0, F.struct("block", "last")),
                                    ignorenulls=True).over(earlier).alias("carried")))
    parts = lines.filter(~whole).join(begun, list(SPLIT))
    here = F.col("record") > 0
    key = (F.when(here, F.col("block")).otherwise(F.col("carried.block")).alias("first_block"),
           F.when(here, F.col("record")).otherwise(F.col("carried.last")).alias("first_record"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "value"))),
                                    lambda x: x["value"]), "\n")
    several = (parts.select("file", "block", "n", "value", *key)
               .groupBy("file", "first_block", "first_record").agg(text.alias("value"))
               .select("file", F.col("first_block").alias("block"),
                       F.col("first_record").alias("record"), "value"))
    return single.unionByName(several)


def parse_records(rows: DataFrame, schema: StructType, sep: str) -> DataFrame:
    """Columns of ``schema`` (text) from records; each file's first one must be the same header.

    Blank records are left out, as Spark's CSV source does.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    rows = rows.withColumn("fields", F.from_csv("value", _ddl(schema), options))
    header = (F.col("block") == 0) & (F.col("record") == 1)
    named = rows.filter(header).select("fields.*").distinct().limit(2).collect()
    if len(named) > 1 or any(list(r) != schema.names for r in named):
        raise ValueError(f"files with different headers: {[list(r) for r in named]}")
    return rows.filter(~header & (F.length(F.trim("value")) > 0)).select("fields.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names)
