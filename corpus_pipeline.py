"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Null ids, null texts, repeated rows
and empty tables are handled as each operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, stored
from tessera.llm.decontaminate import benchmark_hits, without_contaminated
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.near_duplicates import near_duplicates
from tessera.llm.packing import pack_documents
from tessera.llm.queries import public_vocabulary
from tessera.llm.toxicity import without_toxic
from tessera.session import configure


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that have no words left after losing some."""
    out = dedup_lines(docs, counts=("__lines", "__dropped"))
    emptied = (F.col("__dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = out.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__dropped") > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, benchmark_hits(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' tokens, packed into sequences."""
    return pack_documents(docs, public_vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Hashes, learned scores and the packing search have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
