"""Sinks (SNK-1 .. SNK-6) and post-write read-back (VAL-1)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.constants import BATCH_PARTITION, SILVER_PARTITIONS
from tessera.operators.indicators import top_rows

# Cap on rows per output file: large partitions become several files of a
# bounded size instead of one huge file per task.
MAX_RECORDS_PER_FILE = 5_000_000


def _refresh(df: DataFrame, path: str) -> str:
    """Drop the session's cached file listing for a path that was just rewritten."""
    df.sparkSession.catalog.refreshByPath(path)
    return path


def write_batch(df: DataFrame, root: str, batch: str, partition: str = BATCH_PARTITION) -> str:
    """SNK-1 / SNK-5: overwrite one ``anomesdia=D`` directory (idempotent per day)."""
    path = f"{root.rstrip('/')}/{partition}={batch}"
    (df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .parquet(path))
    return _refresh(df, path)


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str] = SILVER_PARTITIONS,
                      cluster_by: Sequence[str] = ()) -> str:
    """SNK-2 / SNK-3: dynamic partition overwrite by the ingestion date.

    Only the partitions present in ``df`` are replaced. The partition columns
    are run constants, so repartitioning by them would send every row to one
    task (D12); ``cluster_by`` optionally hash-partitions by a business key
    instead, and file size is bounded by ``maxRecordsPerFile``.
    """
    if cluster_by:
        df = df.repartition(*cluster_by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*partitions).parquet(path))
    return _refresh(df, path)


def write_table(df: DataFrame, path: str) -> str:
    """SNK-4: full overwrite of a gold table."""
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return _refresh(df, path)


def append_report(df: DataFrame, path: str) -> str:
    """SNK-6: append DQ results to the quality-report area."""
    df.write.mode("append").parquet(path)
    return _refresh(df, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder through the file system Spark itself uses."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@dataclass
class ReadBack:
    count: int
    schema: StructType
    sample: DataFrame
    error: str | None = None


def read_back(spark: SparkSession, path: str, n: int = 3,
              order: Sequence[str] | None = None) -> ReadBack:
    """VAL-1: count, schema and a small ordered sample; errors reported, not raised."""
    try:
        df = spark.read.parquet(path)
        sample = top_rows(df, n, order or df.columns[:1])
        return ReadBack(df.count(), df.schema, sample)
    except Exception as e:  # reported to the caller, as in the original read-back
        return ReadBack(-1, StructType([]), spark.createDataFrame([], StructType([])), str(e))
