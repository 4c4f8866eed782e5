"""Warehouse table source (SRC-1).

The original jobs read a remote warehouse table through a Spark connector.
The same entry point here reads through ``spark.read.format(fmt)``; without
the connector on the class path (as in tests) the table is a Parquet
directory standing in for the export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_source(spark: SparkSession, table: str, fmt: str = "bigquery",
                fallback_root: str | None = None, **options: str) -> DataFrame:
    """Read ``table`` with the warehouse connector, or ``fallback_root/table`` as Parquet."""
    if fallback_root is not None:
        return spark.read.parquet(f"{fallback_root.rstrip('/')}/{table}")
    return spark.read.format(fmt).option("table", table).options(**options).load()
