"""Catalog registration (CAT-1) and SQL over published tables (CAT-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.parquet import partition_folders


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """CAT-1: external Parquet table over a written folder; partitions discovered.

    Replaces the crawler call. A new table is declared at its location; an
    existing one is pointed at the (new) location in one metadata change, so
    readers never see it missing. Partitions are recovered from the folder
    layout and cached file listings are dropped.
    """
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {_ident(name)} SET LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {_ident(name)} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _columns(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def register_run(spark: SparkSession, name: str, root: str, run_folder: str,
                 partitions: Sequence[str]) -> None:
    """CAT-1 for a versioned table: point the partitions of one run at its folder.

    The table keeps the partitions of earlier runs; those the run holds are
    added, or moved to the run's folder in one metadata change each, so every
    ingestion day shows its newest run. Columns new in the run are added.
    """
    schema = spark.read.parquet(run_folder).schema
    data = [f for f in schema.fields if f.name not in partitions]
    parts = [f for f in schema.fields if f.name in partitions]
    table = _ident(name)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {table} ({_columns(data + parts)}) USING parquet "
                  f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)}) LOCATION '{root}'")
    else:
        known = set(spark.table(name).columns)
        new = [f for f in data if f.name not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(new)})")
    for folder, values in partition_folders(spark, run_folder, partitions):
        spec = ", ".join(f"`{p}` = '{v}'" for p, v in zip(partitions, values))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def sql(spark: SparkSession, query: str) -> DataFrame:
    """CAT-2: ad-hoc SQL over registered tables / views."""
    return spark.sql(query)
