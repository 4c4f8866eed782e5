"""Parquet sources (SRC-6 .. SRC-9): batch partition, multi-year union, latest snapshot."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.constants import BATCH_PARTITION, SILVER_PARTITIONS
from tessera.operators.clean import typed_projection

log = logging.getLogger(__name__)


_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")   # error conditions of an absent or empty path


def try_read_parquet(spark: SparkSession, path: str, ignore_missing_files: bool = False,
                     base_path: str | None = None) -> DataFrame | None:
    """SRC-9: None when the path does not exist or holds no data files.

    ``ignore_missing_files``: files listed but gone by the time a task reads
    them (e.g. a concurrent overwrite) are skipped instead of failing the job.
    ``base_path`` keeps the partition columns of the folders below it.
    """
    reader = spark.read.option("ignoreMissingFiles", str(ignore_missing_files).lower())
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in _MISSING:
            log.warning("no data at %s: skipped", path)
            return None
        raise


def read_batch(spark: SparkSession, root: str, batch: str,
               partition: str = BATCH_PARTITION) -> DataFrame | None:
    """SRC-6: one ``anomesdia=D`` directory, partition column kept.

    Only that directory is listed and read (the path names it; ``basePath``
    keeps the partition value as a column). None when the batch is missing.
    """
    return try_read_parquet(spark, f"{root.rstrip('/')}/{partition}={batch}", base_path=root)


def read_years(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None,
               ignore_missing_files: bool = False) -> DataFrame:
    """SRC-7 / SET-1: read each yearly input alone, cast it to the contract, union by name.

    One glob over all years takes a single footer's schema and fails when a
    column's type differs between years (D11); per-year reads do not. Missing
    columns come out NULL (``allowMissingColumns``), extra ones are kept.
    Missing folders are skipped. A file that vanishes between listing and
    reading fails the job; ``ignore_missing_files`` leaves it out instead.
    """
    frames = []
    for p in paths:
        df = try_read_parquet(spark, p, ignore_missing_files)
        if df is None:
            continue
        if schema is not None:
            df = typed_projection(df, schema, keep_extra=True)
        frames.append(df)
    if not frames:
        raise FileNotFoundError(f"none of {list(paths)} holds data")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def latest_snapshot(df: DataFrame, partitions: Sequence[str] = SILVER_PARTITIONS) -> DataFrame:
    """SRC-8 + D4: keep only the newest ingestion partition.

    Partition values are zero-padded text, so the newest is the greatest
    (y, m, d) tuple. The max is one tiny aggregate over partition columns;
    the filter on its result prunes every other partition from the scan.
    """
    newest = df.agg(F.max(F.struct(*[F.col(p) for p in partitions])).alias("m")).first()["m"]
    if newest is None:
        return df.limit(0)
    return df.where(_partition_equals({p: newest[p] for p in partitions}))


def _partition_equals(values: Mapping[str, str]) -> Column:
    """partition_1 = v1 AND partition_2 = v2 ... (prunes every other partition)."""
    cond = None
    for p, v in values.items():
        c = F.col(p) == F.lit(v)
        cond = c if cond is None else cond & c
    return cond


def _child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (one listing call, no job)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """The ``partition=value`` folder names directly below ``path``, sorted by value."""
    prefix = f"{partition}="
    return sorted(n[len(prefix):] for n in _child_folders(spark, path) if n.startswith(prefix))


def newest_partition(spark: SparkSession, root: str, partitions: Sequence[str]) -> str | None:
    """Path of the newest partition folder; None when a level has no such folder.

    One folder listing per partition level, whatever the number of files.
    """
    path = root.rstrip("/")
    for p in partitions:
        values = partition_values(spark, path, p)
        if not values:
            return None
        path = f"{path}/{p}={values[-1]}"
    return path


def partition_folders(spark: SparkSession, path: str,
                      partitions: Sequence[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(folder, partition values) of every partition folder of a table."""
    found = [(path.rstrip("/"), ())]
    for p in partitions:
        found = [(f"{folder}/{p}={v}", (*values, unquote(v))) for folder, values in found
                 for v in partition_values(spark, folder, p)]
    return found


def read_latest(spark: SparkSession, root: str,
                partitions: Sequence[str] = SILVER_PARTITIONS) -> DataFrame:
    """SRC-8: whole table restricted to the latest ingestion partition.

    Only the newest partition folder is opened (``basePath`` keeps the
    partition columns). Falls back to the aggregate of
    :func:`latest_snapshot` for other layouts.
    """
    newest = newest_partition(spark, root, partitions)
    df = newest and try_read_parquet(spark, newest, base_path=root)
    return df if df is not None else latest_snapshot(spark.read.parquet(root), partitions)
