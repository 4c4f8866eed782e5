"""Retention by reference (SNK-2 / SNK-4): what no recent commit names is deleted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.plans.publish import run_path
from tessera.sources.parquet import partition_values, try_read_parquet
from tessera.sources.sinks import delete_folder

RUN_TIME = "%Y%m%dT%H%M%S%f"


def _started(run: str) -> datetime | None:
    """When a run began, from its id (None for ids of another form)."""
    try:
        return datetime.strptime(run.split("-")[0], RUN_TIME).replace(tzinfo=timezone.utc)
    except ValueError:
        return None


def expire_runs(spark: SparkSession, tables: Sequence[tuple[str, str]], commit_log: str, keep: int = 2,
                unfinished: timedelta = timedelta(days=1), now: datetime | None = None) -> list[str]:
    """Delete run folders of ``tables`` (path, name in the log) that nobody needs; the folders deleted.

    The newest ``keep`` committed runs of each table stay, so a reader that
    resolved one of them keeps its files. Older committed runs go. A run that is in no
    commit may be under way and goes only ``unfinished`` after its start (a crash
    left it behind). A table without a commit loses nothing but such leftovers.
    """
    if keep < 1:
        raise ValueError("at least the newest committed run must be kept")
    now = now or datetime.now(timezone.utc)
    log = try_read_parquet(spark, commit_log)
    gone = []
    for path, name in tables:
        committed = [] if log is None else [r["run_id"] for r in log.where(
            F.array_contains("tables", name)).select("run_id").distinct().collect()]
        kept = set(sorted(committed)[-keep:])
        for run in partition_values(spark, path, "run_id"):
            begun = _started(run)
            leftover = begun is not None and now - begun > unfinished
            if run not in kept and (run in committed or leftover):
                delete_folder(spark, run_path(path, run))
                gone.append(run_path(path, run))
    return gone


def expire_scratch(spark: SparkSession, folder: str, older: timedelta = timedelta(days=1),
                   now: datetime | None = None) -> list[str]:
    """Delete written intermediate tables (folders below ``folder``) last written ``older`` ago."""
    now = now or datetime.now(timezone.utc)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    before = (now - older).timestamp() * 1000
    gone = [s.getPath().toString() for s in fs.listStatus(path)
            if s.isDirectory() and s.getModificationTime() < before] if fs.exists(path) else []
    for each in gone:
        delete_folder(spark, each)
    return gone
