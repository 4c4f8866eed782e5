"""Checked publication: write once -> check the written files -> commit (all or nothing).

1. every frame is computed and written ONCE, to ``<path>/run_id=<id>``, and the
   write itself counts what its row checks ask for;
2. only ``unique`` checks read those files, the checked column alone;
3. only when no critical check failed anywhere, one row is appended to the
   commit log.

Readers resolve the newest committed run, so a run that failed its checks or
crashed half way is never visible and everything published before is left as
it was. A run that fails its checks deletes its own folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import Check
from tessera.operators.quality import CheckResult, DataQualityError, ObservedChecks, score
from tessera.sources.parquet import try_read_parquet
from tessera.sources.sinks import append_report, delete_folder, write_partitioned, write_table

REPORT_SCHEMA = ("table_name string, check_name string, kind string, column_name string, "
                 "critical boolean, observed bigint, passed boolean, status string, "
                 "detail string, score double, checked_at timestamp_ntz")


@dataclass(frozen=True)
class Target:
    df: DataFrame
    path: str
    partitions: Sequence[str] = ()   # partition columns inside the run's folder
    checks: Sequence[Check] = ()


@dataclass
class Published:
    run_id: str
    written: dict[str, str] = field(default_factory=dict)
    results: dict[str, list[CheckResult]] = field(default_factory=dict)
    scores: dict[str, dict] = field(default_factory=dict)


def report_frame(spark: SparkSession, results: Mapping[str, list[CheckResult]],
                 scores: Mapping[str, dict]) -> DataFrame:
    """SNK-6 rows: one per check and table (a handful of rows, built on the driver)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    rows = [(table, r.check.name, r.check.kind, r.check.column, r.check.critical, r.observed,
             r.passed, r.status, r.detail, float(scores[table]["score"]), now)
            for table, res in results.items() for r in res]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def new_run_id() -> str:
    """Sortable run id: UTC time, then a random suffix."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def latest_commit(spark: SparkSession, commit_log: str, table: str | None = None) -> str | None:
    """The newest committed run id, of ``table`` if named (one tiny aggregate over the log)."""
    log_df = try_read_parquet(spark, commit_log)
    if log_df is None:
        return None
    if table is not None:
        log_df = log_df.where(F.array_contains("tables", table))
    return log_df.agg(F.max("run_id").alias("r")).first()["r"]


def run_path(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={run_id}"


def read_published(spark: SparkSession, path: str, commit_log: str,
                   table: str | None = None) -> DataFrame:
    """A table as of its newest committed run (of ``table``, where several share the log)."""
    run = latest_commit(spark, commit_log, table)
    if run is None:
        raise FileNotFoundError(f"nothing committed in {commit_log}")
    return spark.read.parquet(run_path(path, run))


def commit_run(spark: SparkSession, commit_log: str, run_id: str, tables: Sequence[str]) -> None:
    """Append one row to the commit log: from now on readers see the run."""
    commit = spark.createDataFrame(
        [(run_id, datetime.now(timezone.utc).replace(tzinfo=None), list(tables))],
        "run_id string, committed_at timestamp_ntz, tables array<string>")
    append_report(commit, commit_log)


def publish_checked(spark: SparkSession, targets: Mapping[str, Target], commit_log: str,
                    missing_column: str = "skip", report_path: str | None = None) -> Published:
    """Write, check and commit ``targets`` as one run; with ``report_path`` every
    check result is also appended to the quality-report area, pass or fail."""
    out = Published(new_run_id())
    paths = {name: run_path(t.path, out.run_id) for name, t in targets.items()}
    blocked = []
    observed = {name: ObservedChecks(t.df, t.checks, missing_column) for name, t in targets.items()}
    for name, t in targets.items():
        if t.partitions:
            write_partitioned(observed[name].df, paths[name], t.partitions)
        else:
            write_table(observed[name].df, paths[name])
    for name, t in targets.items():
        # the frame's schema, as partition folders alone carry no files when it is empty
        res = observed[name].results(lambda: spark.read.schema(t.df.schema).parquet(paths[name]))
        out.results[name] = res
        out.scores[name] = score(res)
        if out.scores[name]["blocked"]:
            blocked.append(name)
    if report_path:
        append_report(report_frame(spark, out.results, out.scores), report_path)
    if blocked:
        for path in paths.values():
            delete_folder(spark, path)
        raise DataQualityError(f"critical data-quality failure in {blocked}: nothing published")
    commit_run(spark, commit_log, out.run_id, sorted(targets))
    out.written = paths
    return out
