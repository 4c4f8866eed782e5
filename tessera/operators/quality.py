"""Data-quality checks, severities, score and the write gate (DQ-1 .. DQ-10, OBS-1).

All checks of one table are evaluated in ONE aggregate over one scan: each
check becomes a ``count_if`` / ``count`` / ``count(DISTINCT)`` column of a
single ``agg``. Counts are combined map-side, one small row per task; a
``unique`` check shuffles its column's distinct values (digests of text). The
driver receives a single row.

Semantics kept from the original jobs:
  not_null  rows that are NULL (or the 'N/A' text sentinel) must be 0
  min_count row count >= value
  unique    count(*) - count(DISTINCT col) must be 0; NULL counts as one value
  regex     non-NULL (and non-sentinel) values must match; others pass
  range     values outside [lo, hi] must be 0; NULL passes, NaN fails
  severity  failed critical -> FAIL, failed non-critical -> WARN
  missing column -> SKIP (kept in the score denominator), or a failed check
  score     round(passed / n_checks * 100, 1); no checks -> 100
Comparisons against the sentinel / patterns happen on text only, so no check
raises under ANSI mode (D1).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import (AnalysisException, ArithmeticException, DateTimeException,
                            IllegalArgumentException, NumberFormatException, SparkRuntimeException)
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tessera.constants import MISSING_TEXT
from tessera.contracts import Check

log = logging.getLogger(__name__)

# errors a check's own pattern, bounds or column can cause
CHECK_ERRORS = (AnalysisException, ArithmeticException, DateTimeException,
                IllegalArgumentException, NumberFormatException, SparkRuntimeException)

PASS, FAIL, WARN, SKIP = "PASS", "FAIL", "WARN", "SKIP"


class DataQualityError(RuntimeError):
    """A critical check failed: the write is refused."""


@dataclass(frozen=True)
class CheckResult:
    check: Check
    observed: int | None
    passed: bool
    status: str
    detail: str


def _metric(check: Check, df: DataFrame) -> Column | None:
    """The aggregate expression measuring one check (None for min_count)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    c = F.col(check.column) if check.column else None
    is_text = check.column is not None and isinstance(types.get(check.column), StringType)
    if check.kind == "not_null":
        bad = c.isNull()
        if check.sentinel_is_null and is_text:
            bad = bad | (c == F.lit(MISSING_TEXT))
        return F.count_if(bad)
    if check.kind == "regex":
        text = c if is_text else c.cast("string")
        cand = text.isNotNull()
        if check.regex_exempt_sentinel:
            cand = cand & (text != F.lit(MISSING_TEXT))
        return F.count_if(cand & ~text.rlike(str(check.value)))
    if check.kind == "range":
        lo, hi = check.value
        num = c.try_cast("double")
        return F.count_if((num < F.lit(float(lo))) | (num > F.lit(float(hi))))
    if check.kind == "unique":
        # distinct().count() counts NULL as one value; count(DISTINCT) does not.
        # Text is compared by its 32-byte SHA-256 digest: the distinct step then
        # shuffles digests, not whole documents (collision odds ~2^-128).
        key = F.unhex(F.sha2(c, 256)) if isinstance(types.get(check.column),
                                                    (StringType, BinaryType)) else c
        # coalesce: max() over an empty table is NULL, and 0 rows hold 0 duplicates
        return (F.count_distinct(key)
                + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))).cast("long")
    if check.kind == "min_count":
        return None
    raise ValueError(f"unknown check kind {check.kind!r}")


def _status(check: Check, ok: bool) -> str:
    return PASS if ok else (FAIL if check.critical else WARN)


def _lit_str(v) -> Column:
    return F.lit(v).cast("string")


def check_report(df: DataFrame, checks: Sequence[Check],
                 missing_column: str = "skip", with_position: bool = False) -> DataFrame:
    """Lazy DQ report: one row per check, all checks measured in ONE aggregate.

    Columns: check_name, kind, column_name, critical, observed, passed, status.
    ``missing_column``: 'skip' (SKIP row, observed NULL) or 'fail' (failed check).
    ``with_position`` adds ``_pos``, the check's index in ``checks``.
    """
    metrics = [F.count(F.lit(1)).alias("_n")]
    for i, chk in enumerate(checks):
        if chk.column and chk.column not in df.columns:
            continue
        m = _metric(chk, df)
        if m is not None:
            metrics.append(m.alias(f"_m{i}"))
    agg = df.agg(*metrics)
    n = F.col("_n")
    rows = []
    for i, chk in enumerate(checks):
        if chk.column and chk.column not in df.columns:
            observed = F.lit(None).cast("long")
            passed = F.lit(False)
            status = F.lit(SKIP) if missing_column == "skip" else F.lit(_status(chk, False))
        else:
            if chk.kind == "min_count":
                observed = n
                passed = n >= F.lit(int(chk.value))
            elif chk.kind == "unique":
                observed = n - F.col(f"_m{i}")
                passed = observed == 0
            else:
                observed = F.col(f"_m{i}")
                passed = observed == 0
            status = F.when(passed, F.lit(PASS)).otherwise(
                F.lit(FAIL if chk.critical else WARN))
        pos = [F.lit(i).alias("_pos")] if with_position else []
        rows.append(F.struct(*pos, _lit_str(chk.name).alias("check_name"),
                             _lit_str(chk.kind).alias("kind"),
                             _lit_str(chk.column).alias("column_name"),
                             F.lit(chk.critical).alias("critical"),
                             observed.cast("long").alias("observed"),
                             passed.alias("passed"), status.alias("status")))
    if not rows:
        return agg.select(F.explode(F.array().cast(
            "array<struct<check_name:string,kind:string,column_name:string,critical:boolean,"
            "observed:bigint,passed:boolean,status:string>>")).alias("r")).select("r.*")
    return agg.select(F.inline(F.array(*rows)))


def _detail(chk: Check, observed: int | None, status: str) -> str:
    if status == SKIP or (observed is None and chk.column):
        return f"column {chk.column!r} not found"
    if chk.kind == "min_count":
        return f"count={observed} minimum={chk.value}"
    if chk.kind == "unique":
        return f"{observed} duplicates"
    if chk.kind == "not_null":
        return f"{observed} null/{MISSING_TEXT} values"
    if chk.kind == "regex":
        return f"{observed} values not matching {chk.value}"
    return f"{observed} values outside {list(chk.value)}"


def _from_row(chk: Check, r) -> CheckResult:
    obs = None if r["observed"] is None else int(r["observed"])
    return CheckResult(chk, obs, bool(r["passed"]), r["status"], _detail(chk, obs, r["status"]))


def _pattern_error(spark: SparkSession, chk: Check) -> str | None:
    """What is wrong with a check's pattern, found before any task compiles it."""
    if chk.kind != "regex":
        return None
    try:
        spark._jvm.java.util.regex.Pattern.compile(str(chk.value))
    except IllegalArgumentException as e:
        return str(e).strip()
    return None


def _failed(chk: Check, message: str) -> CheckResult:
    return CheckResult(chk, None, False, _status(chk, False),
                       f"error while evaluating check: {message}")


def run_checks(df: DataFrame, checks: Sequence[Check],
               missing_column: str = "skip") -> list[CheckResult]:
    """Evaluate all checks in one pass (one job); one small row per check returned.

    DQ-9: if a check itself is at fault (a malformed pattern, a value that does
    not fit), each check is evaluated on its own and the one that raises becomes
    a failed check carrying the error message; the others keep their results.
    Any other error, such as a lost executor or a missing file, is raised.
    """
    if not checks:
        return []
    errors = [_pattern_error(df.sparkSession, c) for c in checks]
    good = [c for c, e in zip(checks, errors) if e is None]
    try:
        rows = check_report(df, good, missing_column).collect() if good else []
        results = [_from_row(c, r) for c, r in zip(good, rows)]
    except CHECK_ERRORS:      # isolate the failing check below
        results = []
        for chk in good:
            try:
                results.append(_from_row(chk, check_report(df, [chk], missing_column).first()))
            except CHECK_ERRORS as e:
                results.append(_failed(chk, str(e).strip()))
    measured = iter(results)
    out = [next(measured) if e is None else _failed(c, e) for c, e in zip(checks, errors)]
    for r in out:
        log.info("[DQ] %s | %s | %s", r.status, r.check.name, r.detail)
    return out


#: Checks whose measure is a sum over rows, so that the write itself can take it.
ROW_CHECKS = ("min_count", "not_null", "regex", "range")


class ObservedChecks:
    """OBS-1: row checks measured by the write of a frame, with no pass of their own.

    Write :attr:`df`, then ask for :meth:`results`. The counts ride as an
    ``Observation`` on top of the plan, that is in the tasks that write the files:
    a task that is run again after a loss counts once. Only ``unique``
    checks read what was written (their column alone). A pattern that does not
    compile is never sent to the tasks and becomes a failed check (DQ-9).
    """

    def __init__(self, df: DataFrame, checks: Sequence[Check], missing_column: str = "skip") -> None:
        self.checks, self.missing_column = list(checks), missing_column
        self.errors = [_pattern_error(df.sparkSession, c) for c in self.checks]
        self.present = [not c.column or c.column in df.columns for c in self.checks]
        metrics = [F.count(F.lit(1)).alias("_n")]
        for i, chk in enumerate(self.checks):
            if (self.errors[i] is None and self.present[i] and chk.kind in ROW_CHECKS
                    and (m := _metric(chk, df)) is not None):
                metrics.append(m.alias(f"_m{i}"))
        self.observation = Observation()
        self.df = df.observe(self.observation, *metrics) if self.checks else df

    def results(self, written: Callable[[], DataFrame]) -> list[CheckResult]:
        """Results in the checks' order; ``written`` gives the written rows, for ``unique`` checks."""
        if not self.checks:
            return []
        seen: dict = self.observation.get
        again = [i for i, c in enumerate(self.checks) if c.kind == "unique" and self.present[i]]
        counted = iter(run_checks(written(), [self.checks[i] for i in again]) if again else [])
        out = []
        for i, chk in enumerate(self.checks):
            if i in again:
                out.append(next(counted))
                continue
            if self.errors[i] is not None:
                result = _failed(chk, self.errors[i])
            elif not self.present[i]:
                status = SKIP if self.missing_column == "skip" else _status(chk, False)
                result = CheckResult(chk, None, False, status, _detail(chk, None, status))
            else:
                observed = int(seen["_n"] if chk.kind == "min_count" else seen[f"_m{i}"])
                ok = observed >= int(chk.value) if chk.kind == "min_count" else observed == 0
                status = PASS if ok else _status(chk, False)
                result = CheckResult(chk, observed, ok, status, _detail(chk, observed, status))
            log.info("[DQ] %s | %s | %s", result.status, chk.name, result.detail)
            out.append(result)
        return out


def score_report(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lazy score row (per ``by`` group) over a check report; skipped checks
    stay in the denominator."""
    n = F.count(F.lit(1))
    passed = F.count_if(F.col("passed"))
    skipped = F.count_if(F.col("status") == SKIP)
    crit = F.count_if(F.col("status") == FAIL)
    return report.groupBy(*by).agg(
        n.cast("long").alias("n_checks"), passed.cast("long").alias("n_passed"),
        (n - passed - skipped).cast("long").alias("n_failed"),
        skipped.cast("long").alias("n_skipped"), crit.cast("long").alias("n_critical_failed"),
        F.coalesce(F.bround(F.try_divide(passed, n) * 100, 1), F.lit(100.0)).alias("score"),
        (crit > 0).alias("blocked"))


def rule_set_scores(df: DataFrame, rule_sets: Mapping[str, Sequence[Check]],
                    missing_column: str | Mapping[str, str] = "skip") -> DataFrame:
    """Score several rule sets over one table with ONE pass over the data.

    ``missing_column`` is one policy for all rule sets or one for each (DQ-8):
    the same absent column can be skipped under one and fail under another.

    The distinct checks of all rule sets are measured in a single aggregate
    (one row per check, tagged with its position); a literal membership table
    maps rule sets to positions and one group-by over that tiny report scores
    every rule set. Rule sets without checks are left out.
    """
    unique: list[Check] = []
    for checks in rule_sets.values():
        for c in checks:
            if c not in unique:
                unique.append(c)
    report = check_report(df, unique, "skip", with_position=True)
    policy = missing_column if isinstance(missing_column, Mapping) else dict.fromkeys(rule_sets, missing_column)
    pairs = [F.struct(F.lit(name).alias("rule_set"), F.lit(unique.index(c)).alias("_pos"),
                      F.lit(policy.get(name, "skip") == "fail").alias("_fails"))
             for name, checks in rule_sets.items() for c in checks]
    membership = report.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    failed = F.when(F.col("critical"), F.lit(FAIL)).otherwise(F.lit(WARN))
    # the report holds one row per distinct check: its size is fixed by the rule sets
    rows = membership.join(F.broadcast(report), "_pos").withColumn(
        "status", F.when(F.col("_fails") & (F.col("status") == SKIP), failed).otherwise(F.col("status")))
    return score_report(rows, by=("rule_set",))


def score(results: Sequence[CheckResult]) -> dict:
    """Counts and score; skipped checks stay in the denominator (D9)."""
    n = len(results)
    passed = sum(r.passed for r in results)
    skipped = sum(r.status == SKIP for r in results)
    crit = sum(r.status == FAIL for r in results)
    value = round(passed / n * 100, 1) if n else 100.0
    return {"n_checks": n, "n_passed": passed, "n_failed": n - passed - skipped,
            "n_skipped": skipped, "n_critical_failed": crit, "score": value,
            "blocked": crit > 0}


def gate(results: Sequence[CheckResult], what: str = "") -> dict:
    """Raise :class:`DataQualityError` when a critical check failed; return the score."""
    s = score(results)
    log.info("[DQ] %s score=%s passed=%s failed=%s skipped=%s", what, s["score"],
             s["n_passed"], s["n_failed"], s["n_skipped"])
    if s["blocked"]:
        raise DataQualityError(f"{s['n_critical_failed']} critical check(s) failed for "
                               f"{what or 'table'}: write refused")
    return s


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-6: key groups with more than one row (with their row count)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def rule_violations(df: DataFrame, id_columns: Sequence[str],
                    checks: Sequence[Check]) -> DataFrame:
    """FLT-5 / FLT-6 for several rules in ONE pass: (ids..., rule) per violation.

    Each row gets the array of rules it breaks (regex / range semantics as in
    the checks: NULL passes, sentinel exempt when asked); rows breaking none
    are dropped, the others exploded to one row per broken rule.
    """
    flags = []
    for chk in checks:
        c = F.col(chk.column)
        if chk.kind == "regex":
            t = c.cast("string")
            bad = t.isNotNull() & ~t.rlike(str(chk.value))
            if chk.regex_exempt_sentinel:
                bad = bad & (t != F.lit(MISSING_TEXT))
        elif chk.kind == "range":
            lo, hi = chk.value
            x = c.try_cast("double")
            bad = (x < F.lit(float(lo))) | (x > F.lit(float(hi)))
        else:
            raise ValueError(f"row-level rule expected, got {chk.kind!r}")
        flags.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(chk.name)))
    broken = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return (df.select(*id_columns, broken.alias("_rules")).where(F.size("_rules") > 0)
            .select(*id_columns, F.explode("_rules").alias("rule")))


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """PIPE-7: persist around multi-pass work, always released.

    A lost executor only loses cached blocks; Spark recomputes them from the
    lineage, so the job survives.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
