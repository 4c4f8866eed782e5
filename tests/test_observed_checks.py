"""Checks measured by the write itself (OBS-1) and absent columns by rule set (DQ-8)."""

import pytest
from pyspark.sql import functions as F

from tessera.contracts import Check
from tessera.operators import quality as dq
from tessera.operators.quality import DataQualityError, ObservedChecks, rule_set_scores, run_checks
from tessera.plans.publish import Target, publish_checked

CHECKS = (Check("min_count", value=2), Check("not_null", "a"), Check("not_null", "t", critical=False),
          Check("regex", "t", r"^[a-z]+$", critical=False), Check("range", "x", (0.0, 1.0), critical=False),
          Check("unique", "a", critical=False), Check("not_null", "gone", critical=False),
          Check("regex", "t", "([", critical=False))


def frame(spark):
    rows = [(1, "abc", 0.5), (1, "N/A", float("nan")), (2, None, 3.0), (3, "A1", None)]
    return spark.createDataFrame(rows, "a int, t string, x double")


@pytest.mark.parametrize("policy", ["skip", "fail"])
def test_observed_checks_equal_a_pass_of_their_own(spark, tmp_dir, policy):
    df = frame(spark)
    for n, part in enumerate((df, df.where("a > 5"), df.groupBy("a").agg(F.max("t").alias("t"),
                                                                         F.max("x").alias("x")))):
        observed = ObservedChecks(part, CHECKS, policy)
        observed.df.write.parquet(f"{tmp_dir}/{n}")
        got = observed.results(lambda n=n: spark.read.parquet(f"{tmp_dir}/{n}"))
        key = lambda r: (r.check, r.observed, r.passed, r.status, r.detail)
        assert [key(r) for r in got] == [key(r) for r in run_checks(part, CHECKS, policy)]


def test_a_publication_without_unique_reads_no_written_file(spark, tmp_dir, monkeypatch):
    def refuse(*args, **more):
        raise AssertionError("the written files were read for a row check")

    monkeypatch.setattr(dq, "run_checks", refuse)
    row_checks = tuple(c for c in CHECKS if c.kind != "unique")
    out = publish_checked(spark, {"t": Target(frame(spark), f"{tmp_dir}/t", ("a",), row_checks)},
                          f"{tmp_dir}/commits")
    assert [r.observed for r in out.results["t"]] == [4, 0, 2, 1, 2, None, None]
    with pytest.raises(AssertionError, match="written files"):
        publish_checked(spark, {"t": Target(frame(spark), f"{tmp_dir}/u", (), CHECKS)}, f"{tmp_dir}/commits")


def test_a_critical_failure_still_publishes_nothing(spark, tmp_dir):
    bad = {"good": Target(frame(spark), f"{tmp_dir}/good", (), (Check("min_count", value=1),)),
           "bad": Target(frame(spark), f"{tmp_dir}/bad", (), (Check("min_count", value=5),))}
    with pytest.raises(DataQualityError, match="bad"):
        publish_checked(spark, bad, f"{tmp_dir}/commits", report_path=f"{tmp_dir}/reports")
    import os
    assert not any(os.path.exists(f"{tmp_dir}/{x}") and os.listdir(f"{tmp_dir}/{x}") for x in ("good", "bad"))
    assert spark.read.parquet(f"{tmp_dir}/reports").count() == 2


def test_each_rule_set_takes_an_absent_column_its_own_way(spark):
    sets = {"lenient": (Check("min_count", value=1), Check("not_null", "gone")),
            "strict": (Check("min_count", value=1), Check("not_null", "gone")),
            "warns": (Check("not_null", "gone", critical=False),)}
    got = {r.rule_set: (r.n_passed, r.n_failed, r.n_skipped, r.n_critical_failed, r.score, r.blocked)
           for r in rule_set_scores(frame(spark), sets, {"strict": "fail", "warns": "fail"}).collect()}
    assert got == {"lenient": (1, 0, 1, 0, 50.0, False), "strict": (1, 1, 0, 1, 50.0, True),
                   "warns": (0, 1, 0, 0, 0.0, False)}
    both = rule_set_scores(frame(spark), {"a": sets["strict"]}, "fail").first()
    assert both.blocked and both.n_skipped == 0
