"""Data-quality engine (DQ-1..10, OBS-1): every kind x pass/warn/fail/skip, E13-E17."""

import pytest

from tessera.contracts import CITY_JOB_CHECKS, GOLD_CHECKS, RULE_SETS, Check
from tessera.operators import quality as dq
from conftest import plan_text


def _status(spark, rows, schema, check):
    df = spark.createDataFrame(rows, schema)
    return dq.run_checks(df, [check])[0]


def test_not_null_counts_sentinel_on_text_only(spark):  # DQ-1, D1
    r = _status(spark, [("a", 1), ("N/A", None), (None, 2)], "s string, i int", Check("not_null", "s"))
    assert (r.observed, r.status) == (2, "FAIL")
    r = _status(spark, [("a", 1), ("N/A", None)], "s string, i int", Check("not_null", "i"))
    assert (r.observed, r.status) == (1, "FAIL")
    r = _status(spark, [("N/A",)], "s string", Check("not_null", "s", sentinel_is_null=False))
    assert r.status == "PASS"


def test_min_count(spark):  # DQ-2
    assert _status(spark, [(1,)], "a int", Check("min_count", value=1)).status == "PASS"
    r = _status(spark, [(1,)], "a int", Check("min_count", value=2, critical=False))
    assert (r.observed, r.status) == (1, "WARN")


def test_unique_counts_null_as_value(spark):  # DQ-3, AGG-7
    r = _status(spark, [(1,), (1,), (None,), (None,)], "a int", Check("unique", "a"))
    assert r.observed == 2 and r.status == "FAIL"
    assert _status(spark, [(1,), (2,)], "a int", Check("unique", "a")).observed == 0


def test_regex_state_codes(spark):  # DQ-4, E13
    rows = [("SP",), ("sp",), ("N/A",), (None,)]
    r = _status(spark, rows, "s string", Check("regex", "s", r"^[A-Z]{2}$", critical=False))
    assert (r.observed, r.status) == (1, "WARN")
    r = _status(spark, rows, "s string",
                Check("regex", "s", r"^[A-Z]{2}$", regex_exempt_sentinel=False))
    assert r.observed == 2


def test_range_null_passes_nan_fails(spark):  # DQ-5, E14
    rows = [(-1.0,), (0.0,), (100.0,), (100.01,), (None,), (float("nan"),)]
    r = _status(spark, rows, "x double", Check("range", "x", (0.0, 100.0)))
    assert r.observed == 3 and r.status == "FAIL"


def test_missing_column_skip_or_fail(spark):  # DQ-8, E16
    df = spark.createDataFrame([(1,)], "a int")
    checks = [Check("min_count", value=1), Check("not_null", "zz")]
    res = dq.run_checks(df, checks)
    assert [r.status for r in res] == ["PASS", "SKIP"]
    s = dq.score(res)
    assert s["score"] == 50.0 and s["n_skipped"] == 1 and not s["blocked"]
    res = dq.run_checks(df, checks, missing_column="fail")
    assert res[1].status == "FAIL"


def test_gate_blocks_on_critical_only(spark):  # DQ-6, E17
    df = spark.createDataFrame([("sp",)], "sigla_uf string")
    warn = dq.run_checks(df, [Check("regex", "sigla_uf", r"^[A-Z]{2}$", critical=False)])
    assert dq.gate(warn)["n_failed"] == 1
    crit = dq.run_checks(df, [Check("regex", "sigla_uf", r"^[A-Z]{2}$", critical=True)])
    with pytest.raises(dq.DataQualityError):
        dq.gate(crit)


def test_score_formula(spark):  # DQ-7
    df = spark.createDataFrame([(1,), (1,)], "a int")
    res = dq.run_checks(df, [Check("min_count", value=1), Check("unique", "a"),
                             Check("not_null", "a")])
    assert dq.score(res)["score"] == 66.7
    assert dq.score([])["score"] == 100.0
    rep = dq.score_report(dq.check_report(df, [Check("min_count", value=1), Check("unique", "a"),
                                               Check("not_null", "a")])).first()
    assert (rep.score, rep.n_passed, rep.n_failed, rep.blocked) == (66.7, 2, 1, True)


def test_all_checks_one_pass(spark, tmp_dir):  # OBS-1
    spark.range(1000).selectExpr("id", "cast(id % 7 as string) s").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    checks = [Check("min_count", value=1), Check("not_null", "s"), Check("unique", "id"),
              Check("regex", "s", "^[0-9]$"), Check("range", "id", (0, 10))]
    plan = plan_text(dq.check_report(df, checks), "simple")
    assert plan.count("FileScan parquet") == 1
    assert [r.status for r in dq.run_checks(df, checks)] == ["PASS", "PASS", "PASS", "PASS", "FAIL"]


def test_rule_sets_complete():  # DQ-10
    assert set(RULE_SETS) == {"common", "students_job", "city_job", "gold"}
    assert any(c.kind == "unique" for c in CITY_JOB_CHECKS["uf"])
    assert len(GOLD_CHECKS) == 3


def test_duplicate_groups(spark):  # AGG-6
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [tuple(r) for r in dq.duplicate_groups(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert dq.duplicate_groups(spark.createDataFrame([(1,), (2,)], "a int"), ["a"]).isEmpty()


def test_violation_filters(spark):  # FLT-5 / FLT-6
    df = spark.createDataFrame([("SP", 5.0), ("sp", 101.0), ("N/A", None)], "s string, x double")
    got = dq.rule_violations(df, ["s"], [Check("regex", "s", "^[A-Z]{2}$"),
                                         Check("range", "x", (0, 100))])
    assert sorted(tuple(r) for r in got.collect()) == [("sp", "range:x"), ("sp", "regex:s")]


def test_check_error_becomes_failed_check(spark):  # DQ-9
    df = spark.createDataFrame([("SP",)], "s string")
    res = dq.run_checks(df, [Check("min_count", value=1), Check("regex", "s", "[unclosed"),
                             Check("not_null", "s")])
    assert [r.status for r in res] == ["PASS", "FAIL", "PASS"]
    assert "error" in res[1].detail


def test_rule_sets_scored_in_one_pass(spark, tmp_dir):  # DQ-7 / DQ-10
    spark.range(10).selectExpr("id % 5 AS id_aluno", "2024 AS ano").write.parquet(f"{tmp_dir}/s")
    df = spark.read.parquet(f"{tmp_dir}/s")
    sets = {k: RULE_SETS[k]["alunos"] for k in ("common", "city_job")}
    out = dq.rule_set_scores(df, sets)
    assert plan_text(out, "simple").count("FileScan parquet") == 1
    got = {r.rule_set: (r.n_checks, r.n_passed, r.score, r.blocked) for r in out.collect()}
    assert got == {"common": (3, 3, 100.0, False), "city_job": (4, 3, 75.0, True)}


def test_rule_violations_one_pass(spark, tmp_dir):  # FLT-5 / FLT-6 together
    spark.createDataFrame([(1, "SP", 5.0), (2, "sp", 101.0), (3, "N/A", None), (4, "xx", -1.0)],
                          "id int, s string, x double").write.parquet(f"{tmp_dir}/v")
    df = spark.read.parquet(f"{tmp_dir}/v")
    out = dq.rule_violations(df, ["id"], [Check("regex", "s", "^[A-Z]{2}$"),
                                          Check("range", "x", (0, 100))])
    assert plan_text(out, "simple").count("FileScan parquet") == 1
    assert sorted(map(tuple, out.collect())) == [(2, "range:x"), (2, "regex:s"), (4, "range:x"),
                                                 (4, "regex:s")]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["PASS", "FAIL", "WARN", "SKIP"]), max_size=12))
def test_score_in_range_property(statuses):  # DQ-7 property
    res = [dq.CheckResult(Check("min_count", value=1, critical=(s == "FAIL")), 0, s == "PASS", s, "")
           for s in statuses]
    s = dq.score(res)
    assert 0.0 <= s["score"] <= 100.0
    assert s["n_passed"] + s["n_failed"] + s["n_skipped"] == s["n_checks"]
    assert s["blocked"] == ("FAIL" in statuses)


def test_unique_on_text_uses_digest_same_result(spark):  # DQ-3 on long text
    long = "x" * 5000
    df = spark.createDataFrame([(long,), (long,), ("y",), (None,), (None,)], "t string")
    r = dq.run_checks(df, [Check("unique", "t")])[0]
    assert r.observed == 2                       # 5 rows - 3 distinct values (NULL counts once)
    assert "sha2" in plan_text(dq.check_report(df, [Check("unique", "t")]), "simple")


def test_checks_on_empty_table(spark):  # no rows: no nulls, no duplicates, too few rows
    df = spark.createDataFrame([], "a int, s string")
    res = dq.run_checks(df, [Check("unique", "a"), Check("not_null", "s"),
                             Check("regex", "s", "^x$"), Check("range", "a", (0, 1)),
                             Check("min_count", value=1)])
    assert [(r.observed, r.status) for r in res] == [(0, "PASS"), (0, "PASS"), (0, "PASS"),
                                                    (0, "PASS"), (0, "FAIL")]
