"""Column-expression helpers (functions/): rate, deviation, flags, labels, text."""

from pyspark.sql import functions as F

from tessera.constants import STATUS_BELOW, STATUS_MET, STATUS_NO_TARGET
from tessera.functions import (count_flag, deviation, flag_is_one, goal_status, is_missing, rate,
                               target_for_year)


def test_rate_and_deviation(spark):
    df = spark.createDataFrame([(1, 3, 50.0), (0, 0, None), (2, None, 10.0)],
                               "a long, b long, t double")
    out = df.select(rate("a", "b").alias("r"), deviation(rate("a", "b"), "t").alias("d")).collect()
    assert [(r.r, r.d) for r in out] == [(33.33, -16.67), (None, None), (None, None)]


def test_flag_is_one_any_type(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("0",), ("x",), (None,)], "f string")
    assert [r.x for r in df.select(flag_is_one("f").alias("x")).collect()] == \
        [True, True, False, False, False]
    assert df.agg(count_flag("f").alias("n")).first().n == 2


def test_target_pick_and_status(spark):
    df = spark.createDataFrame([(2024, 50.0, 60.0, 55.0), (2025, 50.0, 60.0, 55.0),
                                (2023, 50.0, 60.0, 55.0)],
                               "ano int, m24 double, m25 double, rate double")
    out = df.select(target_for_year("ano", {2024: "m24", 2025: "m25"}).alias("m"), "rate") \
        .select("m", goal_status("m", F.col("rate") - F.col("m")).alias("s")).collect()
    assert [(r.m, r.s) for r in out] == [(50.0, STATUS_MET), (60.0, STATUS_BELOW),
                                         (None, STATUS_NO_TARGET)]
    assert df.select(target_for_year("ano", {}).alias("m")).first().m is None


def test_is_missing(spark):
    df = spark.createDataFrame([("N/A",), (None,), ("x",)], "s string")
    assert [r.m for r in df.select(is_missing("s").alias("m")).collect()] == [True, True, False]
