"""Keyed dedup (WIN-1, SET-2/3, FLT-3): fixtures E4-E6 and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_text
from tessera.operators.dedup import dedup_by_contract, drop_missing_keys, keep_latest

T1 = dt.datetime(2024, 1, 1, 10)
T2 = dt.datetime(2024, 1, 2, 10)
SCHEMA = "ano int, id_aluno long, payload string, _ingestion_timestamp timestamp_ntz"


def test_latest_row_survives(spark):  # E4
    df = spark.createDataFrame([(2024, 1, "old", T1), (2024, 1, "new", T2)], SCHEMA)
    out = dedup_by_contract(df, ("ano", "id_aluno"), ("_ingestion_timestamp",)).collect()
    assert [r.payload for r in out] == ["new"]


def test_tie_is_deterministic(spark):  # E5
    rows = [(2024, 1, "a", T1), (2024, 1, "b", T1), (2024, 1, "c", T1)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA).repartition(3)
        out = dedup_by_contract(df, ("ano", "id_aluno"), ("_ingestion_timestamp",)).collect()
        assert [r.payload for r in out] == ["c"]


def test_null_and_sentinel_keys_dropped(spark):  # E6, D13
    df = spark.createDataFrame([(None, "x"), ("", "y"), ("N/A", "z"), ("k", "w")], "k string, v string")
    assert [r.k for r in drop_missing_keys(df, ["k"]).collect()] == ["k"]


def test_no_key_passes_through(spark):  # SET-3
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert dedup_by_contract(df, None).count() == 2
    assert dedup_by_contract(df, ("missing",)).count() == 2


def test_partial_group_limit_before_shuffle(spark):
    df = spark.createDataFrame([(2024, 1, "a", T1)], SCHEMA)
    plan = plan_text(keep_latest(df, ("ano", "id_aluno"), ("_ingestion_timestamp",)))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 3)),
                min_size=1, max_size=40))
def test_dedup_gives_unique_keys_property(spark, rows):
    df = spark.createDataFrame(rows, "k1 int, k2 int, v int")
    out = keep_latest(df, ("k1", "k2"), ("v",))
    got = {(r.k1, r.k2): r.v for r in out.collect()}
    assert out.count() == len(got) == len({(a, b) for a, b, _ in rows})
    for (a, b), v in got.items():
        assert v == max(x for p, q, x in rows if (p, q) == (a, b))


def test_hot_key_keeps_one_row(spark):
    # one key holding most rows across many partitions still yields one row
    df = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("v")).repartition(16)
    out = keep_latest(df, ("k",), ("v",)).collect()
    assert len(out) == 1 and out[0].v == 19999


def test_missing_key_rows_complement(spark):  # D13 quarantine
    from tessera.operators.dedup import missing_key_rows
    df = spark.createDataFrame([(None, "x"), ("", "y"), ("N/A", "z"), ("k", "w")], "k string, v string")
    kept = {r.v for r in drop_missing_keys(df, ["k"]).collect()}
    rejected = {r.v for r in missing_key_rows(df, ["k"]).collect()}
    assert kept == {"w"} and rejected == {"x", "y", "z"}
