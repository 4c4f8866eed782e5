"""Size-checked broadcast with shuffle fallback (JN-1), skewed join keys, stream DQ gate (STR-3)."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from tessera.contracts import Check
from tessera.operators import indicators as ind
from tessera.streaming.jobs import gated_writer, live_indicator_stream, read_live


def test_target_join_carries_no_hint(spark, tmp_dir):  # JN-1: measured sides only
    years = {y: f"meta_{y}" for y in range(2024, 2031)}
    cities = spark.createDataFrame([(2024, "SP", 1, "A", 10, 60.0)],
                                   "ano int, sigla_uf string, id_municipio int, nome_municipio string, "
                                   "total_avaliados long, taxa_alfabetizacao_real double")
    # long city ids: few rows, many bytes
    spark.range(200).select(
        F.lit(2023).alias("ano"),
        F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 100_000)).alias("id_municipio"),
        *[F.lit(float(y)).alias(c) for y, c in years.items()]).write.parquet(f"{tmp_dir}/targets")
    targets = spark.read.parquet(f"{tmp_dir}/targets")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "1MB"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for policy in ("distinct", "by_year"):
            df = ind.target_comparison(cities, targets, years, policy)
            assert df.count() == 1
            plan = plan_text(df)
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_key_in_a_shuffle_join(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in settings:
        spark.conf.set(k, "-1")
    try:
        # one key holds a third of the big side
        big = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = big.join(dim, "k")
        assert "SortMergeJoin" in plan_text(joined)
        want = sum(2 * (7 if i % 3 == 0 else i % 1000) for i in range(30000))
        assert tuple(joined.agg(F.count("*"), F.sum("w")).first()) == (30000, want)
    finally:
        spark.conf.unset(settings[0])
        spark.conf.unset(settings[1])


def test_gated_writer_refuses_failing_batch(spark, tmp_dir):
    write = gated_writer(f"{tmp_dir}/out", [Check("min_count", value=5)])
    with pytest.raises(Exception):
        write(spark.range(3), 0)
    write(spark.range(6), 1)
    assert read_live(spark, f"{tmp_dir}/out").count() == 6
    for epoch, n in ((2, 7), (3, 8), (3, 8)):        # the last one is a replay
        write(spark.range(n), epoch)
        assert read_live(spark, f"{tmp_dir}/out").count() == n
    with pytest.raises(Exception):
        write(spark.range(3), 4)
    assert read_live(spark, f"{tmp_dir}/out").count() == 8


def test_live_indicator_stream_complete_mode(spark, tmp_dir):
    rows = [(1, "2024-01-01 10:00:00", "click", 60.0), (2, "2024-01-01 11:00:00", "click", 10.0),
            (3, "2024-01-02 09:00:00", "view", 70.0)]
    src = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    src.write.parquet(f"{tmp_dir}/src")
    q = live_indicator_stream(spark, f"{tmp_dir}/src", src.schema, "ts",
                              F.col("value") >= 50.0, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                              [Check("min_count", value=1)], output_mode="complete")
    q.awaitTermination()
    got = {(str(r.window_start), r.event_type): (r.n_events, r.n_flagged, r.flag_rate)
           for r in read_live(spark, f"{tmp_dir}/sink").collect()}
    assert got == {("2024-01-01 00:00:00", "click"): (2, 1, 50.0),
                   ("2024-01-02 00:00:00", "view"): (1, 1, 100.0)}


def test_append_batches_are_idempotent(spark, tmp_dir):
    write = gated_writer(f"{tmp_dir}/out", [Check("min_count", value=1)], mode="append")
    write(spark.range(3), 0)
    write(spark.range(3), 0)          # replay of epoch 0
    write(spark.range(2), 1)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 5


def test_empty_micro_batch_skipped(spark, tmp_dir):
    write = gated_writer(f"{tmp_dir}/out", [Check("min_count", value=1)], mode="append")
    write(spark.range(0), 0)          # no closed window yet: no error, nothing written
    write(spark.range(2), 1)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2


def test_stream_restart_is_exactly_once(spark, tmp_dir):  # STR-1/2 recovery from the checkpoint
    from tessera.streaming.jobs import ingest_dedup_stream
    rows = [(1, "2024-01-01 10:00:00", "click"), (2, "2024-01-01 11:00:00", "view")]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    df.write.parquet(src)

    def run():
        ingest_dedup_stream(spark, src, df.schema, "event_id", "ts", sink, ckpt, "events") \
            .awaitTermination()
        return spark.read.parquet(sink).count()

    assert run() == 2
    assert run() == 2                        # restart: nothing new, nothing written twice
    more = spark.createDataFrame([(3, "2024-01-01 12:00:00", "buy"), (1, "2024-01-01 10:00:00", "click")],
                                 "event_id long, ts string, event_type string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    more.write.mode("append").parquet(src)
    assert run() == 3                        # only the new event; the redelivered one is dropped
