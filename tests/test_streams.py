"""Streams: keyed state against redelivery, mergeable window counts, folding."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tessera.contracts import Check
from tessera.streaming.jobs import (closed_windows, drop_redelivered, fold_windows, ingest_dedup_stream,
                                    live_indicator_stream, live_windows, read_file_stream,
                                    window_writer)

SCHEMA = "event_id long, ts timestamp, event_type string, value double"
CHECKS = (Check("min_count", value=1), Check("range", "flag_rate", (0.0, 100.0)))
DAY = dt.datetime(2024, 3, 1)


def event(i, hours, kind="a", value=0.0):
    return (i, None if hours is None else DAY + dt.timedelta(hours=hours), kind, value)


def deliver(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def ingest(spark, root, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    q = ingest_dedup_stream(spark, f"{root}/src", schema, "event_id", "ts", f"{root}/sink",
                            f"{root}/ckpt", "events", max_files_per_trigger=1, **more)
    q.awaitTermination()
    return sorted((-1 if r.event_id is None else r.event_id, str(r.ts))
                  for r in spark.read.parquet(f"{root}/sink").collect())


def test_redelivery_with_another_time_is_dropped(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/src", [event(1, 1), event(2, 2), event(None, 3)])
    deliver(spark, f"{tmp_dir}/src", [event(1, 99), event(3, None), event(None, 4)])
    want = [(-1, "2024-03-01 03:00:00"), (1, "2024-03-01 01:00:00"), (2, "2024-03-01 02:00:00"), (3, "None")]
    assert ingest(spark, tmp_dir) == want
    deliver(spark, f"{tmp_dir}/src", [event(2, -500), event(3, 1), event(4, -900)])  # late, new run
    assert ingest(spark, tmp_dir) == sorted([*want, (4, "2024-01-23 12:00:00")])


def test_keys_within_the_horizon_are_remembered_and_no_late_event_is_lost(spark, tmp_dir):
    deliver(spark, f"{tmp_dir}/src", [event(1, 5000), event(2, 1)])
    deliver(spark, f"{tmp_dir}/src", [event(1, 0), event(3, -9000)])  # far behind the newest time
    assert ingest(spark, tmp_dir, horizon="30 days") == [
        (1, "2024-09-25 08:00:00"), (2, "2024-03-01 01:00:00"), (3, "2023-02-20 00:00:00")]


def test_a_horizon_bounds_the_state(spark, tmp_dir):
    plan = drop_redelivered(spark.readStream.schema("k long, _ingestion_timestamp timestamp")
                            .parquet(tmp_dir), ["k"], "7 days")
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in text and "7 days" in text


def live(spark, root, name, files):
    schema = spark.createDataFrame([], SCHEMA).schema
    q = live_indicator_stream(spark, f"{root}/src", schema, "ts", F.col("value") >= 50, f"{root}/{name}",
                              f"{root}/c-{name}", CHECKS, max_files_per_trigger=files)
    q.awaitTermination()
    return q


def table(df):
    return sorted(map(tuple, df.select("window_start", "event_type", "n_events", "n_flagged",
                                       "flag_rate").collect()))


def batches(spark, root, n=8, rows=90):
    for b in range(n):
        deliver(spark, f"{root}/src", [event(i, (i * 37 + b * 11) % 300, f"t{i % 2}", float(i % 100))
                                       for i in range(b * rows, (b + 1) * rows)] + [event(-1, None)])


def test_any_slicing_gives_the_same_windows_and_a_trigger_reads_its_batch(spark, tmp_dir):
    batches(spark, tmp_dir)
    sliced = live(spark, tmp_dir, "sliced", 1)
    live(spark, tmp_dir, "whole", 1000)
    want = table(live_windows(spark, f"{tmp_dir}/whole"))
    assert table(live_windows(spark, f"{tmp_dir}/sliced")) == want
    assert sum(r[2] for r in want) == 8 * 90
    read = [json.loads(p.json)["numInputRows"] for p in sliced.recentProgress]
    assert len([n for n in read if n]) == 8 and len(set(n for n in read if n)) == 1
    assert len([d for d in os.listdir(f"{tmp_dir}/sliced/windows") if d.startswith("batch_id=")]) == 8
    closed = table(closed_windows(spark, f"{tmp_dir}/sliced"))
    assert closed == table(closed_windows(spark, f"{tmp_dir}/whole")) and 0 < len(closed) < len(want)


def test_a_replayed_epoch_changes_nothing(spark, tmp_dir):
    rows = spark.createDataFrame([event(i, i, "t", 60.0) for i in range(40)], SCHEMA) \
        .withColumn("event_time", F.col("ts"))
    write = window_writer(f"{tmp_dir}/live", F.col("value") >= 50, CHECKS, "1 day", ("event_type",))
    write(rows.limit(20), 0)
    write(rows, 1)
    once = table(live_windows(spark, f"{tmp_dir}/live"))
    write(rows, 1)
    write(rows.limit(0), 2)          # an empty trigger writes nothing
    assert table(live_windows(spark, f"{tmp_dir}/live")) == once
    assert sum(r[2] for r in once) == 60


def test_folding_keeps_the_windows_and_the_disk_short(spark, tmp_dir):
    root = f"{tmp_dir}/live"
    rows = spark.createDataFrame([event(i, i * 7 % 200, f"t{i % 3}", float(i)) for i in range(99)], SCHEMA) \
        .withColumn("event_time", F.col("ts"))
    write = window_writer(root, F.col("value") >= 50, CHECKS, "1 day", ("event_type",))
    seen, stored = [], []
    for epoch in range(10):
        write(rows, epoch)
        before = table(live_windows(spark, root))
        reader = live_windows(spark, root)          # planned before the fold, run after it
        fold_windows(spark, root)
        assert table(live_windows(spark, root)) == before == table(reader)
        assert sum(r[2] for r in before) == 99 * (epoch + 1)
        write(rows, epoch)                          # the newest epoch may still be replayed
        assert table(live_windows(spark, root)) == before
        seen.append(len([d for d in os.listdir(f"{root}/windows") if d.startswith("batch_id=")]))
        stored.append(len([d for d in os.listdir(f"{root}/folded")] if os.path.exists(f"{root}/folded") else []))
    assert max(seen) <= 3 and max(stored) <= 3
    assert fold_windows(spark, root) == 8           # nothing new: the same answer, no new table


def test_source_with_nothing_in_it(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_file_stream(spark, f"{tmp_dir}/src", schema).isStreaming
    live(spark, tmp_dir, "none", 1)
    try:
        live_windows(spark, f"{tmp_dir}/none")
    except FileNotFoundError as e:
        assert "no windows" in str(e)
    else:
        raise AssertionError("an indicator without data must say so")
