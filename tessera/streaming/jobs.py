"""Structured Streaming jobs (STR-1 .. STR-3).

STR-1  file stream -> bronze audit columns -> Parquet sink (exactly-once via
       the checkpoint; ``availableNow`` drains what is there and stops)
STR-2  dedup by event key in keyed state (RocksDB): a key that was delivered
       before is dropped whatever its event time, and the sink is never read back
STR-3  live indicator: tumbling event-time window x type -> counts and rate;
       each micro-batch adds its own mergeable counts under its epoch, readers
       sum them, so a trigger reads nothing but its batch and late events count;
       every result passes the DQ gate in ``foreachBatch`` before it is written

Event time must be a TIMESTAMP (with zone) for watermarks; a TIMESTAMP_NTZ
source column is read as UTC wall clock (session time zone UTC).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.contracts import Check
from tessera.functions import rate
from tessera.operators.quality import cached, gate, run_checks
from tessera.plans.publish import commit_run, latest_commit, read_published, run_path
from tessera.sources.parquet import partition_values, try_read_parquet
from tessera.sources.sinks import delete_folder

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Bounded micro-batches: a backlog is drained in slices of at most this many
# files, so one trigger never has to process the whole input at once.
MAX_FILES_PER_TRIGGER = 1000


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the JVM heap (large dedup state at scale) and
    commit it as changelogs instead of full snapshots every micro-batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def read_file_stream(spark: SparkSession, source_dir: str, schema: StructType,
                     glob: str | None = None,
                     max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Parquet file stream (new files in ``source_dir`` become new micro-batches)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(source_dir)


def with_event_time(df: DataFrame, column: str, name: str = "event_time") -> DataFrame:
    """Event-time column usable by watermarks (TIMESTAMP_NTZ read as UTC)."""
    return df.withColumn(name, F.col(column).cast("timestamp"))


def stream_audit(df: DataFrame, entity: str, environment: str = "dev") -> DataFrame:
    """STR-1: bronze audit columns per micro-batch (processing time, source file)."""
    return df.withColumns({
        "_ingestion_timestamp": F.current_timestamp(),
        "_source_path": F.col("_metadata.file_path"),
        "_source_entity": F.lit(entity),
        "_environment": F.lit(environment),
    })


def drop_redelivered(df: DataFrame, keys: Sequence[str], horizon: str | None = None,
                     arrival: str = "_ingestion_timestamp") -> DataFrame:
    """STR-2: the first delivery of each key; state holds the keys, not the rows.

    ``horizon`` says how long after its first delivery a key is remembered; with
    None it never is forgotten, and state grows with the number of keys. The
    horizon counts in arrival time (``arrival``, the trigger's processing time),
    so no event is too late by its own time, and none is lost. A copy
    that comes after the horizon is kept as new. Of copies within one trigger
    one is kept; which one is not defined. A null key is a key.

    All rows of a key go to the state partition of its hash: a hot key costs its
    task one state lookup a row, at most the rows of one trigger
    (``maxFilesPerTrigger``).
    """
    if horizon is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(arrival, horizon).dropDuplicatesWithinWatermark(list(keys))


def ingest_dedup_stream(spark: SparkSession, source_dir: str, schema: StructType, key: str,
                        time_column: str, sink_dir: str, checkpoint: str, entity: str,
                        max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                        horizon: str | None = None) -> StreamingQuery:
    """STR-1 + STR-2 as one query: read, stamp, drop redelivered keys, append to the sink.

    State and the sink's file log advance together with the checkpoint: a
    trigger that is replayed after a failure starts from the state before it and
    adds the same rows once.
    """
    use_rocksdb_state(spark)
    src = read_file_stream(spark, source_dir, schema, max_files_per_trigger=max_files_per_trigger)
    out = drop_redelivered(stream_audit(src, entity), [key], horizon).withColumn(
        "event_date", F.coalesce(F.date_format(F.col(time_column), "yyyy-MM-dd"), F.lit("none")))
    return (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .partitionBy("event_date").option("path", sink_dir).trigger(availableNow=True).start())


def windowed_indicator(df: DataFrame, flag: Column, event_time: str = "event_time",
                       window: str = "1 day", by: Sequence[str] = ("event_type",),
                       delay: str | None = "1 day") -> DataFrame:
    """STR-3: per (window, group) -> n_events, n_flagged, rate (= AGG-1 on a stream)."""
    return ((df.withWatermark(event_time, delay) if delay else df)
            .groupBy(F.window(event_time, window).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.when(flag, 1).otherwise(0)).cast("long").alias("n_flagged"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by,
                    "n_events", "n_flagged", rate("n_flagged", "n_events").alias("flag_rate")))


def _epoch(epoch_id: int) -> str:
    return f"{epoch_id:018d}"        # sorts as text like the number


def _log(path: str) -> str:
    return f"{path.rstrip('/')}_commits"


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed table of a complete-mode :func:`gated_writer`."""
    return read_published(spark, path, _log(path))


def gated_writer(path: str, checks: Sequence[Check], mode: str = "overwrite"):
    """``foreachBatch`` function: DQ gate on the micro-batch result, then write.

    A critical failure raises, the micro-batch is not committed and the
    previous output stays in place; the query resumes from its checkpoint.
    ``mode="overwrite"`` replaces the table (complete mode): each epoch writes a
    run folder and commits it, so a write that fails leaves the last one readable
    (:func:`read_live`); folders before the last are deleted. ``mode="append"``
    writes each epoch to its own ``batch_id=N`` folder with overwrite, so a
    micro-batch replayed after a failure rewrites its folder instead of
    appending its rows twice (idempotent, exactly-once output).
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        with cached(batch) as batch:
            if batch.isEmpty():          # nothing in this trigger: skipped (FLT-4)
                return
            gate(run_checks(batch, list(checks)), f"micro-batch {epoch_id}")
            if mode == "append":
                batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={epoch_id}")
            else:
                batch.write.mode("overwrite").parquet(run_path(path, _epoch(epoch_id)))
                commit_run(batch.sparkSession, _log(path), _epoch(epoch_id), ["live"])
                delete_folder(batch.sparkSession, run_path(path, _epoch(epoch_id - 2)))
    return write


def window_counts(df: DataFrame, flag: Column, event_time: str, window: str,
                  by: Sequence[str]) -> DataFrame:
    """Counts that add up: (window, by...) -> n_events, n_flagged and the latest event time."""
    return (df.where(F.col(event_time).isNotNull())
            .groupBy(F.window(event_time, window).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.when(flag, 1).otherwise(0)).cast("long").alias("n_flagged"),
                 F.max(event_time).cast("timestamp_ntz").alias("latest"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by,
                    "n_events", "n_flagged", "latest"))


COUNTS = ("n_events", "n_flagged", "latest")


def merged_counts(counts: DataFrame) -> DataFrame:
    """Counts of several batches as one row a window and group."""
    by = [c for c in counts.columns if c not in COUNTS]
    return counts.groupBy(*by).agg(F.sum("n_events").alias("n_events"),
                                   F.sum("n_flagged").alias("n_flagged"),
                                   F.max("latest").alias("latest"))


def window_writer(sink_dir: str, flag: Column, checks: Sequence[Check], window: str,
                  by: Sequence[str]):
    """``foreachBatch`` function for STR-3: add the batch's own counts under its epoch.

    ``windows/batch_id=N`` holds what epoch N counted. Nothing stored before is
    read, so a trigger costs what its batch costs. An epoch that is replayed
    overwrites its folder; late events add to their window in any order of
    arrival. The checks see the batch's counts with their rate.
    """
    root = sink_dir.rstrip("/")

    def write(batch: DataFrame, epoch_id: int) -> None:
        with cached(window_counts(batch, flag, "event_time", window, by)) as counts:
            if counts.isEmpty():          # nothing in this trigger: skipped (FLT-4)
                return
            gate(run_checks(with_rate(counts), list(checks)), f"micro-batch {epoch_id}")
            counts.write.mode("overwrite").parquet(f"{root}/windows/batch_id={epoch_id}")
    return write


def with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("flag_rate", rate("n_flagged", "n_events"))


def _stored_counts(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """All counts not yet merged (the folded ones and later epochs'), and the last folded epoch."""
    run = latest_commit(spark, _log(f"{root}/folded"))
    last = -1 if run is None else int(run)
    epochs = try_read_parquet(spark, f"{root}/windows")
    if epochs is not None:
        epochs = epochs.where(F.col("batch_id").cast("long") > last).drop("batch_id")
    if run is None:
        return epochs, last
    folded = spark.read.parquet(run_path(f"{root}/folded", run))
    return folded if epochs is None else folded.unionByName(epochs), last


def live_windows(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The live indicator: each window and group as counted so far, with its rate."""
    counts, _ = _stored_counts(spark, sink_dir.rstrip("/"))
    if counts is None:
        raise FileNotFoundError(f"no windows in {sink_dir}")
    return with_rate(merged_counts(counts).drop("latest"))


def fold_windows(spark: SparkSession, sink_dir: str) -> int:
    """Fold the counts of all epochs but the newest into one table; the last epoch folded.

    The newest epoch stays as it is, since the stream may still replay it. The
    folded table is written whole under the epoch it reaches to and then
    committed, so a crash in between changes nothing for readers and a fold that
    is repeated gives the same rows. Epoch folders and tables that the fold
    before this one had already replaced are deleted: a reader that began before
    this fold still finds its files. Its cost is the number of windows, not of
    events.
    """
    root = sink_dir.rstrip("/")
    epochs = sorted(int(v) for v in partition_values(spark, f"{root}/windows", "batch_id"))
    run = latest_commit(spark, _log(f"{root}/folded"))
    last = -1 if run is None else int(run)
    if not [e for e in epochs[:-1] if e > last]:
        return last
    reach = epochs[-2]
    counts = spark.read.parquet(f"{root}/windows").where(
        (F.col("batch_id").cast("long") > last) & (F.col("batch_id").cast("long") <= reach)) \
        .drop("batch_id")
    if run is not None:
        counts = spark.read.parquet(run_path(f"{root}/folded", run)).unionByName(counts)
    merged_counts(counts).write.mode("overwrite").parquet(run_path(f"{root}/folded", _epoch(reach)))
    commit_run(spark, _log(f"{root}/folded"), _epoch(reach), ["windows"])
    for epoch in epochs:
        if epoch <= last:
            delete_folder(spark, f"{root}/windows/batch_id={epoch}")
    for old in partition_values(spark, f"{root}/folded", "run_id"):
        if int(old) < last:
            delete_folder(spark, run_path(f"{root}/folded", old))
    return reach


def closed_windows(spark: SparkSession, sink_dir: str, delay: str = "1 day") -> DataFrame:
    """Windows of :func:`live_windows` that ended at least ``delay`` before the latest event."""
    counts, _ = _stored_counts(spark, sink_dir.rstrip("/"))
    if counts is None:
        raise FileNotFoundError(f"no windows in {sink_dir}")
    latest = counts.agg(F.max("latest").cast("string")).first()[0]
    end = F.lit(latest).cast("timestamp_ntz") - F.expr(f"interval {delay}")
    return live_windows(spark, sink_dir).where(F.col("window_end") <= end)


def live_indicator_stream(spark: SparkSession, source_dir: str, schema: StructType,
                          time_column: str, flag: Column, sink_dir: str, checkpoint: str,
                          checks: Sequence[Check], output_mode: str = "append",
                          window: str = "1 day", delay: str = "1 day",
                          max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """STR-3 as a query. ``append`` adds each batch's counts (read with :func:`live_windows` or
    :func:`closed_windows`, kept short by :func:`fold_windows`); ``complete`` holds all
    counts in state and rewrites the whole table each batch (small group counts)."""
    use_rocksdb_state(spark)
    src = with_event_time(read_file_stream(spark, source_dir, schema,
                                           max_files_per_trigger=max_files_per_trigger), time_column)
    by = ("event_type",)
    if output_mode == "complete":
        agg = windowed_indicator(src, flag, "event_time", window, by, delay)
        return (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
                .foreachBatch(gated_writer(sink_dir, checks, "overwrite"))
                .trigger(availableNow=True).start())
    return (src.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(window_writer(sink_dir, flag, checks, window, by))
            .trigger(availableNow=True).start())
