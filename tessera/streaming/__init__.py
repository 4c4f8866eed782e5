"""Structured Streaming ingest, dedup and live indicator (STR-1 .. STR-3)."""

from tessera.streaming.jobs import (closed_windows, drop_redelivered, fold_windows, gated_writer,
                                    ingest_dedup_stream, live_indicator_stream, live_windows,
                                    read_file_stream, read_live, stream_audit, windowed_indicator,
                                    with_event_time)

__all__ = ["closed_windows", "drop_redelivered", "fold_windows", "gated_writer", "ingest_dedup_stream",
           "live_indicator_stream", "live_windows", "read_file_stream", "read_live", "stream_audit",
           "windowed_indicator", "with_event_time"]
