"""Audit and partition columns (PRJ-1 .. PRJ-3) from one run clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.constants import (GOLD_PROCESSED_AT, GOLD_VERSION_COLUMN, SILVER_PARTITIONS,
                               SILVER_PROCESSED_AT, SILVER_VERSION, SILVER_VERSION_COLUMN)


@dataclass(frozen=True)
class RunClock:
    """The one UTC instant a run is stamped with (read once, on the driver)."""

    at: datetime

    @staticmethod
    def now() -> "RunClock":
        return RunClock(datetime.now(timezone.utc).replace(microsecond=0))

    @staticmethod
    def fixed(text: str) -> "RunClock":
        """RunClock.fixed('2026-06-30 12:00:00') for reproducible runs and tests."""
        return RunClock(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc))

    @property
    def timestamp_text(self) -> str:
        return self.at.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def date_text(self) -> str:
        return self.at.strftime("%Y-%m-%d")

    @property
    def batch(self) -> str:
        """Batch snapshot id ``anomesdia`` = YYYYMMDD."""
        return self.at.strftime("%Y%m%d")

    @property
    def ymd(self) -> tuple[str, str, str]:
        return self.at.strftime("%Y"), self.at.strftime("%m"), self.at.strftime("%d")

    def ts(self):
        """The clock as a UTC wall-clock TIMESTAMP_NTZ literal (zone-independent)."""
        return F.lit(self.timestamp_text).cast("timestamp_ntz")


def bronze_audit(df: DataFrame, clock: RunClock, source_path: str, entity: str,
                 environment: str = "dev") -> DataFrame:
    """PRJ-1: ingestion time/date, source path, entity and environment."""
    return df.withColumns({
        "_ingestion_timestamp": clock.ts(),
        "_ingestion_date": F.lit(clock.date_text),
        "_source_path": F.lit(source_path),
        "_source_entity": F.lit(entity),
        "_environment": F.lit(environment),
    })


def silver_audit(df: DataFrame, clock: RunClock, version: str = SILVER_VERSION,
                 processed_at: bool = True) -> DataFrame:
    """PRJ-2: processed-at, version and the ingestion y/m/d partition columns."""
    y, m, d = clock.ymd
    cols = {}
    if processed_at:
        cols[SILVER_PROCESSED_AT] = F.current_timestamp()
    cols[SILVER_VERSION_COLUMN] = F.lit(version)
    cols.update(dict(zip(SILVER_PARTITIONS, (F.lit(y), F.lit(m), F.lit(d)))))
    return df.withColumns(cols)


def gold_audit(df: DataFrame, version: str) -> DataFrame:
    """PRJ-3: processed-at and analytics version."""
    return df.withColumns({GOLD_PROCESSED_AT: F.current_timestamp(),
                           GOLD_VERSION_COLUMN: F.lit(version)})
