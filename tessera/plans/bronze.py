"""Bronze ingest (PIPE-1): source -> audit columns -> one batch directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.contracts import EntityContract
from tessera.operators.audit import RunClock, bronze_audit
from tessera.sources.csv import read_csv, read_csv_sniffed
from tessera.sources.sinks import write_batch
from tessera.sources.warehouse import read_source


def to_bronze(df: DataFrame, clock: RunClock, source_path: str, entity: str,
              environment: str = "dev") -> DataFrame:
    return bronze_audit(df, clock, source_path, entity, environment)


def ingest_bronze(df: DataFrame, bronze_root: str, entity: str, clock: RunClock,
                  source_path: str, environment: str = "dev") -> str:
    """Stamp and write one batch: ``bronze_root/entity/anomesdia=YYYYMMDD``."""
    out = to_bronze(df, clock, source_path, entity, environment)
    return write_batch(out, f"{bronze_root.rstrip('/')}/{entity}", clock.batch)


def ingest_csv(spark: SparkSession, path: str, contract: EntityContract, bronze_root: str,
               clock: RunClock, sniff: bool = False, entity: str | None = None) -> str:
    """CSV entity: declared schema (SRC-2) or detected encoding/separator (SRC-3/4).

    ``entity`` names the bronze folder (e.g. one folder per year of students);
    it defaults to the contract's name.
    """
    df = (read_csv_sniffed(spark, path, contract.schema) if sniff
          else read_csv(spark, path, contract.schema))
    return ingest_bronze(df, bronze_root, entity or contract.name, clock, path)


def ingest_warehouse(spark: SparkSession, table: str, entity: str, bronze_root: str,
                     clock: RunClock, fallback_root: str | None = None) -> str:
    """Warehouse entity (SRC-1)."""
    df = read_source(spark, table, fallback_root=fallback_root)
    return ingest_bronze(df, bronze_root, entity, clock, f"warehouse://{table}")
