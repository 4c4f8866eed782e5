"""Job entry points with run parameters (PIPE-5, PIPE-6).

    python -m tessera.plans.jobs silver --lake-root /lake --batch-date 20260630
    python -m tessera.plans.jobs gold   --lake-root /lake

Only this module reads clocks, paths and arguments; everything it calls is a
DataFrame -> DataFrame function.
"""

from __future__ import annotations

import argparse
import logging
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.constants import SILVER_PARTITIONS
from tessera.contracts import CONTRACTS, MISSING_COLUMN_POLICY, RULE_SETS, SILVER_ENTITIES, Check
from tessera.operators.audit import RunClock
from tessera.operators.dedup import missing_key_rows
from tessera.operators.quality import DataQualityError
from tessera.plans.bronze import ingest_csv, ingest_warehouse
from tessera.operators.indicators import target_fanout
from tessera.plans.gold import build_gold, publish_gold
from tessera.plans.publish import Target, publish_checked, read_published
from tessera.plans.silver import build_silver, clean
from tessera.sources.catalog import register_run, register_table
from tessera.sources.parquet import read_batch, read_years, try_read_parquet
from tessera.sources.sinks import append_report, write_batch
from tessera.session import apply_partition_settings, configure

log = logging.getLogger(__name__)

GOLD_TARGET_COLUMNS = {2024: "meta_alfabetizacao_2024", 2025: "meta_alfabetizacao_2025"}


@dataclass
class Outcome:
    entity: str
    status: str          # written | skipped | failed
    rows_in: int = 0     # bronze rows read
    rows_out: int = 0    # silver rows written (after key screening and dedup)
    detail: str = ""


def _observed_rows(obs: Observation) -> int:
    """The ``rows`` metric of an Observation (``Observation.get`` is a property
    holding the metrics dict once the observed action has run)."""
    metrics: dict = obs.get
    return int(metrics["rows"])


def _read_bronze(spark: SparkSession, lake_root: str, entity: str, batch: str,
                 student_years: tuple[str, ...],
                 allow_missing_years: bool = False) -> DataFrame | None:
    """The bronze batch of one entity; None when it is missing.

    Students: every batch of every year, whatever day it was ingested on (the
    dedup keeps the newest row of a student). A year without any batch is an
    error unless allowed; None only when no year has one.
    """
    if entity != "alunos":
        return read_batch(spark, f"{lake_root}/bronze/{entity}", batch)
    paths = [f"{lake_root}/bronze/{y}" for y in student_years]
    missing = [p for p in paths if try_read_parquet(spark, p) is None]
    if len(missing) == len(paths):
        return None
    if missing and not allow_missing_years:
        raise FileNotFoundError(f"expected student years without any batch: {missing}")
    return read_years(spark, paths, CONTRACTS[entity].schema)


def run_silver(spark: SparkSession, lake_root: str, batch: str, clock: RunClock,
               entities: list[str] | None = None,
               checks: dict[str, tuple[Check, ...]] | None = None,
               student_years: tuple[str, ...] = ("alunos_2023", "alunos_2024", "alunos_2025"),
               missing_column: str = "skip", catalog_prefix: str | None = None,
               quarantine: bool = False, allow_missing_years: bool = False) -> list[Outcome]:
    """PIPE-5: every entity (default all six); failures are collected in the outcomes (D6),
    and :func:`main` ends with an error if there are any.

    The outcomes are also appended to ``<lake_root>/run_log/silver``."""
    outcomes: list[Outcome] = []
    for entity in entities or list(SILVER_ENTITIES):
        contract = CONTRACTS[entity]
        try:
            bronze = _read_bronze(spark, lake_root, entity, batch, student_years,
                                  allow_missing_years)
            if bronze is None or bronze.isEmpty():
                outcomes.append(Outcome(entity, "skipped", detail="empty or missing batch"))
                continue
            counts: dict = {}
            silver = build_silver(bronze, contract, clock, counts=counts)
            # write -> check -> commit; the dedup already hash-partitioned rows
            # by the business key, so no extra repartition before writing (D12)
            target = Target(silver, f"{lake_root}/silver/{entity}", SILVER_PARTITIONS,
                            tuple((checks or {}).get(entity, contract.checks)))
            published = publish_checked(spark, {entity: target}, f"{lake_root}/silver/commits",
                                        missing_column,
                                        report_path=f"{lake_root}/quality_reports/silver")
            if quarantine and contract.keys:       # D13: rows rejected for missing keys
                rejected = missing_key_rows(clean(bronze, contract), contract.keys)
                write_batch(rejected.withColumn("_reason", F.lit("missing business key")),
                            f"{lake_root}/quarantine/{entity}", batch)
            if catalog_prefix:                      # CAT-1: the crawler's job
                register_run(spark, f"{catalog_prefix}_{entity}", target.path,
                             published.written[entity], SILVER_PARTITIONS)
            rows_in, rows_out = _observed_rows(counts["in"]), _observed_rows(counts["out"])
            log.info("%s: %d bronze rows, %d silver rows, %d null-key/duplicate rows removed",
                     entity, rows_in, rows_out, rows_in - rows_out)
            outcomes.append(Outcome(entity, "written", rows_in, rows_out))
        except DataQualityError as e:
            outcomes.append(Outcome(entity, "failed", detail=str(e)))
        except Exception as e:  # noqa: BLE001 - one entity's error must not stop the loop
            log.exception("entity %s failed", entity)
            outcomes.append(Outcome(entity, "failed", detail=str(e)))
    append_report(spark.createDataFrame(
        [(clock.batch, o.entity, o.status, o.rows_in, o.rows_out, o.detail) for o in outcomes],
        "batch string, entity string, status string, rows_in bigint, rows_out bigint, "
        "detail string"), f"{lake_root}/run_log/silver")
    return outcomes


def read_silver(spark: SparkSession, lake_root: str, entity: str) -> DataFrame:
    """SRC-8: one silver table as of its newest committed run."""
    return read_published(spark, f"{lake_root}/silver/{entity}", f"{lake_root}/silver/commits", entity)


def run_gold(spark: SparkSession, lake_root: str, target_columns=GOLD_TARGET_COLUMNS,
             catalog_prefix: str | None = None):
    """Gold from the latest silver snapshots; committed publication.

    With ``catalog_prefix`` every view's catalog table is then pointed at the
    committed run folder (one metadata change per view).
    """
    students = read_silver(spark, lake_root, "alunos")
    targets = read_silver(spark, lake_root, "meta_alfabetizacao_municipio")
    # D5: cities with several differing target rows duplicate comparison rows
    fanout = target_fanout(targets, target_columns).count()
    if fanout:
        log.warning("[DQ:GOLD] WARN | %d cities have more than one distinct target row; "
                    "their comparison rows are repeated (use policy='latest' to keep one)", fanout)
    views = build_gold(students, targets, target_columns, materialize=True)
    out = publish_gold(spark, views, f"{lake_root}/gold",
                       report_path=f"{lake_root}/quality_reports/gold")
    if catalog_prefix:
        for name, path in out.written.items():
            register_table(spark, f"{catalog_prefix}_{name}", path)
    return out


def explain_run(spark: SparkSession, layer: str, lake_root: str, batch: str, clock: RunClock,
                entities: list[str] | None = None,
                student_years: tuple[str, ...] = ("alunos_2023", "alunos_2024", "alunos_2025"),
                target_columns=GOLD_TARGET_COLUMNS) -> dict[str, DataFrame]:
    """The DataFrames a silver or gold run would write, with their plans printed."""
    frames: dict[str, DataFrame] = {}
    if layer == "silver":
        for entity in entities or list(SILVER_ENTITIES):
            bronze = _read_bronze(spark, lake_root, entity, batch, student_years,
                                  True)
            if bronze is not None:
                frames[entity] = build_silver(bronze, CONTRACTS[entity], clock)
    elif layer == "gold":
        students = read_silver(spark, lake_root, "alunos")
        targets = read_silver(spark, lake_root, "meta_alfabetizacao_municipio")
        frames = build_gold(students, targets, target_columns)
    for name, df in frames.items():
        print(f"===== {layer}: {name}")
        df.explain("formatted")
    return frames


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("layer", choices=("bronze", "silver", "gold"))
    p.add_argument("--lake-root", required=True)
    p.add_argument("--entity", default="", help="one entity; empty = all")
    p.add_argument("--batch-date", default=None, help="bronze batch YYYYMMDD (default: today)")
    p.add_argument("--rule-set", default="common",
                   choices=("common", "students_job", "city_job"), help="silver check rule set")
    p.add_argument("--csv", default=None, help="bronze: raw CSV path for --entity")
    p.add_argument("--sniff", action="store_true", help="bronze: detect encoding and separator")
    p.add_argument("--table", default=None, help="bronze: warehouse table for --entity")
    p.add_argument("--export-root", default=None,
                   help="bronze: read the warehouse table from a Parquet export instead")
    p.add_argument("--allow-missing-years", action="store_true",
                   help="silver: go on when an expected student year has no batch")
    p.add_argument("--quarantine", action="store_true",
                   help="silver: keep rows rejected for missing keys under <lake>/quarantine")
    p.add_argument("--catalog-prefix", default=None,
                   help="register silver/gold tables in the catalog as <prefix>_<table>")
    p.add_argument("--explain", action="store_true",
                   help="silver/gold: print the physical plans a run would execute; write nothing")
    p.add_argument("--input-bytes", type=int, default=0,
                   help="approximate input size; sizes shuffle partitions and scan splits")
    args = p.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())
    if args.input_bytes:
        apply_partition_settings(spark, args.input_bytes)
    clock = RunClock.now()
    if args.explain:
        explain_run(spark, args.layer, args.lake_root, args.batch_date or clock.batch, clock,
                    [args.entity] if args.entity else None)
        return 0
    if args.layer == "bronze":
        if not args.entity or not (args.csv or args.table):
            raise SystemExit("bronze needs --entity and --csv or --table")
        if args.csv:
            # yearly student folders (alunos_2024, ...) share the students contract
            base = re.sub(r"_\d{4}$", "", args.entity)
            contract = CONTRACTS.get(base, CONTRACTS["dicionario"])
            out = ingest_csv(spark, args.csv, contract, f"{args.lake_root}/bronze", clock,
                             sniff=args.sniff, entity=args.entity)
        else:
            out = ingest_warehouse(spark, args.table, args.entity, f"{args.lake_root}/bronze",
                                   clock, fallback_root=args.export_root)
        log.info("bronze written: %s", out)
    elif args.layer == "silver":
        outs = run_silver(spark, args.lake_root, args.batch_date or clock.batch, clock,
                          [args.entity] if args.entity else None,
                          checks=dict(RULE_SETS[args.rule_set]),
                          missing_column=MISSING_COLUMN_POLICY[args.rule_set],
                          catalog_prefix=args.catalog_prefix, quarantine=args.quarantine,
                          allow_missing_years=args.allow_missing_years)
        for o in outs:
            log.info("%s: %s %s", o.entity, o.status, o.detail)
        failed = [o for o in outs if o.status == "failed"]
        if failed:
            raise SystemExit(f"silver failed for {[o.entity for o in failed]}")
    else:
        run_gold(spark, args.lake_root, catalog_prefix=args.catalog_prefix)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
