"""Silver build (PIPE-2, PIPE-3): bronze batch -> conformed, deduplicated table.

Order of steps (D13: keys are screened before text is filled):

    drop stale batch columns        PRJ-8
    lower-case names (students)     PRJ-4
    rename to silver names          PRJ-6
    drop answer blocks              PRJ-7
    int / string casts              PRJ-9, PRJ-10 (try_cast)
    blank text -> NULL, round       PRJ-12, PRJ-14
    drop rows with missing keys     FLT-3
    keep newest row per key         WIN-1 / SET-2 / SET-3
    NULL text -> 'N/A'              PRJ-13
    audit + partition columns       PRJ-2

Everything is narrow (one Project after CollapseProject) except the dedup,
which shuffles once on the business key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.constants import BATCH_COLUMNS, NOTEBOOK_NAME_ALIASES, NOTEBOOK_SILVER_VERSION
from tessera.contracts import EntityContract
from tessera.operators import columns as cols
from tessera.operators.audit import RunClock, silver_audit
from tessera.operators.clean import clean_values, fill_text, string_columns
from tessera.operators.dedup import dedup_by_contract, drop_missing_keys, keep_latest


def conform(df: DataFrame, contract: EntityContract) -> DataFrame:
    """Names and types per contract (no row changes)."""
    df = cols.drop_present(df, BATCH_COLUMNS)
    if contract.lower_case:
        df = cols.lower_case_names(df)
    df = cols.rename_present(df, contract.rename)
    df = cols.drop_present(df, contract.drop)
    df = cols.cast_present(df, contract.int_columns, "int")
    df = cols.cast_present(df, contract.string_columns, "string")
    return df


def clean(df: DataFrame, contract: EntityContract) -> DataFrame:
    """PIPE-3: conform, then blank text -> NULL and numeric rounding."""
    return clean_values(conform(df, contract), fill=False)


def build_silver(df: DataFrame, contract: EntityContract, clock: RunClock,
                 processed_at: bool = True, counts: dict | None = None) -> DataFrame:
    """PIPE-2: pure DataFrame -> DataFrame silver build for one entity.

    AGG-5: pass a dict as ``counts`` to get ``Observation``s of the rows in
    (``counts["in"]``) and out of the dedup (``counts["out"]``); they are
    filled by whatever action runs the plan (the write), with no extra pass.
    """
    if counts is not None:
        counts["in"] = Observation(f"{contract.name}_rows_in")
        df = df.observe(counts["in"], F.count(F.lit(1)).alias("rows"))
    cleaned = clean(df, contract)
    deduped = dedup_by_contract(cleaned, contract.keys, contract.order_by)
    if counts is not None:
        counts["out"] = Observation(f"{contract.name}_rows_out")
        deduped = deduped.observe(counts["out"], F.count(F.lit(1)).alias("rows"))
    filled = fill_text(deduped, string_columns(deduped))
    return silver_audit(filled, clock, processed_at=processed_at)


def build_silver_upper(df: DataFrame, keys: tuple[str, ...],
                       order_by: tuple[str, ...] = ("_INGESTION_TIMESTAMP",),
                       string_columns_: tuple[str, ...] = ("SG_UF", "NO_MUNICIPIO", "REDE"),
                       version: str = NOTEBOOK_SILVER_VERSION,
                       processed_at: bool = True) -> DataFrame:
    """Upper-case (notebook) variant: names upper-cased (SIGLA_UF -> SG_UF),
    newest row per key FIRST, then string casts, blank/NULL text -> 'N/A',
    numeric rounding, audit columns, names upper-cased again (PRJ-5, WIN-1).
    """
    df = cols.upper_case_names(df, NOTEBOOK_NAME_ALIASES)
    keys = tuple(k.upper() for k in keys)
    present = [c for c in order_by if c in df.columns]
    df = keep_latest(drop_missing_keys(df, keys, sentinel=False), keys, present)
    df = cols.cast_present(df, string_columns_, "string")
    df = clean_values(df, fill=True)
    audit = {"_silver_processed_at": F.current_timestamp()} if processed_at else {}
    audit["_pipeline_version"] = F.lit(version)
    return cols.upper_case_names(df.withColumns(audit))
