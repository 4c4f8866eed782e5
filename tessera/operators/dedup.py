"""Keyed deduplication (FLT-3, SET-2, SET-3, WIN-1).

``keep_latest`` keeps one row per key: the newest by the order columns, ties
broken by every remaining column, so the survivor is deterministic (the
original ``dropDuplicates`` survivor is arbitrary).

It is written as ``row_number() = 1`` over a key window. Catalyst turns that
into a *partial* WindowGroupLimit before the shuffle and a final one after
it, so each input task already keeps only its best row per key: a key that
holds a third of all rows shrinks to one row per task before it is shuffled
instead of landing whole in one task.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.constants import MISSING_TEXT

log = logging.getLogger(__name__)


def _keys_present(df: DataFrame, keys: Sequence[str], sentinel: bool) -> Column | None:
    cond = None
    types = {f.name: f.dataType for f in df.schema.fields}
    for k in keys:
        c = F.col(k).isNotNull()
        if sentinel and isinstance(types.get(k), StringType):
            c = c & (F.trim(F.col(k)) != "") & (F.col(k) != F.lit(MISSING_TEXT))
        cond = c if cond is None else cond & c
    return cond


def drop_missing_keys(df: DataFrame, keys: Sequence[str], sentinel: bool = True) -> DataFrame:
    """FLT-3: drop rows with a NULL key; blank or sentinel text keys count as NULL."""
    cond = _keys_present(df, keys, sentinel)
    return df.where(cond) if cond is not None else df


def missing_key_rows(df: DataFrame, keys: Sequence[str], sentinel: bool = True) -> DataFrame:
    """The rows :func:`drop_missing_keys` rejects (for a quarantine table, D13)."""
    cond = _keys_present(df, [k for k in keys if k in df.columns], sentinel)
    return df.where(~F.coalesce(cond, F.lit(False))) if cond is not None else df.limit(0)


def _order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return [F.col(c).desc_nulls_last() for c in (*order_by, *rest)]


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """WIN-1: one row per key, newest by ``order_by`` then by all other columns (desc)."""
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order_by))
    return (df.withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") == 1).drop("_rank"))


def dedup_by_contract(df: DataFrame, keys: Sequence[str] | None,
                      order_by: Sequence[str] = ()) -> DataFrame:
    """SET-3: dedup on the key columns that exist; no key -> warn and pass through."""
    if not keys:
        log.warning("no business key registered: deduplication skipped")
        return df
    present = [k for k in keys if k in df.columns]
    if not present:
        log.warning("none of the keys %s is present: deduplication skipped", list(keys))
        return df
    order = [c for c in order_by if c in df.columns]
    return keep_latest(drop_missing_keys(df, present), present, order)
