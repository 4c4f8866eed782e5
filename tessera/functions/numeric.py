"""Numeric column expressions: rounding, rates, deviations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.base import as_col


def round2(c: str | Column, scale: int = 2) -> Column:
    """HALF_UP rounding to ``scale`` places; NULL stays NULL."""
    return F.round(as_col(c), scale)


def rate(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """round(part / whole * 100, 2); NULL when whole is 0 or NULL (ANSI-safe)."""
    return F.round(F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double")) * 100, scale)


def deviation(value: str | Column, target: str | Column, scale: int = 2) -> Column:
    """round(value - target, 2)."""
    return F.round(as_col(value) - as_col(target), scale)


def flag_is_one(c: str | Column) -> Column:
    """Flag equal to 1 whether stored as a number or as text '1'; never raises
    under ANSI (unparsable text is simply not 1), NULL counts as not 1."""
    return F.coalesce(as_col(c).try_cast("double") == F.lit(1.0), F.lit(False))


def count_flag(c: str | Column) -> Column:
    """sum(case when flag = 1 then 1 else 0 end): 0 for an empty group, never NULL."""
    return F.sum(F.when(flag_is_one(c), F.lit(1)).otherwise(F.lit(0))).cast("long")
