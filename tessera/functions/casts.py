"""Typed casts that never fail the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType


def safe_cast(c: Column, source: DataType | None, target: DataType | str) -> Column:
    """``try_cast`` to ``target``; text holding a decimal number (e.g. '2.0')
    still becomes an integer, truncated toward zero, as the non-ANSI cast of
    the original jobs did. Anything unparsable becomes NULL."""
    if isinstance(target, str):
        target = DataType.fromDDL(target)
    direct = c.try_cast(target)
    if isinstance(target, IntegralType) and (source is None or isinstance(source, StringType)):
        return F.coalesce(direct, c.try_cast("double").try_cast(target))
    return direct
