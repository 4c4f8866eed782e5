"""Goal comparison expressions: target pick by year and status label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import STATUS_BELOW, STATUS_MET, STATUS_NO_TARGET
from tessera.functions.base import as_col


def target_for_year(year: str | Column, targets_by_year: Mapping[int, str]) -> Column:
    """Pick the target column that belongs to the row's year; NULL otherwise."""
    year = as_col(year)
    expr = None
    for y, col_name in targets_by_year.items():
        expr = (F.when(year == y, F.col(col_name)) if expr is None
                else expr.when(year == y, F.col(col_name)))
    return expr if expr is not None else F.lit(None).cast("double")


def goal_status(target: str | Column, dev: str | Column) -> Column:
    """No target / met (deviation >= 0) / below (also when the rate is NULL)."""
    target, dev = as_col(target), as_col(dev)
    return (F.when(target.isNull(), F.lit(STATUS_NO_TARGET))
            .when(dev >= 0, F.lit(STATUS_MET))
            .otherwise(F.lit(STATUS_BELOW)))
