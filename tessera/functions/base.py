"""Shared helper for the column-expression functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(c) if isinstance(c, str) else c
