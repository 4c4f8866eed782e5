"""Text column expressions: blank handling and the missing-text sentinel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import MISSING_TEXT, NULL_TOKENS
from tessera.functions.base import as_col


def blank_to_null(c: str | Column) -> Column:
    """'' or spaces only -> NULL; anything else kept as is (not trimmed)."""
    c = as_col(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def fill_missing(c: str | Column, sentinel: str = MISSING_TEXT) -> Column:
    """NULL -> sentinel."""
    return F.coalesce(as_col(c), F.lit(sentinel))


def clean_text(c: str | Column, sentinel: str = MISSING_TEXT) -> Column:
    """Blank or NULL text -> sentinel, other values untouched."""
    return fill_missing(blank_to_null(c), sentinel)


def is_missing(c: str | Column, sentinel: str = MISSING_TEXT) -> Column:
    """NULL, or the sentinel text (string columns only)."""
    c = as_col(c)
    return c.isNull() | (c == F.lit(sentinel))


def null_tokens_to_null(c: str | Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Textual null tokens (NaN, None, NULL ...) -> NULL."""
    c = as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)
