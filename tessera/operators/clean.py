"""Value cleaning (PRJ-12 .. PRJ-14) and typed projection (SRC-4 / SRC-5).

All rules for all columns compile into one Project: blank text -> NULL ->
'N/A', numeric rounding to 2 places, null tokens before typed casts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType, StringType, StructType

from tessera.constants import MISSING_TEXT, NULL_TOKENS
from tessera.functions.text import blank_to_null, clean_text, null_tokens_to_null
from tessera.functions.casts import safe_cast


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    # D8: by type class, not by substring of the type name
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def clean_values(df: DataFrame, fill: bool = True, round_scale: int | None = 2,
                 keep: Iterable[str] = ()) -> DataFrame:
    """Blank text -> NULL (-> 'N/A' when ``fill``), fractional numbers rounded.

    Non-blank text is kept untrimmed. Integral numbers are unchanged by a
    2-place round, so only fractional columns get a ``round``. Columns in
    ``keep`` pass through untouched.
    """
    keep = set(keep)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keep:
            out.append(c)
        elif isinstance(f.dataType, StringType):
            out.append((clean_text(c) if fill else blank_to_null(c)).alias(f.name))
        elif round_scale is not None and isinstance(f.dataType, FractionalType):
            out.append(F.round(c, round_scale).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def fill_text(df: DataFrame, columns: Iterable[str] | None = None,
              sentinel: str = MISSING_TEXT) -> DataFrame:
    """PRJ-13 alone: NULL text -> sentinel on the given (default: all) string columns."""
    cols = list(columns) if columns is not None else string_columns(df)
    return df.fillna(sentinel, subset=cols) if cols else df


def typed_projection(df: DataFrame, schema: StructType | None,
                     tokens: tuple[str, ...] = NULL_TOKENS, keep_extra: bool = False) -> DataFrame:
    """SRC-4: null tokens -> NULL, then cast each mapped column to its type.

    Only the columns of ``schema`` are kept (absent ones come out as NULL of
    the declared type). A value that does not parse becomes NULL (``try_cast``)
    instead of failing the whole job. SRC-5: with no schema, every column
    stays text. ``keep_extra`` appends the unmapped columns unchanged.
    """
    if schema is None:
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name in types and isinstance(types[f.name], StringType):
            e = safe_cast(null_tokens_to_null(F.col(f.name), tokens), StringType(), f.dataType)
        elif f.name in types:
            e = safe_cast(F.col(f.name), types[f.name], f.dataType)
        else:
            e = F.lit(None).cast(f.dataType)
        out.append(e.alias(f.name))
    if keep_extra:
        mapped = set(schema.fieldNames())
        out += [F.col(c) for c in df.columns if c not in mapped]
    return df.select(*out)
