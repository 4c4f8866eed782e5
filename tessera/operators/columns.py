"""Column-name and column-type rules (PRJ-4 .. PRJ-11).

Each rule is one ``select`` / ``toDF`` so the plan stays a single Project
however many columns there are (no per-column ``withColumn`` chains).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.casts import safe_cast


def _check_unique(names: list[str]) -> None:
    seen: set[str] = set()
    dup = sorted({n for n in names if n in seen or seen.add(n)})
    if dup:
        raise ValueError(f"column names collide after renaming: {dup}")


def lower_case_names(df: DataFrame) -> DataFrame:
    """PRJ-4: every column name lower-case (refuses collisions)."""
    names = [c.lower() for c in df.columns]
    _check_unique(names)
    return df.toDF(*names)


def upper_case_names(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """PRJ-5: every column name upper-case, then optional aliases (e.g. SIGLA_UF -> SG_UF)."""
    aliases = dict(aliases or {})
    names = [aliases.get(c.upper(), c.upper()) for c in df.columns]
    _check_unique(names)
    return df.toDF(*names)


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-6: rename the columns that exist; absent ones are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """PRJ-7 / PRJ-8: drop the listed columns that exist."""
    cols = [c for c in columns if c in df.columns]
    return df.drop(*cols) if cols else df


def cast_present(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    """PRJ-9 / PRJ-10: cast listed columns when present.

    Casts use ``try_cast`` so a value that does not fit becomes NULL instead of
    failing the job under ANSI mode; decimal text such as '12.0' still reaches
    an integer column (see ``functions.casts.safe_cast``).
    """
    wanted = set(columns)
    if not wanted & set(df.columns):
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[safe_cast(F.col(c), types[c], to).alias(c) if c in wanted else F.col(c)
                       for c in df.columns])
