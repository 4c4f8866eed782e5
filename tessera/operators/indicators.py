"""Gold indicators: rates by city and year, goal comparison, state evolution.

All three views are hash aggregates with map-side partial aggregation, so a
city or state holding a large share of the students is combined inside each
input task before the shuffle; only one row per group and task crosses it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.constants import CITY_KEYS, COMPARISON_COLUMNS, INVALID_ID_TEXT, STATE_KEYS
from tessera.functions import count_flag, deviation, goal_status, rate, target_for_year
from tessera.functions.numeric import flag_is_one


# --- FLT-1 / FLT-2 -----------------------------------------------------------
def present_students(students: DataFrame) -> DataFrame:
    """Students present at the test (flag = 1), pushed down to the scan.

    A text flag (FLT-7) is compared by value; what is no number is absent.
    """
    if isinstance(students.schema["in_presenca_lp"].dataType, StringType):
        return students.where(flag_is_one("in_presenca_lp"))
    return students.where(F.col("in_presenca_lp") == F.lit(1))


def valid_city(students: DataFrame, city_col: str = "id_municipio") -> DataFrame:
    """City id not NULL and, as text, not 'N/A', '' or 'NaN'."""
    c = F.col(city_col)
    return students.where(c.isNotNull() & ~c.cast("string").isin(*INVALID_ID_TEXT))


def indicator_base(students: DataFrame) -> DataFrame:
    """FLT-1 then FLT-2, with only the columns the views need."""
    cols = [c for c in (*CITY_KEYS, "id_aluno", "in_alfabetizado", "in_presenca_lp")
            if c in students.columns]
    return valid_city(present_students(students.select(*cols)))


# --- AGG-1 / AGG-3 / PRJ-20 ----------------------------------------------------
def city_indicator(base: DataFrame) -> DataFrame:
    """Per (year, state, city, city name): assessed, literate, rate."""
    return (base.groupBy(*CITY_KEYS)
            .agg(F.count("id_aluno").alias("total_avaliados"),
                 count_flag("in_alfabetizado").alias("total_alfabetizados"))
            .withColumn("taxa_alfabetizacao_real",
                        rate("total_alfabetizados", "total_avaliados")))


# --- AGG-2 / SRT-1 -------------------------------------------------------------
def state_evolution(base: DataFrame, sort: bool = True) -> DataFrame:
    """Per (year, state) totals and rate straight from student rows."""
    out = (base.groupBy(*STATE_KEYS)
           .agg(F.count("id_aluno").alias("total_avaliados_estado"),
                count_flag("in_alfabetizado").alias("total_alfabetizados_estado"))
           .withColumn("taxa_alfabetizacao_estado",
                       rate("total_alfabetizados_estado", "total_avaliados_estado")))
    return out.orderBy("sigla_uf", "ano") if sort else out


def state_evolution_from_cities(cities: DataFrame, sort: bool = True) -> DataFrame:
    """Same view re-aggregated from the city indicator (no second student scan).

    City groups nest inside (year, state), so summing their counts equals
    counting the students again.
    """
    out = (cities.groupBy(*STATE_KEYS)
           .agg(F.sum("total_avaliados").cast("long").alias("total_avaliados_estado"),
                F.sum("total_alfabetizados").cast("long").alias("total_alfabetizados_estado"))
           .withColumn("taxa_alfabetizacao_estado",
                       rate("total_alfabetizados_estado", "total_avaliados_estado")))
    return out.orderBy("sigla_uf", "ano") if sort else out


# --- PRJ-15 / AGG-4 ------------------------------------------------------------
def target_projection(targets: DataFrame, target_columns: Mapping[int, str],
                      policy: str = "distinct") -> DataFrame:
    """City key as text plus one ``meta_<year>`` column per target year.

    ``policy="distinct"`` keeps every distinct (city, targets) row, so a city
    with two differing rows fans the indicator out (original behaviour).
    ``policy="latest"`` keeps one row per city: the one with the newest ``ano``
    (ties broken by the target values), through a reduction that stays
    map-side combinable even when one city holds many rows.
    """
    metas = [F.col(src).cast("double").alias(f"meta_{year}") for year, src in target_columns.items()]
    proj = targets.select(F.col("id_municipio").cast("string").alias("id_municipio"), *metas,
                          *([F.col("ano")] if policy == "latest" else []))
    if policy == "distinct":
        return proj.distinct()
    if policy != "latest":
        raise ValueError(f"unknown targets policy {policy!r}")
    meta_names = [f"meta_{y}" for y in target_columns]
    best = F.max(F.struct(F.col("ano"), *[F.col(m) for m in meta_names])).alias("_best")
    return (proj.where(F.col("id_municipio").isNotNull()).groupBy("id_municipio").agg(best)
            .select("id_municipio", *[F.col(f"_best.{m}").alias(m) for m in meta_names]))


# --- JN-1 / PRJ-17..19 -----------------------------------------------------------
def target_comparison(cities: DataFrame, targets: DataFrame, target_columns: Mapping[int, str],
                      policy: str = "distinct") -> DataFrame:
    """Left join of the city indicator with its targets; deviation and status.

    Both join keys are compared as text (the target table stores the city id
    as text); the indicator keeps its own key type in the output. The join
    carries no hint: adaptive execution broadcasts the target side only when
    the bytes it measured are under ``autoBroadcastJoinThreshold``, else it
    stays a shuffle join with skewed partitions split.

    ``policy``: 'distinct' (original: join on the city, pick the year's column),
    'latest' (newest target row per city) or 'by_year' (unpivoted targets,
    join on city and year; fans out only where a year has differing targets).
    """
    left = cities.withColumn("_city_key", F.col("id_municipio").cast("string"))
    if policy == "by_year":
        right = targets_by_year(targets, target_columns)
        joined = left.join(right, (left["_city_key"] == right["_city_key"])
                           & (left["ano"] == right["_target_year"]), "left") \
            .drop(right["_city_key"]).drop("_target_year")
    else:
        proj = target_projection(targets, target_columns, policy)
        right = proj.withColumnRenamed("id_municipio", "_city_key")
        years = {y: f"meta_{y}" for y in target_columns}
        joined = (left.join(right, "_city_key", "left")
                  .withColumn("meta_ano", target_for_year("ano", years)))
    return (joined
            .withColumn("desvio_meta", deviation("taxa_alfabetizacao_real", "meta_ano"))
            .withColumn("status_meta", goal_status("meta_ano", "desvio_meta"))
            .select(*COMPARISON_COLUMNS))


def targets_by_year(targets: DataFrame, target_columns: Mapping[int, str]) -> DataFrame:
    """PRJ-17 generalised: one row per (city, target year, target value).

    The year columns are unpivoted (``df.unpivot``) so the join is on
    (city, year) and carries a single target column, however many target
    years the table has; NULL targets are dropped (the year then has none).
    """
    proj = targets.select(F.col("id_municipio").cast("string").alias("_city_key"),
                          *[F.col(src).cast("double").alias(f"y{year}")
                            for year, src in target_columns.items()])
    long = proj.unpivot("_city_key", [f"y{y}" for y in target_columns], "_col", "meta_ano")
    year = F.substring(F.col("_col"), 2, 4).cast("int")
    return (long.where(F.col("meta_ano").isNotNull() & F.col("_city_key").isNotNull())
            .select("_city_key", year.alias("_target_year"), "meta_ano").distinct())


def target_fanout(targets: DataFrame, target_columns: Mapping[int, str]) -> DataFrame:
    """Cities with more than one distinct target row (they duplicate output rows)."""
    return (target_projection(targets, target_columns).groupBy("id_municipio").count()
            .where(F.col("count") > 1))


def top_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Deterministic sample for read-back logs (SRT-2): first ``n`` by ``order``."""
    return df.orderBy(*order).limit(n)


__all__ = [
    "CITY_KEYS", "STATE_KEYS", "COMPARISON_COLUMNS", "present_students", "valid_city",
    "indicator_base", "city_indicator", "state_evolution", "state_evolution_from_cities",
    "target_projection", "target_comparison", "targets_by_year", "target_fanout", "top_rows",
]
