"""Gold build and publication (PIPE-4).

``build_gold`` returns the three views as lazy DataFrames over one shared
city indicator: the goal comparison and the state evolution derive from it
(the state view re-sums city counts). ``materialize=True`` aggregates the
students once for all three; without it every view that is run scans them.

``publish_gold`` writes every view once, checks the written files and commits
only when all views pass: one critical failure leaves all previous gold
output untouched (see :mod:`tessera.plans.publish`).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tessera.constants import VIEW_CITY_INDICATOR, VIEW_STATE_EVOLUTION, VIEW_TARGET_COMPARISON
from tessera.contracts import GOLD_CHECKS, Check
from tessera.operators import indicators as ind
from tessera.operators.audit import gold_audit
from tessera.operators.columns import rename_present
from tessera.plans.publish import Published, Target, publish_checked, read_published
from tessera.session import written

log = logging.getLogger(__name__)

GOLD_VERSION = "v1.0_gold"

# raw upper-case student names -> the names the views use (JN-2)
UPPER_CASE_COLUMNS = {
    "NU_ANO_AVALIACAO": "ano", "SG_UF": "sigla_uf", "CO_MUNICIPIO": "id_municipio",
    "NO_MUNICIPIO": "nome_municipio", "ID_ALUNO": "id_aluno", "IN_PRESENCA_LP": "in_presenca_lp",
    "IN_ALFABETIZADO": "in_alfabetizado", "ANO": "ano", "ID_MUNICIPIO": "id_municipio"}


def build_gold(students: DataFrame, targets: DataFrame, target_columns: Mapping[int, str],
               policy: str = "distinct", materialize: bool = False,
               columns: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The three gold views. ``materialize`` writes the city aggregate into
    the shared checkpoint folder so the student table is scanned and
    aggregated once for all three views (and lineage is cut there).

    ``columns`` maps the student and target tables' own names to the names the
    views use, e.g. :data:`UPPER_CASE_COLUMNS` for the upper-case silver."""
    if columns:
        students, targets = rename_present(students, columns), rename_present(targets, columns)
    base = ind.indicator_base(students)
    cities = ind.city_indicator(base)
    if materialize:
        cities = written(cities, "cities")
    return {
        VIEW_CITY_INDICATOR: cities,
        VIEW_TARGET_COMPARISON: ind.target_comparison(cities, targets, target_columns, policy),
        VIEW_STATE_EVOLUTION: ind.state_evolution_from_cities(cities),
    }


def upper_case_view(view: DataFrame) -> DataFrame:
    """A view under the upper-case names: raw student names for its keys, the rest upper-cased."""
    raw = {v: k for k, v in reversed(UPPER_CASE_COLUMNS.items())}
    return view.toDF(*[raw.get(c, c.upper()) for c in view.columns])


def publish_gold(spark: SparkSession, views: Mapping[str, DataFrame], gold_root: str,
                 checks: Mapping[str, tuple[Check, ...]] = GOLD_CHECKS,
                 version: str = GOLD_VERSION, report_path: str | None = None) -> Published:
    """Publish all views as one run, or none.

    Views go to ``<view>/run_id=<id>`` folders and the run is committed in
    ``<gold_root>/commits`` (read with :func:`read_gold`), so not even a crash
    half way exposes views of different runs.
    """
    root = gold_root.rstrip("/")
    targets = {name: Target(gold_audit(df, version), f"{root}/{name}", (),
                            tuple(checks.get(name, ())))
               for name, df in views.items()}
    return publish_checked(spark, targets, f"{root}/commits", report_path=report_path)


def read_gold(spark: SparkSession, gold_root: str, view: str) -> DataFrame:
    """A gold view as of the newest committed run."""
    root = gold_root.rstrip("/")
    return read_published(spark, f"{root}/{view}", f"{root}/commits", view)


__all__ = ["build_gold", "publish_gold", "read_gold", "GOLD_VERSION", "UPPER_CASE_COLUMNS",
           "upper_case_view"]
