"""The test-table adapter reproduces the figures verified in SURVEY 7.4 (sf0.01)."""

from pyspark.sql import functions as F

from tessera.constants import STATE_CODE_PATTERN, STATUS_BELOW, STATUS_MET, STATUS_NO_TARGET
from tessera.operators import indicators as ind
from tessera.plans import adapters

SF = "/root/testdata/sf0.01"


def test_adapter_figures(spark):
    students = adapters.students(spark, SF)
    lineitem = adapters.table(spark, SF, "lineitem")
    assert students.count() == lineitem.count()                      # every line finds its supplier
    assert students.select("id_uf").distinct().count() == 25          # suppliers cover all nations
    assert students.where(~F.col("sigla_uf").rlike(STATE_CODE_PATTERN)).count() == 0
    cities = ind.city_indicator(ind.indicator_base(students))
    r = cities.agg(F.count(F.lit(1)).alias("n"), F.min("taxa_alfabetizacao_real").alias("lo"),
                   F.max("taxa_alfabetizacao_real").alias("hi")).first()
    assert (r.n, r.lo, r.hi) == (700, 9.68, 55.88)
    comp = ind.target_comparison(cities, adapters.city_targets(spark, SF), adapters.TARGET_YEARS)
    labels = {x.status_meta: x["count"] for x in comp.groupBy("status_meta").count().collect()}
    assert labels == {STATUS_BELOW: 103, STATUS_MET: 82, STATUS_NO_TARGET: 515}
