"""Gold indicators (AGG-1..4, FLT-1/2/7, JN-1, PRJ-15..20): fixtures E7-E12."""

from pyspark.sql import functions as F

from tessera.constants import STATUS_BELOW, STATUS_MET, STATUS_NO_TARGET
from tessera.operators import indicators as ind
from tessera.plans import adapters
from conftest import plan_text

STUDENTS = ("ano int, sigla_uf string, id_municipio int, nome_municipio string, id_aluno long, "
            "in_presenca_lp int, in_alfabetizado string")
YEARS = {2024: "meta_alfabetizacao_2024", 2025: "meta_alfabetizacao_2025"}
TARGETS = "ano int, id_municipio string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2025 double"


def _s(spark, rows):
    return spark.createDataFrame(rows, STUDENTS)


def test_absent_students_and_bad_city_not_counted(spark):  # E7, E8
    rows = [(2024, "SP", 1, "A", 1, 1, "1"), (2024, "SP", 1, "A", 2, 0, "1"),
            (2024, "SP", 1, "A", 3, None, "1"), (2024, "SP", None, "A", 4, 1, "1")]
    out = ind.city_indicator(ind.indicator_base(_s(spark, rows))).collect()
    assert len(out) == 1 and out[0].total_avaliados == 1


def test_invalid_city_text_filtered(spark):  # E8 with text ids
    df = spark.createDataFrame([("N/A",), ("",), ("NaN",), (None,), ("7",)], "id_municipio string")
    assert [r.id_municipio for r in ind.valid_city(df).collect()] == ["7"]


def test_flag_int_or_text(spark):  # E9
    rows = [(2024, "SP", 1, "A", i, 1, f) for i, f in enumerate(["1", "1", "0", None])]
    df = _s(spark, rows).withColumn("in_alfabetizado",
                                    F.when(F.col("id_aluno") == 0, F.lit("1")).otherwise(F.col("in_alfabetizado")))
    r = ind.city_indicator(ind.indicator_base(df)).first()
    assert (r.total_avaliados, r.total_alfabetizados, r.taxa_alfabetizacao_real) == (4, 2, 50.0)


def test_zero_denominator_gives_null_rate(spark):
    df = spark.createDataFrame([(2024, "SP", 1, "A", None, 1, "1")], STUDENTS)
    r = ind.city_indicator(ind.indicator_base(df)).first()
    assert r.total_avaliados == 0 and r.taxa_alfabetizacao_real is None


def test_target_pick_deviation_and_status(spark):  # E10, E11
    cities = spark.createDataFrame(
        [(2023, "SP", 1, "A", 10, 50.0), (2024, "SP", 1, "A", 10, 60.0),
         (2025, "SP", 1, "A", 10, 69.99), (2024, "SP", 2, "B", 10, 40.0),
         (2024, "SP", 3, "C", 10, 40.0)],
        "ano int, sigla_uf string, id_municipio int, nome_municipio string, "
        "total_avaliados long, taxa_alfabetizacao_real double")
    targets = spark.createDataFrame([(2023, "1", 60.0, 70.0), (2023, "2", None, 50.0)], TARGETS)
    out = {(r.ano, r.id_municipio): r for r in
           ind.target_comparison(cities, targets, YEARS).collect()}
    assert out[(2023, 1)].meta_ano is None and out[(2023, 1)].status_meta == STATUS_NO_TARGET
    assert out[(2024, 1)].desvio_meta == 0.0 and out[(2024, 1)].status_meta == STATUS_MET
    assert out[(2025, 1)].desvio_meta == -0.01 and out[(2025, 1)].status_meta == STATUS_BELOW
    assert out[(2024, 2)].status_meta == STATUS_NO_TARGET      # target NULL
    assert out[(2024, 3)].status_meta == STATUS_NO_TARGET      # city without targets
    assert isinstance(out[(2024, 1)].id_municipio, int)       # own key type kept (D2)


def test_two_target_rows_fan_out_or_latest(spark):  # E12, D5
    cities = spark.createDataFrame([(2024, "SP", 1, "A", 10, 60.0)],
                                   "ano int, sigla_uf string, id_municipio int, "
                                   "nome_municipio string, total_avaliados long, "
                                   "taxa_alfabetizacao_real double")
    targets = spark.createDataFrame([(2022, "1", 50.0, 55.0), (2023, "1", 70.0, 75.0)], TARGETS)
    assert ind.target_comparison(cities, targets, YEARS).count() == 2
    latest = ind.target_comparison(cities, targets, YEARS, policy="latest").collect()
    assert len(latest) == 1 and latest[0].meta_ano == 70.0
    assert ind.target_fanout(targets, YEARS).count() == 1


def test_city_totals_sum_to_state_totals(spark):  # property
    base = ind.indicator_base(adapters.students(spark, "/root/testdata/sf0.001"))
    cities = ind.city_indicator(base)
    direct = {(r.ano, r.sigla_uf): (r.total_avaliados_estado, r.total_alfabetizados_estado,
                                     r.taxa_alfabetizacao_estado)
              for r in ind.state_evolution(base).collect()}
    summed = {(r.ano, r.sigla_uf): (r.total_avaliados_estado, r.total_alfabetizados_estado,
                                     r.taxa_alfabetizacao_estado)
              for r in ind.state_evolution_from_cities(cities).collect()}
    assert direct == summed
    rates = [r.taxa_alfabetizacao_real for r in cities.collect()]
    assert all(0 <= x <= 100 for x in rates)


def test_met_label_iff_nonnegative_deviation(spark):  # property
    out = ind.target_comparison(
        ind.city_indicator(ind.indicator_base(adapters.students(spark, "/root/testdata/sf0.001"))),
        adapters.city_targets(spark, "/root/testdata/sf0.001"), adapters.TARGET_YEARS).collect()
    for r in out:
        if r.meta_ano is not None and r.desvio_meta is not None:
            assert (r.status_meta == STATUS_MET) == (r.desvio_meta >= 0)


def test_comparison_plan_broadcasts_targets(spark):
    df = ind.target_comparison(
        ind.city_indicator(ind.indicator_base(adapters.students(spark, "/root/testdata/sf0.001"))),
        adapters.city_targets(spark, "/root/testdata/sf0.001"), adapters.TARGET_YEARS)
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan


def test_presence_filter_pushed_to_scan(spark, tmp_dir):
    rows = [(2024, "SP", 1, "A", 1, 1, "1")]
    _s(spark, rows).write.parquet(f"{tmp_dir}/s")
    df = ind.city_indicator(ind.indicator_base(spark.read.parquet(f"{tmp_dir}/s")))
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(in_presenca_lp), EqualTo(in_presenca_lp,1)" in plan


def test_top_rows_and_cached(spark):  # SRT-2, PIPE-7
    from tessera.operators.quality import cached
    df = spark.range(10).selectExpr("id", "id % 3 AS g")
    assert [r.id for r in ind.top_rows(df, 3, ["g", "id"]).collect()] == [0, 3, 6]
    with cached(df) as c:
        assert c.is_cached and c.count() == 10
    assert not df.is_cached


def test_by_year_fans_out_only_where_targets_differ(spark):  # PRJ-17 generalised, E12
    cities = spark.createDataFrame(
        [(2023, "SP", 1, "A", 10, 60.0), (2024, "SP", 1, "A", 10, 60.0), (2025, "SP", 1, "A", 10, 60.0)],
        "ano int, sigla_uf string, id_municipio int, nome_municipio string, "
        "total_avaliados long, taxa_alfabetizacao_real double")
    targets = spark.createDataFrame([(2022, "1", 50.0, 55.0), (2023, "1", 50.0, 75.0)], TARGETS)
    rows = ind.target_comparison(cities, targets, YEARS, policy="by_year").collect()
    per_year = {}
    for r in rows:
        per_year.setdefault(r.ano, []).append((r.meta_ano, r.status_meta))
    assert per_year[2023] == [(None, STATUS_NO_TARGET)]
    assert per_year[2024] == [(50.0, STATUS_MET)]
    assert sorted(per_year[2025]) == [(55.0, STATUS_MET), (75.0, STATUS_BELOW)]
    # the distinct policy fans every year out by the number of target rows
    assert ind.target_comparison(cities, targets, YEARS).count() == 6
