"""Sources, sinks, catalog and layer jobs: E15, E17-E20, SRC-1..9, SNK-1..6, CAT-1/2, VAL-1."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.contracts import CONTRACTS
from tessera.operators.audit import RunClock
from tessera.plans import adapters
from tessera.plans.bronze import ingest_bronze, ingest_csv, ingest_warehouse
from tessera.plans.gold import build_gold, publish_gold
from tessera.plans.jobs import run_silver
from tessera.plans.silver import build_silver
from tessera.sources import catalog
from tessera.sources.csv import detect_encoding, detect_separator, read_csv, read_csv_sniffed
from tessera.sources.parquet import (latest_snapshot, read_batch, read_latest, read_years,
                                     try_read_parquet)
from tessera.sources.sinks import append_report, read_back, write_batch, write_partitioned

SF = "/root/testdata/sf0.001"
DAY1 = RunClock.fixed("2026-06-30 12:00:00")
DAY2 = RunClock.fixed("2026-07-01 09:00:00")


def test_latin1_semicolon_csv_decoded(spark, tmp_dir):  # E20, SRC-2, SRC-3
    path = f"{tmp_dir}/raw.csv"
    with open(path, "wb") as f:
        f.write("CO_MUNICIPIO;NO_MUNICIPIO\n3550308;São Paulo\n".encode("latin-1"))
    assert detect_encoding(spark, path) == "ISO-8859-1"
    assert detect_separator(spark, path) == ";"
    schema = StructType([StructField("CO_MUNICIPIO", IntegerType()),
                         StructField("NO_MUNICIPIO", StringType())])
    assert tuple(read_csv(spark, path, schema).first()) == (3550308, "São Paulo")
    assert tuple(read_csv_sniffed(spark, path, schema).first()) == (3550308, "São Paulo")


def test_utf8_comma_csv_sniffed_all_text(spark, tmp_dir):  # SRC-3 / SRC-5
    path = f"{tmp_dir}/u.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("a,b\n1,Ç\nNaN,x\n")
    assert detect_encoding(spark, path) == "UTF-8" and detect_separator(spark, path) == ","
    df = read_csv_sniffed(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 2


def test_type_drift_between_years_unioned(spark, tmp_dir):  # E18, D11, SRC-7, SET-1
    spark.createDataFrame([(2023, 10)], "NU_ANO_AVALIACAO int, ID_ESCOLA int") \
        .write.parquet(f"{tmp_dir}/y2023")
    spark.createDataFrame([(2024, 11.0, "extra")], "NU_ANO_AVALIACAO int, ID_ESCOLA double, X string") \
        .write.parquet(f"{tmp_dir}/y2024")
    out = read_years(spark, [f"{tmp_dir}/y2023", f"{tmp_dir}/y2024", f"{tmp_dir}/missing"],
                     CONTRACTS["alunos"].schema)
    rows = {r.NU_ANO_AVALIACAO: (r.ID_ESCOLA, r.X) for r in out.collect()}
    assert rows == {2023: (10, None), 2024: (11, "extra")}
    assert dict(out.dtypes)["ID_ESCOLA"] == "int"


def test_missing_path_guard(spark, tmp_dir):  # SRC-9
    assert try_read_parquet(spark, f"{tmp_dir}/nothing") is None
    assert read_batch(spark, f"{tmp_dir}/nothing", "20260630") is None


def test_batch_write_and_read_keeps_partition(spark, tmp_dir):  # SNK-1, SRC-6, PRJ-1, PIPE-1
    df = adapters.table(spark, SF, "region")
    ingest_bronze(df, f"{tmp_dir}/bronze", "region", DAY1, "warehouse://region")
    ingest_bronze(df, f"{tmp_dir}/bronze", "region", DAY1, "warehouse://region")  # idempotent
    got = read_batch(spark, f"{tmp_dir}/bronze/region", DAY1.batch)
    assert got.count() == 5
    r = got.first()
    assert r.anomesdia == "20260630" and r._source_entity == "region" and r._environment == "dev"
    assert str(r._ingestion_timestamp) == "2026-06-30 12:00:00"


def test_warehouse_fallback_and_csv_ingest(spark, tmp_dir):  # SRC-1
    adapters.table(spark, SF, "nation").write.parquet(f"{tmp_dir}/export/nation")
    p = ingest_warehouse(spark, "nation", "nation", f"{tmp_dir}/bronze", DAY1,
                         fallback_root=f"{tmp_dir}/export")
    assert spark.read.parquet(p).count() == 25
    csv = f"{tmp_dir}/a.csv"
    with open(csv, "w") as f:
        f.write("NU_ANO_AVALIACAO;ID_ALUNO\n2024;1\n")
    p = ingest_csv(spark, csv, CONTRACTS["alunos"], f"{tmp_dir}/bronze", DAY1, sniff=True)
    assert spark.read.parquet(p).first().ID_ALUNO == 1


def test_silver_two_days_gold_counts_once(spark, tmp_dir):  # E19, D4, SNK-2, SRC-8
    raw = adapters.raw_students(spark, SF)
    for clock in (DAY1, DAY2):
        write_partitioned(build_silver(raw, CONTRACTS["alunos"], clock), f"{tmp_dir}/silver/alunos")
    n_both = spark.read.parquet(f"{tmp_dir}/silver/alunos").count()
    latest = read_latest(spark, f"{tmp_dir}/silver/alunos")
    assert n_both == 2 * latest.count()
    assert {r.dia_ingestao for r in latest.select("dia_ingestao").distinct().collect()} == {"01"}
    # re-run of the same day replaces only that day's partition
    write_partitioned(build_silver(raw, CONTRACTS["alunos"], DAY2), f"{tmp_dir}/silver/alunos")
    assert spark.read.parquet(f"{tmp_dir}/silver/alunos").count() == n_both
    assert latest_snapshot(latest.limit(0)).count() == 0


def test_gold_critical_failure_keeps_old_output(spark, tmp_dir):  # E17, PIPE-4
    students = adapters.students(spark, SF)
    targets = adapters.city_targets(spark, SF)
    views = build_gold(students, targets, adapters.TARGET_YEARS)
    out = publish_gold(spark, views, f"{tmp_dir}/gold")
    assert set(out.written) == set(views) and all(s["score"] == 100.0 for s in out.scores.values())
    before = spark.read.parquet(out.written["indicador_alfabetizacao_municipio"]).count()
    from tessera.contracts import Check
    from tessera.operators.quality import DataQualityError
    bad = {k: (Check("min_count", value=10**9),) for k in views}
    with pytest.raises(DataQualityError):
        publish_gold(spark, {k: v.limit(1) for k, v in views.items()}, f"{tmp_dir}/gold", bad)
    assert spark.read.parquet(out.written["indicador_alfabetizacao_municipio"]).count() == before


def test_read_back_and_report_sink(spark, tmp_dir):  # VAL-1, SNK-6
    write_batch(adapters.table(spark, SF, "region"), f"{tmp_dir}/r", "20260630")
    rb = read_back(spark, f"{tmp_dir}/r", n=3)
    assert rb.count == 5 and rb.sample.count() == 3 and rb.error is None
    assert read_back(spark, f"{tmp_dir}/none").error is not None
    append_report(spark.createDataFrame([("x", 1)], "c string, n int"), f"{tmp_dir}/dq")
    append_report(spark.createDataFrame([("y", 2)], "c string, n int"), f"{tmp_dir}/dq")
    assert spark.read.parquet(f"{tmp_dir}/dq").count() == 2


def test_catalog_registration_and_sql(spark, tmp_dir):  # CAT-1, CAT-2
    df = adapters.table(spark, SF, "nation").withColumn("part", F.col("n_regionkey").cast("string"))
    write_partitioned(df, f"{tmp_dir}/t", partitions=("part",))
    catalog.register_table(spark, "t_nation", f"{tmp_dir}/t", partitioned=True)
    assert catalog.sql(spark, "SELECT count(*) AS n FROM t_nation").first().n == 25


def test_run_silver_loop_collects_outcomes(spark, tmp_dir):  # PIPE-5, E15, D6
    lake = f"{tmp_dir}/lake"
    raw = adapters.raw_students(spark, SF)
    for y in (1995, 1996):
        write_batch(raw.where(F.col("NU_ANO_AVALIACAO") == y), f"{lake}/bronze/alunos_{y}", DAY1.batch)
    write_batch(adapters.city_targets(spark, SF), f"{lake}/bronze/meta_alfabetizacao_municipio",
                DAY1.batch)
    write_batch(adapters.city_targets(spark, SF).limit(0), f"{lake}/bronze/uf", DAY1.batch)
    result = {o.entity: o for o in run_silver(
        spark, lake, DAY1.batch, DAY1, ["alunos", "meta_alfabetizacao_municipio", "uf", "municipio"],
        student_years=("alunos_1995", "alunos_1996"))}
    outs = {k: o.status for k, o in result.items()}
    assert outs == {"alunos": "written", "meta_alfabetizacao_municipio": "written",
                    "uf": "skipped", "municipio": "skipped"}
    assert result["uf"].detail == "empty or missing batch" and result["uf"].rows_out == 0
    # a batch date with no yearly student folder is skipped, not failed
    assert run_silver(spark, lake, "19000101", DAY1, ["alunos"])[0].status == "skipped"
    # AGG-5: counts observed during the staging write, no extra pass
    rerun = {o.entity: o for o in run_silver(spark, lake, DAY1.batch, DAY1, ["alunos"],
                                             student_years=("alunos_1995", "alunos_1996"),
                                             quarantine=True)}
    assert spark.read.parquet(f"{lake}/quarantine/alunos").count() == 0   # no missing keys here
    in_rows = raw.where(F.col("NU_ANO_AVALIACAO").isin(1995, 1996)).count()
    keys = raw.where(F.col("NU_ANO_AVALIACAO").isin(1995, 1996)) \
        .select("NU_ANO_AVALIACAO", "ID_ALUNO").distinct().count()
    assert (rerun["alunos"].rows_in, rerun["alunos"].rows_out) == (in_rows, keys)
    assert spark.read.parquet(f"{lake}/silver/alunos").count() > 0


def test_gold_rerun_same_counts(spark, tmp_dir):  # re-run test (SURVEY §5)
    views = build_gold(adapters.students(spark, SF), adapters.city_targets(spark, SF),
                       adapters.TARGET_YEARS, materialize=True)
    first = publish_gold(spark, views, f"{tmp_dir}/gold")
    counts1 = {k: spark.read.parquet(p).count() for k, p in first.written.items()}
    second = publish_gold(spark, views, f"{tmp_dir}/gold")
    counts2 = {k: spark.read.parquet(p).count() for k, p in second.written.items()}
    assert counts1 == counts2 and all(v > 0 for v in counts1.values())


def test_jobs_cli_bronze_silver_gold_with_reports(spark, tmp_dir):  # PIPE-1/5/6, SNK-6
    from tessera.plans.jobs import main
    lake = f"{tmp_dir}/lake"
    csv = f"{tmp_dir}/alunos_2024.csv"
    with open(csv, "wb") as f:
        f.write(("NU_ANO_AVALIACAO;SG_UF;ID_ALUNO;CO_MUNICIPIO;NO_MUNICIPIO;IN_PRESENCA_LP;"
                 "IN_ALFABETIZADO\n2024;SP;1;3550308;São Paulo;1;1\n2024;SP;2;3550308;São Paulo;1;0\n"
                 "2024;SP;2;3550308;São Paulo;1;0\n").encode("latin-1"))
    assert main(["bronze", "--lake-root", lake, "--entity", "alunos_2024", "--csv", csv,
                 "--sniff"]) == 0
    adapters.city_targets(spark, SF).select(
        F.lit(2023).alias("ano"), F.lit("3550308").alias("id_municipio"), F.lit("publica").alias("rede"),
        F.lit(50.0).alias("meta_alfabetizacao_2024"), F.lit(60.0).alias("meta_alfabetizacao_2025")) \
        .limit(1).write.parquet(f"{tmp_dir}/export/meta")
    assert main(["bronze", "--lake-root", lake, "--entity", "meta_alfabetizacao_municipio",
                 "--table", "meta", "--export-root", f"{tmp_dir}/export"]) == 0
    from tessera.operators.audit import RunClock
    batch = RunClock.now().batch
    from tessera.plans.jobs import run_silver
    outs = run_silver(spark, lake, batch, RunClock.now(),
                      ["alunos", "meta_alfabetizacao_municipio"], student_years=("alunos_2024",),
                      catalog_prefix="silver")
    assert {o.entity: o.status for o in outs} == {"alunos": "written",
                                                  "meta_alfabetizacao_municipio": "written"}
    assert spark.sql("SELECT count(*) AS n FROM silver_alunos").first().n == 2
    from tessera.plans.jobs import explain_run
    planned = explain_run(spark, "gold", lake, batch, RunClock.now())
    assert set(planned) == {"indicador_alfabetizacao_municipio", "comparativo_metas_resultados",
                            "evolucao_temporal_estado"}
    assert main(["silver", "--lake-root", lake, "--entity", "alunos", "--explain"]) == 0
    assert main(["gold", "--lake-root", lake, "--catalog-prefix", "gold"]) == 0
    assert spark.sql("SELECT status_meta FROM gold_comparativo_metas_resultados").first()[0] \
        == "Atingiu a Meta"
    from tessera.plans.gold import read_gold
    comp = read_gold(spark, f"{lake}/gold", "comparativo_metas_resultados").first()
    assert (comp.total_avaliados, comp.taxa_alfabetizacao_real, comp.meta_ano,
            comp.status_meta) == (2, 50.0, 50.0, "Atingiu a Meta")
    reports = spark.read.parquet(f"{lake}/quality_reports/gold")
    assert reports.count() == 7 and reports.where("status = 'PASS'").count() == 7
    assert spark.read.parquet(f"{lake}/quality_reports/silver").count() > 0


def test_catalog_reregistration_moves_location(spark, tmp_dir):  # CAT-1 re-run
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    spark.range(3).write.parquet(a)
    spark.range(5).write.parquet(b)
    catalog.register_table(spark, "t_moving", a)
    assert catalog.sql(spark, "SELECT count(*) AS n FROM t_moving").first().n == 3
    catalog.register_table(spark, "t_moving", b)
    assert catalog.sql(spark, "SELECT count(*) AS n FROM t_moving").first().n == 5



def test_versioned_gold_hides_uncommitted_runs(spark, tmp_dir):  # PIPE-4 atomic publication
    from tessera.contracts import Check
    from tessera.operators.quality import DataQualityError
    from tessera.plans.gold import read_gold
    views = build_gold(adapters.students(spark, SF), adapters.city_targets(spark, SF),
                       adapters.TARGET_YEARS, materialize=True)
    first = publish_gold(spark, views, f"{tmp_dir}/gold")
    view = "indicador_alfabetizacao_municipio"
    n = read_gold(spark, f"{tmp_dir}/gold", view).count()
    # a run that fails its checks commits nothing: readers keep the first run
    with pytest.raises(DataQualityError):
        publish_gold(spark, {k: v.limit(1) for k, v in views.items()}, f"{tmp_dir}/gold",
                     {k: (Check("min_count", value=10**9),) for k in views})
    assert read_gold(spark, f"{tmp_dir}/gold", view).count() == n
    # a run whose files exist but was never committed (crash before commit) stays invisible
    spark.range(1).write.parquet(f"{tmp_dir}/gold/{view}/run_id=99999999T999999999999-dead")
    assert read_gold(spark, f"{tmp_dir}/gold", view).count() == n
    second = publish_gold(spark, views, f"{tmp_dir}/gold")
    assert second.run_id > first.run_id
    assert read_gold(spark, f"{tmp_dir}/gold", view).count() == n


def test_newest_partition_from_listing(spark, tmp_dir):  # SRC-8 without a job
    from tessera.sources.parquet import newest_partition
    df = spark.createDataFrame([("2026", "06", "30", 1), ("2026", "07", "01", 2), ("2025", "12", "31", 3)],
                               "ano_ingestao string, mes_ingestao string, dia_ingestao string, v int")
    write_partitioned(df, f"{tmp_dir}/t")
    levels = ("ano_ingestao", "mes_ingestao", "dia_ingestao")
    assert newest_partition(spark, f"{tmp_dir}/t", levels) == \
        f"{tmp_dir}/t/ano_ingestao=2026/mes_ingestao=07/dia_ingestao=01"
    latest = read_latest(spark, f"{tmp_dir}/t")
    assert [(r.v, r.mes_ingestao) for r in latest.collect()] == [(2, "07")]
    assert newest_partition(spark, f"{tmp_dir}/t", ("a",)) is None
    assert newest_partition(spark, f"{tmp_dir}/none", levels) is None


def test_read_gold_before_any_commit(spark, tmp_dir):
    from tessera.plans.gold import read_gold
    from tessera.plans.publish import latest_commit
    assert latest_commit(spark, f"{tmp_dir}/gold/commits") is None
    with pytest.raises(FileNotFoundError):
        read_gold(spark, f"{tmp_dir}/gold", "indicador_alfabetizacao_municipio")
