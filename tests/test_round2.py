"""Streams whose result does not depend on slicing, every student batch, CSV that keeps its text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.contracts import Check
from tessera.operators.audit import RunClock
from tessera.operators.indicators import present_students
from tessera.plans.bronze import ingest_bronze
from tessera.plans.jobs import run_silver
from tessera.sources.csv import read_csv, read_csv_sniffed, write_csv
from tessera.streaming.jobs import closed_windows, ingest_dedup_stream, live_indicator_stream


def events(spark, path):
    start = dt.datetime(2024, 1, 1)
    rows = [(0 if i % 3 == 0 else i, start + dt.timedelta(hours=0 if i % 3 == 0 else (i * 37) % 400),
             f"t{i % 2}", float(i % 100)) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double")
    df.repartition(6, F.xxhash64("value")).write.parquet(path)
    return df


@pytest.mark.parametrize("files", [1, 1000])
def test_streams_do_not_depend_on_slices(spark, tmp_dir, files):
    df = events(spark, f"{tmp_dir}/src")
    ingest_dedup_stream(spark, f"{tmp_dir}/src", df.schema, "event_id", "ts", f"{tmp_dir}/sink",
                        f"{tmp_dir}/c1", "events", max_files_per_trigger=files).awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/sink")
    assert got.count() == got.select("event_id").distinct().count() == 401
    live_indicator_stream(spark, f"{tmp_dir}/src", df.schema, "ts", F.col("value") >= 50,
                          f"{tmp_dir}/live", f"{tmp_dir}/c2", (Check("min_count", value=1),),
                          max_files_per_trigger=files).awaitTermination()
    windows = spark.read.parquet(f"{tmp_dir}/live/windows")
    assert windows.agg(F.sum("n_events")).first()[0] == 600
    closed = closed_windows(spark, f"{tmp_dir}/live")
    assert 0 < closed.count() < windows.count()


def student(spark, year, ids):
    return spark.createDataFrame([(year, i, "11") for i in ids],
                                 "NU_ANO_AVALIACAO int, ID_ALUNO long, CO_MUNICIPIO string")


def test_silver_reads_every_batch_of_every_year(spark, tmp_dir):
    days = {"alunos_1996": ("2026-06-29", 1996, [1, 2]), "alunos_1997": ("2026-06-30", 1997, [3])}
    for name, (day, year, ids) in days.items():
        ingest_bronze(student(spark, year, ids), f"{tmp_dir}/bronze", name,
                      RunClock.fixed(f"{day} 08:00:00"), "x")
    ingest_bronze(student(spark, 1996, [2, 4]), f"{tmp_dir}/bronze", "alunos_1996",
                  RunClock.fixed("2026-06-30 08:00:00"), "x")
    clock, years = RunClock.fixed("2026-06-30 09:00:00"), ("alunos_1996", "alunos_1997")
    run = lambda y, **more: run_silver(spark, tmp_dir, clock.batch, clock, ["alunos"],
                                       {"alunos": (Check("min_count", value=1),)}, y, **more)[0]
    assert run((*years, "alunos_1998")).status == "failed"
    assert run((*years, "alunos_1998"), allow_missing_years=True).status == "written"
    out = run(years)
    assert (out.status, out.rows_out) == ("written", 4)
    got = spark.read.parquet(f"{tmp_dir}/silver/alunos").select("ano", "id_aluno").distinct()
    assert {tuple(r) for r in got.collect()} == {(1996, 1), (1996, 2), (1996, 4), (1997, 3)}


def test_csv_keeps_quotes_and_newlines(spark, tmp_dir):
    data = [("1", 'x "y" z;1'), ("2", "two\nlines, \"quoted\"\n"), ("3", " é ß "), ("4", "a")]
    df = spark.createDataFrame(data, "id string, text string")
    for encoding in ("UTF-8", "ISO-8859-1"):
        write_csv(df, f"{tmp_dir}/{encoding}", encoding=encoding)
        got = read_csv_sniffed(spark, f"{tmp_dir}/{encoding}").collect()
        assert sorted(map(tuple, got)) == data


def test_files_with_other_header_order_are_refused(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/mixed")
    for name, text in (("a", "A;B\n1;2\n"), ("b", "B;A\n2;1\n")):
        with open(f"{tmp_dir}/mixed/{name}.csv", "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, f"{tmp_dir}/mixed").collect()


def test_text_presence_flags(spark):
    df = spark.createDataFrame([("1",), ("0",), ("N/A",), (" ",), (None,)], "in_presenca_lp string")
    assert present_students(df).count() == 1


def test_check_pass_raises_what_no_check_caused(spark, tmp_dir):  # DQ-9
    import os

    from tessera.operators.quality import run_checks
    spark.range(10).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    for f in os.listdir(f"{tmp_dir}/t"):
        os.remove(f"{tmp_dir}/t/{f}")
    with pytest.raises(Exception):                       # its files are gone
        run_checks(df, (Check("not_null", "id", critical=False),))


def test_rerun_of_a_day_moves_its_catalog_partition(spark, tmp_dir):  # CAT-1, SNK-2
    lake = f"{tmp_dir}/lake"
    checks = {"alunos": (Check("min_count", value=1),)}
    for day, ids in ((29, [1, 2]), (30, [1, 2, 3]), (30, [1, 2, 3, 4])):
        clock = RunClock.fixed(f"2026-06-{day} 08:00:00")
        ingest_bronze(student(spark, 1996, ids), f"{lake}/bronze", "alunos_1996", clock, "x")
        run_silver(spark, lake, clock.batch, clock, ["alunos"], checks, ("alunos_1996",),
                   catalog_prefix="moved")
    got = spark.sql("SELECT dia_ingestao, count(*) AS n FROM moved_alunos GROUP BY 1").collect()
    assert {r.dia_ingestao: r.n for r in got} == {"29": 2, "30": 4}


def test_failed_run_leaves_nothing(spark, tmp_dir):  # PIPE-4, DQ-6
    import os

    from tessera.operators.quality import DataQualityError
    from tessera.plans.publish import Target, publish_checked, read_published
    publish = lambda df, n: publish_checked(
        spark, {"t": Target(df, f"{tmp_dir}/t", ("d",), (Check("min_count", value=n),))}, f"{tmp_dir}/log")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string")
    publish(rows, 1)
    for bad in (rows, rows.limit(0)):
        with pytest.raises(DataQualityError):
            publish(bad, 3)
    assert len(os.listdir(f"{tmp_dir}/t")) == 1
    assert read_published(spark, f"{tmp_dir}/t", f"{tmp_dir}/log").count() == 2


def test_malformed_csv_rows_are_counted(spark, tmp_dir):  # SRC-2
    from tessera.sources.csv import malformed_rows
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("A;B\n1;2\n1;2;3\n4\n")
    assert sorted(r._corrupt_record for r in malformed_rows(spark, f"{tmp_dir}/a.csv").collect()) == ["1;2;3", "4"]


def test_gold_scores_scan_students_once(spark):  # DQ-10
    from conftest import plan_text
    from tessera.plans.queries import dq_gold_scores
    assert plan_text(dq_gold_scores(spark, "/root/testdata/sf0.001"), "simple").count("lineitem") == 0
