"""Silver merged batch by batch, indicators kept by deltas, retention by reference."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS, Check
from tessera.operators.audit import RunClock
from tessera.operators.indicators import city_indicator, indicator_base
from tessera.plans import incremental as inc
from tessera.plans.publish import Target, publish_checked, read_published, run_path
from tessera.plans.retention import expire_runs, expire_scratch
from tessera.plans.silver import build_silver

CLOCK = RunClock.fixed("2026-06-30 12:00:00")
SCHEMA = ("NU_ANO_AVALIACAO int, SG_UF string, ID_ALUNO long, CO_MUNICIPIO int, NO_MUNICIPIO string, "
          "IN_PRESENCA_LP int, IN_ALFABETIZADO int, VL_PROFICIENCIA_LP double, _ingestion_timestamp timestamp")
ALUNOS = CONTRACTS["alunos"]


def students(rng, n, years=(2023, 2024)):
    start = datetime(2026, 1, 1)
    return [(rng.choice(years) if rng.random() < 0.97 else None, rng.choice(["AB", "CD"]),
             rng.randrange(60) if rng.random() < 0.97 else None, rng.choice([11, 12, None]),
             rng.choice(["X ", "", None, "Y"]), rng.choice([0, 1, 1]), rng.choice([0, 1, None]),
             rng.choice([1.234, 2.0, None]),
             None if rng.random() < 0.05 else start + timedelta(hours=rng.randrange(6))) for _ in range(n)]


def same(a, b):
    return sorted(map(str, (r.asDict() for r in a.collect()))) == sorted(
        map(str, (r.asDict() for r in b.select(*a.columns).collect())))


def test_batches_in_any_order_equal_the_full_build(spark, tmp_dir):
    rng = random.Random(9)
    batches = [students(rng, 50) for _ in range(3)] + [[], students(rng, 1, (2020,))]
    order = [2, 0, 3, 1, 0, 4, 2]                       # late and repeated batches
    root, results = f"{tmp_dir}/alunos", []
    for i, b in enumerate(order):
        results.append(inc.merge_silver(spark, root, spark.createDataFrame(batches[b], SCHEMA).repartition(3),
                                        ALUNOS, buckets=4))
        if i in (1, 3, 6):
            so_far = [r for x in set(order[:i + 1]) for r in batches[x]]
            full = build_silver(spark.createDataFrame(so_far, SCHEMA), ALUNOS, CLOCK, processed_at=False)
            assert same(inc.read_silver_merged(spark, root, CLOCK, processed_at=False), full)
            cities = city_indicator(indicator_base(full))
            assert same(inc.maintained_cities(spark, root), cities)
            if i > 1:
                inc.fold_cities(spark, root)
                inc.fold_cities(spark, root)
                assert same(inc.maintained_cities(spark, root), cities)
    assert [r.run_id is None for r in results] == [False, False, True, False, True, False, True]
    assert inc.expire_merged(spark, root, keep=1) > 0
    assert same(inc.read_silver_merged(spark, root, CLOCK, processed_at=False), full)


def test_a_run_opens_only_the_areas_of_its_batch(spark, tmp_dir):
    rng = random.Random(2)
    day = lambda year: spark.createDataFrame([
        (year, "AB", i, 11, "X", 1, 1, 1.0, datetime(2026, 1, 1)) for i in range(200)], SCHEMA)
    root = f"{tmp_dir}/alunos"
    for year in (2019, 2020, 2021):
        first = inc.merge_silver(spark, root, day(year), ALUNOS, buckets=8)
        assert (first.areas_read, first.areas_written, first.changed) == (0, 8, 200)
    one = spark.createDataFrame([(2020, "CD", 7, 12, "Y", 1, 0, 2.0, datetime(2026, 1, 2))], SCHEMA)
    assert inc.merge_silver(spark, root, one, ALUNOS, buckets=8) == inc.Merged(
        sorted(os.listdir(f"{root}/commits")) and inc.latest_commit(spark, f"{root}/commits"), 1, 1, 1, 1)
    again = inc.merge_silver(spark, root, one, ALUNOS, buckets=8)
    assert (again.run_id, again.changed, again.areas_read) == (None, 0, 1)
    stale = one.withColumn("_ingestion_timestamp", F.lit(datetime(2025, 1, 1))).withColumn("SG_UF", F.lit("ZZ"))
    assert inc.merge_silver(spark, root, stale, ALUNOS, buckets=8).changed == 0
    assert inc.read_merged(spark, root).where("sigla_uf = 'CD'").count() == 1 and rng
    assert inc.read_merged(spark, root).count() == 600
    cities = {(r.ano, r.id_municipio): r.total_avaliados for r in inc.maintained_cities(spark, root).collect()}
    assert cities == {(2019, 11): 200, (2020, 11): 199, (2020, 12): 1, (2021, 11): 200}


def test_a_run_that_dies_before_its_commit_is_not_seen(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    inc.merge_batch(spark, tmp_dir, rows, ["k"], ["v"], buckets=2)

    def die(changes, run):
        assert {(r.new.k, r.old and r.old.v, r.new.v) for r in changes.collect()} == {(2, "b", "c"), (3, None, "d")}
        raise RuntimeError("lost")

    more = spark.createDataFrame([(2, "c"), (3, "d"), (1, "A")], "k int, v string")
    with pytest.raises(RuntimeError, match="lost"):
        inc.merge_batch(spark, tmp_dir, more, ["k"], ["v"], buckets=2, on_changes=die)
    assert sorted((r.k, r.v) for r in inc.read_merged(spark, tmp_dir).collect()) == [(1, "a"), (2, "b")]
    assert inc.merge_batch(spark, tmp_dir, more, ["k"], ["v"], buckets=2).changed == 2
    assert sorted((r.k, r.v) for r in inc.read_merged(spark, tmp_dir).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_batches_that_do_not_fit_are_refused(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        inc.read_merged(spark, tmp_dir)
    inc.merge_batch(spark, tmp_dir, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    with pytest.raises(ValueError, match="columns"):
        inc.merge_batch(spark, tmp_dir, spark.createDataFrame([(1, "a")], "k int, w string"), ["k"])
    with pytest.raises(ValueError, match="business key"):
        inc.merge_silver(spark, tmp_dir, spark.range(1), CONTRACTS["dicionario"])


def test_retention_keeps_the_newest_runs_and_those_under_way(spark, tmp_dir):
    log, path, checks = f"{tmp_dir}/commits", f"{tmp_dir}/t", (Check("min_count", value=1),)
    df, sizes = spark.range(5), []
    for n in range(10):
        publish_checked(spark, {"t": Target(df.withColumn("n", F.lit(n)), path, (), checks)}, log)
        reader = read_published(spark, path, log, "t")
        expire_runs(spark, [(path, "t")], log, keep=2)
        assert {r.n for r in reader.collect()} == {n}
        sizes.append(len(os.listdir(path)))
    assert max(sizes) == sizes[-1] == 2
    now = datetime.now(timezone.utc)
    crashed, busy = ((now - timedelta(hours=h)).strftime("%Y%m%dT%H%M%S%f") + "-x" for h in (50, 1))
    for run in (crashed, busy):
        df.write.parquet(run_path(path, run))
    assert expire_runs(spark, [(path, "t")], log) == [run_path(path, crashed)]
    assert os.path.exists(run_path(path, busy)) and len(os.listdir(path)) == 3
    assert expire_runs(spark, [(f"{tmp_dir}/none", "none")], f"{tmp_dir}/nolog") == []
    with pytest.raises(ValueError):
        expire_runs(spark, [], log, keep=0)


def test_old_intermediates_go(spark, tmp_dir):
    df = spark.range(3)
    df.write.parquet(f"{tmp_dir}/tables/a")
    assert expire_scratch(spark, f"{tmp_dir}/tables") == []
    gone = expire_scratch(spark, f"{tmp_dir}/tables", now=datetime.now(timezone.utc) + timedelta(days=2))
    assert len(gone) == 1 and os.listdir(f"{tmp_dir}/tables") == []
    assert expire_scratch(spark, f"{tmp_dir}/none") == []


def test_a_merge_writes_its_batch_and_leaves_stored_rows_in_place(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(inc, "SMALL", 0)
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    inc.merge_batch(spark, tmp_dir, rows(0, 500, "a"), ["k"], ["v"], buckets=2)
    for lo, hi, v, changed, stored in ((495, 510, "b", 15, 15), (400, 500, "a", 0, 0), (505, 515, "a", 5, 10)):
        out = inc.merge_batch(spark, tmp_dir, rows(lo, hi, v), ["k"], ["v"], buckets=2)
        assert (out.rows_in, out.changed) == (hi - lo, changed)
        if changed:
            assert spark.read.parquet(run_path(f"{tmp_dir}/rows", out.run_id)).count() == stored
    got = {r.k: r.v for r in inc.read_merged(spark, tmp_dir).collect()}
    assert inc.read_merged(spark, tmp_dir).count() == len(got) == 515
    assert {k for k, v in got.items() if v == "b"} == set(range(495, 510))
    assert len(os.listdir(f"{tmp_dir}/rows")) == 3   # the repeated batch left nothing behind


@pytest.mark.parametrize("most", [2, 99])
def test_many_versions_of_a_key_over_many_segments(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(inc, "SMALL", 0)
    monkeypatch.setattr(inc, "MOST", most)
    monkeypatch.setattr(inc, "BITS", 8)              # bitmaps that hit nearly everything
    rng, best = random.Random(most), {}
    schema = "k int, o int, v string"
    for _ in range(6):
        batch = [(rng.randrange(20), rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y", "z"])) for _ in range(12)]
        rank = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
        newest = {}
        for r in batch:
            newest[r[0]] = max(newest.get(r[0], r), r, key=rank)
        want = {k: r for k, r in newest.items() if k not in best or rank(r) > rank(best[k])}
        seen = []
        out = inc.merge_batch(spark, tmp_dir, spark.createDataFrame(batch, schema), ["k"], ["o"], buckets=2,
                              on_changes=lambda c, run: seen.extend(c.collect()))  # noqa: B023
        assert (out.rows_in, out.changed) == (len(newest), len(want))
        assert {r.new.k: (tuple(r.new), r.old and tuple(r.old)) for r in seen} == {
            k: (r, best.get(k)) for k, r in want.items()}
        best |= want
        assert {r.k: tuple(r) for r in inc.read_merged(spark, tmp_dir).collect()} == best
        assert inc.read_merged(spark, tmp_dir).count() == len(best)
    assert max(map(len, inc.manifest(spark, tmp_dir).segments.values())) <= most
