"""Registered queries: each runs library code over the shared test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the input tables. The matching DuckDB text lives in
:mod:`tessera.plans.oracle`. Queries that write (gold publication, CSV
round trip, catalog, streams) write under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tessera.constants import STATE_CODE_PATTERN, VIEW_CITY_INDICATOR, VIEW_TARGET_COMPARISON
from tessera.contracts import (CITY_JOB_CHECKS, CONTRACTS, GOLD_CHECKS, MISSING_COLUMN_POLICY,
                               RULE_SETS, Check)
from tessera.operators import indicators as ind
from tessera.operators import quality as dq
from tessera.operators.audit import RunClock, bronze_audit
from tessera.operators.clean import clean_values, typed_projection
from tessera.operators.dedup import dedup_by_contract
from tessera.plans import adapters
from tessera.plans.bronze import ingest_bronze, ingest_warehouse
from tessera.plans.gold import (UPPER_CASE_COLUMNS, build_gold, publish_gold, read_gold,
                                upper_case_view)
from tessera.plans.incremental import (fold_cities, maintained_cities, merge_silver,
                                       read_silver_merged)
from tessera.plans.jobs import read_silver, run_gold, run_silver
from tessera.plans.publish import Target, publish_checked
from tessera.plans.silver import build_silver, build_silver_upper, conform
from tessera.session import configure, scratch_path, written
from tessera.sources import catalog
from tessera.sources.csv import read_csv, read_csv_sniffed, write_csv
from tessera.sources.parquet import partition_values, read_latest, read_years
from tessera.sources.sinks import read_back, write_partitioned
from tessera.streaming.jobs import (closed_windows, fold_windows, ingest_dedup_stream,
                                    live_indicator_stream, read_live)

QueryFn = Callable[[SparkSession, str], DataFrame]

RUN_CLOCK = RunClock.fixed("2026-06-30 12:00:00")
NEXT_RUN_CLOCK = RunClock.fixed("2026-07-01 08:30:00")
STUDENT_KEYS = ("ano", "id_aluno")
# An e-mail address; the leftmost match always starts where the local part
# starts, so the look-behind and the possessive quantifier (no backtracking)
# give the same first match as the plain pattern, in linear time.
EMAIL_PATTERN = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


# --- gold views ------------------------------------------------------------------
def city_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return ind.city_indicator(ind.indicator_base(adapters.students(spark, sf_dir)))


def target_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    cities = city_indicator(spark, sf_dir)
    targets = adapters.city_targets(spark, sf_dir)
    return ind.target_comparison(cities, targets, adapters.TARGET_YEARS)


def state_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return ind.state_evolution(ind.indicator_base(adapters.students(spark, sf_dir)))


# --- dedup / union ---------------------------------------------------------------
def students_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1 / SET-2 / SET-3 / FLT-3: newest row per (ano, id_aluno)."""
    configure(spark)
    return dedup_by_contract(adapters.students(spark, sf_dir), STUDENT_KEYS,
                             ("_ingestion_timestamp",))


def students_union_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7 / SET-1: yearly raw inputs read one by one, cast to the contract, unioned."""
    configure(spark)
    root = scratch_path(spark, "raw_students")
    raw = adapters.raw_students(spark, sf_dir).withColumn("_year", F.col("NU_ANO_AVALIACAO"))
    raw.write.mode("overwrite").partitionBy("_year").parquet(root)
    paths = [f"{root}/_year={y}" for y in partition_values(spark, root, "_year")]
    return read_years(spark, paths, CONTRACTS["alunos"].schema)


# --- cleaning ----------------------------------------------------------------------
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-12 / PRJ-13 on whole documents plus a derived contact field (blank when absent)."""
    configure(spark)
    text = F.col("text")
    # the regex only runs on texts that contain an '@' at all (a plain byte search)
    contact = F.when(F.instr(text, "@") > 0, F.regexp_extract(text, EMAIL_PATTERN, 0)) \
        .otherwise(F.lit(""))
    docs = adapters.table(spark, sf_dir, "documents").withColumn("contact", contact)
    return clean_values(docs, fill=True)


def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-14: every fractional measure rounded to 2 places, integers untouched."""
    configure(spark)
    li = adapters.table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    li = li.withColumns({"net_price": net, "gross_price": net * (F.lit(1.0) + F.col("l_tax"))})
    return clean_values(li, fill=True)


def typed_projection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4 / SRC-5: text-rendered orders with null tokens, cast to a declared schema."""
    configure(spark)
    o = adapters.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = o.select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 13 == 0, F.lit("NULL")).otherwise(F.col("o_custkey").cast("string"))
         .alias("o_custkey"),
        F.when(k % 17 == 0, F.lit("None")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 11 == 0, F.lit("NaN")).otherwise(F.col("o_totalprice").cast("string"))
         .alias("o_totalprice"),
        F.when(k % 19 == 0, F.lit("nan")).otherwise(F.col("o_orderdate").cast("string"))
         .alias("o_orderdate"),
        F.col("o_orderpriority"))
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING, o_comment STRING")
    return typed_projection(text, DataType.fromDDL(schema))


def rename_cast_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4 .. PRJ-10: raw student names and types conformed to the silver contract."""
    configure(spark)
    return conform(adapters.raw_students(spark, sf_dir), CONTRACTS["alunos"])


def bronze_audit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: bronze audit columns from a fixed run clock."""
    configure(spark)
    return bronze_audit(adapters.table(spark, sf_dir, "orders"), RUN_CLOCK,
                        "warehouse://orders", "orders")


def silver_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-2 / PIPE-3 / PRJ-2: full silver build of the students (processed-at left out)."""
    configure(spark)
    return build_silver(adapters.raw_students(spark, sf_dir), CONTRACTS["alunos"], RUN_CLOCK,
                        processed_at=False)


def _merged_students(spark: SparkSession, sf_dir: str) -> str:
    """Students in four batches dealt by a hash (so a key's rows come in any order), the
    second one delivered again at the end."""
    root, raw = scratch_path(spark, "students_merged"), adapters.raw_students(spark, sf_dir)
    raw = written(raw.withColumn("_batch", F.pmod(F.xxhash64(*raw.columns), F.lit(4))), "raw_students")
    for n in (*range(4), 1):
        merge_silver(spark, root, raw.where(F.col("_batch") == n).drop("_batch"), CONTRACTS["alunos"],
                     buckets=4)
    return root


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1 / SET-2 / PIPE-2 batch by batch: equals the build over all batches at once."""
    configure(spark)
    return read_silver_merged(spark, _merged_students(spark, sf_dir), RUN_CLOCK, processed_at=False)


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1 kept by deltas with retractions over all batches; no student row is read again."""
    configure(spark)
    root = _merged_students(spark, sf_dir)
    fold_cities(spark, root)
    return maintained_cities(spark, root).withColumn("_analytics_version", F.lit("v1.0_gold"))


# --- write / read paths --------------------------------------------------------------
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2/4, SRC-8, VAL-1, D4: silver written on two days, gold from the latest only."""
    configure(spark)
    lake = scratch_path(spark, "lake")
    raw = adapters.raw_students(spark, sf_dir)
    targets = adapters.city_targets(spark, sf_dir)
    for clock in (RUN_CLOCK, NEXT_RUN_CLOCK):
        write_partitioned(build_silver(raw, CONTRACTS["alunos"], clock), f"{lake}/silver/alunos")
        write_partitioned(build_silver(targets, CONTRACTS["meta_alfabetizacao_municipio"], clock),
                          f"{lake}/silver/meta_alfabetizacao_municipio")
    students = read_latest(spark, f"{lake}/silver/alunos")
    tgt = read_latest(spark, f"{lake}/silver/meta_alfabetizacao_municipio")
    views = build_gold(students, tgt, adapters.TARGET_YEARS, materialize=True)
    out = publish_gold(spark, views, f"{lake}/gold")
    back = read_back(spark, out.written[VIEW_CITY_INDICATOR])
    if back.error:
        raise RuntimeError(back.error)
    return read_gold(spark, f"{lake}/gold", VIEW_CITY_INDICATOR).drop("_gold_processed_at")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 / SRC-3: orders staged as ';' Latin-1 CSV, read back with detection + schema."""
    configure(spark)
    path = scratch_path(spark, "orders_csv")
    write_csv(adapters.table(spark, sf_dir, "orders"), path, sep=";", encoding="ISO-8859-1")
    schema = DataType.fromDDL(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
    return read_csv_sniffed(spark, path, schema)


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAT-1 / CAT-2: gold city view written by year, registered, queried with SQL."""
    configure(spark)
    path = scratch_path(spark, "gold_city")
    write_partitioned(city_indicator(spark, sf_dir), path, partitions=("ano",))
    catalog.register_table(spark, "gold_city_indicator", path, partitioned=True)
    return catalog.sql(spark, """
        SELECT sigla_uf, CAST(ano AS INT) AS ano, count(*) AS n_cities,
               sum(total_avaliados) AS total_avaliados,
               sum(total_alfabetizados) AS total_alfabetizados,
               max(taxa_alfabetizacao_real) AS best_rate
        FROM gold_city_indicator GROUP BY sigla_uf, ano""")


# --- data quality -----------------------------------------------------------------------
STUDENT_CHECKS = (*CITY_JOB_CHECKS["alunos"],
                  Check("regex", "sigla_uf", STATE_CODE_PATTERN, critical=False),
                  Check("range", "vl_peso_aluno_lp", (1.0, 40.0), critical=False),
                  Check("not_null", "tp_serie"))

DOCUMENT_CHECKS = (Check("min_count", value=1), Check("not_null", "text"),
                   Check("unique", "text", critical=False),
                   Check("regex", "lang", r"^[a-z]{2}$"),
                   Check("range", "n_chars", (1.0, 20000.0), critical=False),
                   Check("not_null", "source"))


def dq_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return dq.check_report(adapters.students(spark, sf_dir), STUDENT_CHECKS)


def dq_city_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    checks = (*GOLD_CHECKS[VIEW_CITY_INDICATOR],
              Check("regex", "sigla_uf", STATE_CODE_PATTERN, critical=False),
              Check("not_null", "nome_municipio"), Check("unique", "id_municipio", critical=False))
    return dq.check_report(city_indicator(spark, sf_dir), checks)


def dq_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return dq.check_report(adapters.table(spark, sf_dir, "documents"), DOCUMENT_CHECKS)


def dq_gold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10 gold rule set: every gold view scored under its own checks."""
    configure(spark)
    views = build_gold(adapters.students(spark, sf_dir), adapters.city_targets(spark, sf_dir),
                       adapters.TARGET_YEARS, materialize=True)
    out = None
    for name, view in views.items():
        scored = dq.score_report(dq.check_report(view, GOLD_CHECKS[name])).select(
            F.lit(name).alias("view_name"), "*")
        out = scored if out is None else out.unionByName(scored)
    return out


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6 / AGG-7: student key groups holding more than one row."""
    configure(spark)
    return dq.duplicate_groups(adapters.students(spark, sf_dir), STUDENT_KEYS)


def dq_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-6 / DQ-7: score of the student table under each silver rule set."""
    configure(spark)
    return dq.rule_set_scores(adapters.students(spark, sf_dir),
                              {name: RULE_SETS[name]["alunos"]
                               for name in ("common", "students_job", "city_job")})


def dq_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-8: students without their year column, scored as each rule set takes an absent column."""
    configure(spark)
    sets = {name: RULE_SETS[name]["alunos"] for name in ("common", "students_job", "city_job")}
    return dq.rule_set_scores(adapters.students(spark, sf_dir).drop("ano"), sets, MISSING_COLUMN_POLICY)


def invalid_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-5 / FLT-6: offending document rows per rule."""
    configure(spark)
    docs = adapters.table(spark, sf_dir, "documents")
    return dq.rule_violations(docs, ["doc_id"], [
        Check("regex", "lang", r"^[a-z]{2}$"),
        Check("range", "n_chars", (1, 20000)),
        Check("regex", "source", r"^src[0-9]$")])


# --- more single-operator queries ---------------------------------------------------------
def target_projection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-15 / AGG-4: city key as text and one meta column per target year, distinct."""
    configure(spark)
    return ind.target_projection(adapters.city_targets(spark, sf_dir), adapters.TARGET_YEARS)


def _target_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two target versions per city (base year 1995 and a revision in 1996, +1.5 points)."""
    t = adapters.city_targets(spark, sf_dir)
    rev = t.select(F.lit(1996).alias("ano"), "id_municipio", "rede",
                   *[(F.col(c) + F.lit(1.5)).alias(c) for c in adapters.TARGET_YEARS.values()])
    return t.unionByName(rev)


def target_comparison_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1 with policy 'latest' (D5): newest target version per city, no fan-out."""
    configure(spark)
    return ind.target_comparison(city_indicator(spark, sf_dir), _target_history(spark, sf_dir),
                                 adapters.TARGET_YEARS, policy="latest")


def target_comparison_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-17 generalised: unpivoted target history joined on (city, year)."""
    configure(spark)
    return ind.target_comparison(city_indicator(spark, sf_dir), _target_history(spark, sf_dir),
                                 adapters.TARGET_YEARS, policy="by_year")


def present_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1 / FLT-2: present students with a valid city."""
    configure(spark)
    return ind.indicator_base(adapters.students(spark, sf_dir))


def silver_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-2 for a warehouse entity: city targets through the silver build."""
    configure(spark)
    return build_silver(_target_history(spark, sf_dir), CONTRACTS["meta_alfabetizacao_municipio"],
                        RUN_CLOCK, processed_at=False)


def silver_students_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5 + WIN-1 (upper-case variant): dedup first, then cleaning, upper-case names."""
    configure(spark)
    return build_silver_upper(adapters.raw_students(spark, sf_dir),
                              ("NU_ANO_AVALIACAO", "ID_ALUNO"), processed_at=False)


def bronze_students_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 + PIPE-1: students as ';' Latin-1 CSV, typed by the contract by name, stamped."""
    configure(spark)
    path = scratch_path(spark, "students_csv")
    write_csv(adapters.raw_students(spark, sf_dir).drop("anomesdia", "_ingestion_timestamp"), path)
    typed = read_csv(spark, path, CONTRACTS["alunos"].schema)
    return bronze_audit(typed, RUN_CLOCK, "raw/alunos.csv", "alunos")


# --- streaming -------------------------------------------------------------------------
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
HIGH_VALUE = 50.0
STREAM_CHECKS = (Check("min_count", value=1), Check("not_null", "event_type"),
                 Check("range", "flag_rate", (0.0, 100.0)))


N_EVENT_FILES = 8


def _stage_events(spark: SparkSession, sf_dir: str, deliveries: int = 1) -> str:
    """Eight event files, not ordered by time, as a source folder; all delivered ``deliveries``
    times, each time with event times a day and a half later."""
    src = scratch_path(spark, "events_src")
    events = adapters.table(spark, sf_dir, "events").repartition(N_EVENT_FILES // deliveries, F.xxhash64("event_id"))
    for n in range(deliveries):
        late = events.withColumn("ts", F.col("ts") + F.expr(f"interval {36 * n} hours"))
        late.write.mode("append").parquet(src)
    return src


def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 / STR-2: redelivered event files, one a trigger -> deduplicated, stamped stream."""
    configure(spark)
    src = _stage_events(spark, sf_dir, deliveries=2)
    schema = adapters.table(spark, sf_dir, "events").schema
    sink, ckpt = scratch_path(spark, "events_bronze"), scratch_path(spark, "events_ckpt")
    q = ingest_dedup_stream(spark, src, schema, "event_id", "ts", sink, ckpt, "events",
                            max_files_per_trigger=1)
    q.awaitTermination()
    return spark.read.parquet(sink).select(*EVENT_COLUMNS, "_source_entity")


def stream_daily_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3: daily window x event type -> events, high-value events, rate (complete mode)."""
    configure(spark)
    src = scratch_path(spark, "events_src")
    adapters.table(spark, sf_dir, "events").write.mode("overwrite").parquet(src)
    schema = adapters.table(spark, sf_dir, "events").schema
    sink, ckpt = scratch_path(spark, "events_daily"), scratch_path(spark, "events_daily_ckpt")
    q = live_indicator_stream(spark, src, schema, "ts", F.col("value") >= F.lit(HIGH_VALUE),
                              sink, ckpt, STREAM_CHECKS, output_mode="complete")
    q.awaitTermination()
    return read_live(spark, sink)


def stream_daily_indicator_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3, one unordered file a trigger: windows closed a day before the latest event."""
    configure(spark)
    src = _stage_events(spark, sf_dir)
    schema = adapters.table(spark, sf_dir, "events").schema
    sink, ckpt = scratch_path(spark, "events_daily_app"), scratch_path(spark, "events_daily_app_ckpt")
    q = live_indicator_stream(spark, src, schema, "ts", F.col("value") >= F.lit(HIGH_VALUE),
                              sink, ckpt, STREAM_CHECKS, output_mode="append",
                              max_files_per_trigger=1)
    q.awaitTermination()
    fold_windows(spark, sink)
    return closed_windows(spark, sink)


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 / SRC-3 / SRC-5: documents through CSV (quotes, newlines, accents), untyped, sniffed."""
    configure(spark)
    path = scratch_path(spark, "documents_csv")
    write_csv(adapters.table(spark, sf_dir, "documents").select("doc_id", "source", "text"), path,
              encoding="UTF-8")
    return read_csv_sniffed(spark, path)


# --- whole jobs ------------------------------------------------------------------------
def _day(n: int) -> RunClock:
    """The run of the n-th day of the test lake."""
    return RunClock(FIRST_DAY.at + timedelta(days=n))


FIRST_DAY = RunClock.fixed("2026-06-01 08:00:00")
LAST_DAY = 27


def _student_lake(spark: SparkSession, sf_dir: str) -> tuple[str, tuple[str, ...]]:
    """Bronze: every student year ingested on its own day, the first year again later
    with every second student's proficiency raised. Returns the lake and the year folders."""
    lake, raw_path = scratch_path(spark, "lake"), scratch_path(spark, "raw_students")
    (adapters.raw_students(spark, sf_dir).drop("_ingestion_timestamp", "anomesdia")
     .withColumn("_year", F.col("NU_ANO_AVALIACAO")).write.partitionBy("_year").parquet(raw_path))
    years = partition_values(spark, raw_path, "_year")
    for n, year in enumerate(years):
        df = spark.read.parquet(f"{raw_path}/_year={year}")
        ingest_bronze(df, f"{lake}/bronze", f"alunos_{year}", _day(n), "raw/alunos")
        if n == 0:
            again = df.where(F.col("ID_ALUNO") % 2 == 0).withColumn(
                "VL_PROFICIENCIA_LP", F.col("VL_PROFICIENCIA_LP") + 1.0)
            ingest_bronze(again, f"{lake}/bronze", f"alunos_{year}", _day(LAST_DAY), "raw/alunos")
    return lake, tuple(f"alunos_{y}" for y in years)


def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-1 / PIPE-5 / PIPE-6, SRC-7, SNK-1 / SNK-5: the silver job reads every batch of every year."""
    configure(spark)
    lake, years = _student_lake(spark, sf_dir)
    run_silver(spark, lake, _day(LAST_DAY).batch, _day(LAST_DAY), ["alunos"], student_years=years)
    return read_silver(spark, lake, "alunos").select(
        "ano", "id_aluno", "sigla_uf", "id_municipio", "in_presenca_lp", "in_alfabetizado",
        "vl_proficiencia_lp", "vl_peso_aluno_lp", "_ingestion_timestamp", "dia_ingestao")


def _whole_lake(spark: SparkSession, sf_dir: str) -> str:
    """Bronze (students, exported targets, an empty batch) through the silver job."""
    lake, years = _student_lake(spark, sf_dir)
    clock, targets = _day(LAST_DAY), adapters.city_targets(spark, sf_dir)
    export = scratch_path(spark, "export")
    targets.write.parquet(f"{export}/targets")
    ingest_warehouse(spark, "targets", "meta_alfabetizacao_municipio", f"{lake}/bronze", clock,
                     fallback_root=export)
    ingest_bronze(targets.limit(0), f"{lake}/bronze", "uf", clock, "warehouse://uf")
    run_silver(spark, lake, clock.batch, clock,
               ["alunos", "meta_alfabetizacao_municipio", "uf", "municipio"], student_years=years)
    return lake


def lake_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 / SRC-6 / SRC-9, FLT-4, AGG-5: outcomes and row counts of one silver run;
    ``uf`` has an empty batch and ``municipio`` none at all."""
    configure(spark)
    return (spark.read.parquet(f"{_whole_lake(spark, sf_dir)}/run_log/silver")
            .select("entity", "status", "rows_in", "rows_out"))


def lake_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-1 to PIPE-6: bronze, silver and gold jobs end to end; the goal comparison."""
    configure(spark)
    lake = _whole_lake(spark, sf_dir)
    run_gold(spark, lake, adapters.TARGET_YEARS)
    return read_gold(spark, f"{lake}/gold", VIEW_TARGET_COMPARISON).drop("_gold_processed_at",
                                                                         "_analytics_version")


def quality_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 / DQ-9: report rows of a publication in which one pattern is malformed."""
    configure(spark)
    lake = scratch_path(spark, "lake")
    checks = (*DOCUMENT_CHECKS, Check("regex", "lang", "[a-z", critical=False))
    docs = adapters.table(spark, sf_dir, "documents")
    publish_checked(spark, {"documents": Target(docs, f"{lake}/documents", (), checks)},
                    f"{lake}/commits", report_path=f"{lake}/quality_reports")
    return (spark.read.parquet(f"{lake}/quality_reports")
            .select("check_name", "kind", "column_name", "critical", "observed", "passed", "status"))


SAMPLE_ROWS = 50


def ordered_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-1 / SRT-2 / SNK-3: silver students clustered by key, then the read-back's ordered sample."""
    configure(spark)
    path = scratch_path(spark, "silver")
    write_partitioned(build_silver(adapters.raw_students(spark, sf_dir), CONTRACTS["alunos"], RUN_CLOCK),
                      path, cluster_by=STUDENT_KEYS)
    back = read_back(spark, path, SAMPLE_ROWS, STUDENT_KEYS)
    if back.error:
        raise RuntimeError(back.error)
    return back.sample.select(*STUDENT_KEYS, "sigla_uf", "vl_proficiencia_lp")


# --- variants of the gold inputs -----------------------------------------------------------
def text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-7: flags stored as text ('1', '0', 'N/A', blank) through silver and gold."""
    configure(spark)
    k = F.col("ID_ALUNO")
    other = F.when(k % 3 == 0, F.lit("0")).when(k % 3 == 1, F.lit("N/A")).otherwise(F.lit(" "))
    raw = adapters.raw_students(spark, sf_dir).withColumns({
        c: F.when(F.col(c) == 1, F.lit("1")).otherwise(other)
        for c in ("IN_PRESENCA_LP", "IN_ALFABETIZADO")})
    silver = build_silver(raw, CONTRACTS["alunos"], RUN_CLOCK, processed_at=False)
    return ind.city_indicator(ind.indicator_base(silver))


def gold_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-2: the goal comparison from upper-case silver tables, under upper-case names."""
    configure(spark)
    students = build_silver_upper(adapters.raw_students(spark, sf_dir),
                                  ("NU_ANO_AVALIACAO", "ID_ALUNO"), processed_at=False)
    targets = build_silver_upper(adapters.city_targets(spark, sf_dir), ("ANO", "ID_MUNICIPIO"),
                                 processed_at=False)
    views = build_gold(students, targets, {y: c.upper() for y, c in adapters.TARGET_YEARS.items()},
                       columns=UPPER_CASE_COLUMNS)
    return upper_case_view(views[VIEW_TARGET_COMPARISON])


def dq_entity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10: the six silver entities, each under the three silver rule sets."""
    configure(spark)
    students, targets = adapters.students(spark, sf_dir), adapters.city_targets(spark, sf_dir)
    results = written(ind.city_indicator(students.select(*ind.CITY_KEYS, "id_aluno",
                                                         "in_alfabetizado")), "results")
    entities = {
        "alunos": students,
        "meta_alfabetizacao_brasil": targets.groupBy("ano", "rede").agg(
            F.max("meta_alfabetizacao_1996").alias("meta_alfabetizacao_1996")),
        "meta_alfabetizacao_uf": adapters.cities(spark, sf_dir).select(
            F.lit(1995).alias("ano"), "sigla_uf").distinct(),
        "meta_alfabetizacao_municipio": targets,
        "municipio": results.select("ano", "id_municipio", "taxa_alfabetizacao_real"),
        "uf": ind.state_evolution_from_cities(results, sort=False)}
    out = None
    for name, df in entities.items():
        scored = dq.rule_set_scores(df, {r: RULE_SETS[r][name] for r in
                                         ("common", "students_job", "city_job")}) \
            .select(F.lit(name).alias("entity"), "*")
        out = scored if out is None else out.unionByName(scored)
    return out


QUERIES: dict[str, QueryFn] = {
    "city_indicator": city_indicator,
    "target_comparison": target_comparison,
    "state_evolution": state_evolution,
    "students_latest": students_latest,
    "students_union_years": students_union_years,
    "clean_text": clean_text,
    "clean_numeric": clean_numeric,
    "typed_projection": typed_projection_q,
    "rename_cast_drop": rename_cast_drop,
    "bronze_audit": bronze_audit_q,
    "silver_students": silver_students,
    "gold_published": gold_published,
    "csv_roundtrip": csv_roundtrip,
    "catalog_sql": catalog_sql,
    "dq_students": dq_students,
    "dq_city_indicator": dq_city_indicator,
    "dq_documents": dq_documents,
    "dq_gold_scores": dq_gold_scores,
    "dq_duplicates": dq_duplicates,
    "dq_score": dq_score,
    "dq_missing_column": dq_missing_column,
    "invalid_patterns": invalid_patterns,
    "target_projection": target_projection_q,
    "target_comparison_latest": target_comparison_latest,
    "target_comparison_by_year": target_comparison_by_year,
    "present_students": present_students,
    "silver_targets": silver_targets,
    "silver_students_upper": silver_students_upper,
    "bronze_students_csv": bronze_students_csv,
    "csv_documents": csv_documents,
    "stream_dedup_events": stream_dedup_events,
    "stream_daily_indicator": stream_daily_indicator,
    "stream_daily_indicator_append": stream_daily_indicator_append,
    "silver_incremental": silver_incremental,
    "gold_incremental": gold_incremental,
    "silver_run": silver_run,
    "lake_run_log": lake_run_log,
    "lake_gold": lake_gold,
    "quality_reports": quality_reports,
    "ordered_sample": ordered_sample,
    "text_flags": text_flags,
    "gold_upper": gold_upper,
    "dq_entity_scores": dq_entity_scores,
}
