"""DuckDB oracle SQL for the registered queries (independent re-statement).

Rounding note: Spark rounds a double HALF_UP on its shortest decimal text;
DuckDB's ``round(double)`` does not, so the oracle rounds the decimal text:
``round(CAST(CAST(x AS VARCHAR) AS DECIMAL(38,18)), 2)``.
"""

from __future__ import annotations

from tessera.contracts import RULE_SETS
from tessera.plans.adapters import STUDENTS_SQL, TARGETS_SQL


def r2(expr: str) -> str:
    """Spark-compatible round(x, 2) of a DOUBLE expression, in DuckDB."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def rate_sql(part: str, whole: str) -> str:
    return r2(f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100")


CITY_INDICATOR_SQL = f"""
WITH {STUDENTS_SQL},
base AS (
  SELECT * FROM students
  WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
    AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')
),
agg AS (
  SELECT ano, sigla_uf, id_municipio, nome_municipio,
         count(id_aluno) AS total_avaliados,
         CAST(sum(CASE WHEN in_alfabetizado = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_alfabetizados
  FROM base GROUP BY ano, sigla_uf, id_municipio, nome_municipio
)
SELECT *, {rate_sql('total_alfabetizados', 'total_avaliados')} AS taxa_alfabetizacao_real
FROM agg"""

TARGET_COMPARISON_SQL = f"""
WITH {STUDENTS_SQL}, {TARGETS_SQL},
base AS (
  SELECT * FROM students
  WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
    AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')
),
agg AS (
  SELECT ano, sigla_uf, id_municipio, nome_municipio,
         count(id_aluno) AS total_avaliados,
         CAST(sum(CASE WHEN in_alfabetizado = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_alfabetizados
  FROM base GROUP BY ano, sigla_uf, id_municipio, nome_municipio
),
ind AS (
  SELECT *, {rate_sql('total_alfabetizados', 'total_avaliados')} AS taxa_alfabetizacao_real FROM agg
),
t AS (
  SELECT DISTINCT CAST(id_municipio AS VARCHAR) AS id_municipio,
         meta_alfabetizacao_1996 AS meta_1996, meta_alfabetizacao_1997 AS meta_1997
  FROM targets
),
j AS (
  SELECT ind.*, CASE WHEN ind.ano = 1996 THEN t.meta_1996
                     WHEN ind.ano = 1997 THEN t.meta_1997 END AS meta_ano
  FROM ind LEFT JOIN t ON CAST(ind.id_municipio AS VARCHAR) = t.id_municipio
),
d AS (
  SELECT *, {r2('taxa_alfabetizacao_real - meta_ano')} AS desvio_meta FROM j
)
SELECT ano, sigla_uf, id_municipio, nome_municipio, total_avaliados, taxa_alfabetizacao_real,
       meta_ano, desvio_meta,
       CASE WHEN meta_ano IS NULL THEN 'Sem Meta Definida'
            WHEN desvio_meta >= 0 THEN 'Atingiu a Meta'
            ELSE 'Abaixo da Meta' END AS status_meta
FROM d"""

STATE_EVOLUTION_SQL = f"""
WITH {STUDENTS_SQL},
base AS (
  SELECT * FROM students
  WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
    AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')
),
agg AS (
  SELECT ano, sigla_uf, count(id_aluno) AS total_avaliados_estado,
         CAST(sum(CASE WHEN in_alfabetizado = 1 THEN 1 ELSE 0 END) AS BIGINT)
           AS total_alfabetizados_estado
  FROM base GROUP BY ano, sigla_uf
)
SELECT *, {rate_sql('total_alfabetizados_estado', 'total_avaliados_estado')}
       AS taxa_alfabetizacao_estado
FROM agg ORDER BY sigla_uf, ano"""


ORACLE: dict[str, str] = {
    "city_indicator": CITY_INDICATOR_SQL,
    "target_comparison": TARGET_COMPARISON_SQL,
    "state_evolution": STATE_EVOLUTION_SQL,
}


# --- shared CTE fragments ------------------------------------------------------------
def _blank_null(c: str) -> str:
    return f"CASE WHEN trim({c}, ' ') = '' THEN NULL ELSE {c} END"


def _clean_text(c: str) -> str:
    return f"coalesce({_blank_null(c)}, 'N/A')"


CONFORMED_SQL = """
conformed AS (
  SELECT ano, id_uf, sigla_uf, id_aluno,
         CAST(id_aluno % 1000 AS INTEGER) AS id_escola,
         CAST(id_aluno % 3 + 1 AS INTEGER) AS tp_dependencia,
         CAST(id_municipio AS INTEGER) AS id_municipio, nome_municipio,
         in_presenca_lp, in_alfabetizado, vl_proficiencia_lp, vl_peso_aluno_lp,
         _ingestion_timestamp
  FROM students
)"""

_SILVER_REST = ("id_uf", "sigla_uf", "id_escola", "tp_dependencia", "id_municipio",
                "nome_municipio", "in_presenca_lp", "in_alfabetizado", "vl_proficiencia_lp",
                "vl_peso_aluno_lp")

SILVER_SQL = f"""
cleaned AS (
  SELECT ano, id_uf, {_blank_null('sigla_uf')} AS sigla_uf, id_aluno, id_escola, tp_dependencia,
         id_municipio, {_blank_null('nome_municipio')} AS nome_municipio,
         in_presenca_lp, in_alfabetizado,
         {r2('vl_proficiencia_lp')} AS vl_proficiencia_lp,
         {r2('vl_peso_aluno_lp')} AS vl_peso_aluno_lp, _ingestion_timestamp
  FROM conformed
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY ano, id_aluno
    ORDER BY _ingestion_timestamp DESC NULLS LAST,
             {', '.join(c + ' DESC NULLS LAST' for c in _SILVER_REST)}) AS rn
  FROM cleaned WHERE ano IS NOT NULL AND id_aluno IS NOT NULL
),
silver AS (
  SELECT ano, id_uf, coalesce(sigla_uf, 'N/A') AS sigla_uf, id_aluno, id_escola, tp_dependencia,
         id_municipio, coalesce(nome_municipio, 'N/A') AS nome_municipio, in_presenca_lp,
         in_alfabetizado, vl_proficiencia_lp, vl_peso_aluno_lp, _ingestion_timestamp,
         'v1.8_partitioned_by_date' AS _PIPELINE_VERSION,
         '2026' AS ano_ingestao, '06' AS mes_ingestao, '30' AS dia_ingestao
  FROM ranked WHERE rn = 1
)"""

_LATEST_REST = ("id_uf", "sigla_uf", "id_municipio", "nome_municipio", "in_presenca_lp",
                "in_alfabetizado", "vl_proficiencia_lp", "vl_peso_aluno_lp")

STUDENTS_LATEST_SQL = f"""
WITH {STUDENTS_SQL},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY ano, id_aluno
    ORDER BY _ingestion_timestamp DESC NULLS LAST,
             {', '.join(c + ' DESC NULLS LAST' for c in _LATEST_REST)}) AS rn
  FROM students WHERE ano IS NOT NULL AND id_aluno IS NOT NULL
)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1"""

STUDENTS_UNION_YEARS_SQL = f"""
WITH {STUDENTS_SQL}
SELECT ano AS NU_ANO_AVALIACAO, id_uf AS CO_UF, sigla_uf AS SG_UF, id_aluno AS ID_ALUNO,
       CAST(NULL AS INTEGER) AS TP_SERIE, CAST(id_aluno % 1000 AS INTEGER) AS ID_ESCOLA,
       CAST(id_aluno % 3 + 1 AS INTEGER) AS TP_DEPENDENCIA,
       CAST(id_municipio AS INTEGER) AS CO_MUNICIPIO, nome_municipio AS NO_MUNICIPIO,
       in_presenca_lp AS IN_PRESENCA_LP, CAST(NULL AS INTEGER) AS IN_PREENCHIMENTO_LP,
       CAST(NULL AS INTEGER) AS CO_CADERNO_LP, vl_peso_aluno_lp AS VL_PESO_ALUNO_LP,
       vl_proficiencia_lp AS VL_PROFICIENCIA_LP, in_alfabetizado AS IN_ALFABETIZADO,
       id_aluno % 7 AS CO_BLOCO_1, 'ABCD' AS TX_RESPOSTA_BLOCO_1, 'ABCE' AS TX_GABARITO_BLOCO_1,
       _ingestion_timestamp, strftime(_ingestion_timestamp, '%Y%m%d') AS anomesdia
FROM students"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

CLEAN_TEXT_SQL = f"""
SELECT doc_id, {_clean_text('text')} AS text, {_clean_text('lang')} AS lang,
       {_clean_text('source')} AS source, n_chars,
       {_clean_text(f"regexp_extract(text, '{EMAIL}', 0)")} AS contact
FROM documents"""

_NET = "l_extendedprice * (1.0 - l_discount)"
CLEAN_NUMERIC_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       {r2('l_quantity')} AS l_quantity, {r2('l_extendedprice')} AS l_extendedprice,
       {r2('l_discount')} AS l_discount, {r2('l_tax')} AS l_tax,
       {_clean_text('l_returnflag')} AS l_returnflag, {_clean_text('l_linestatus')} AS l_linestatus,
       l_shipdate, {r2(_NET)} AS net_price, {r2(f'({_NET}) * (1.0 + l_tax)')} AS gross_price
FROM lineitem"""

TYPED_PROJECTION_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
       o_orderpriority, CAST(NULL AS VARCHAR) AS o_comment
FROM orders"""

RENAME_CAST_DROP_SQL = f"""
WITH {STUDENTS_SQL}, {CONFORMED_SQL}
SELECT * FROM conformed"""

BRONZE_AUDIT_SQL = """
SELECT *, TIMESTAMP '2026-06-30 12:00:00' AS _ingestion_timestamp,
       '2026-06-30' AS _ingestion_date, 'warehouse://orders' AS _source_path,
       'orders' AS _source_entity, 'dev' AS _environment
FROM orders"""

SILVER_STUDENTS_SQL = f"""
WITH {STUDENTS_SQL}, {CONFORMED_SQL}, {SILVER_SQL}
SELECT * FROM silver"""

GOLD_PUBLISHED_SQL = f"""
WITH {STUDENTS_SQL}, {CONFORMED_SQL}, {SILVER_SQL},
base AS (
  SELECT * FROM silver
  WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
    AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')
),
agg AS (
  SELECT ano, sigla_uf, id_municipio, nome_municipio, count(id_aluno) AS total_avaliados,
         CAST(sum(CASE WHEN in_alfabetizado = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_alfabetizados
  FROM base GROUP BY ano, sigla_uf, id_municipio, nome_municipio
)
SELECT *, {rate_sql('total_alfabetizados', 'total_avaliados')} AS taxa_alfabetizacao_real,
       'v1.0_gold' AS _analytics_version
FROM agg"""

CSV_ROUNDTRIP_SQL = "SELECT * FROM orders"

CATALOG_SQL_SQL = f"""
WITH ind AS ({CITY_INDICATOR_SQL})
SELECT sigla_uf, CAST(ano AS INTEGER) AS ano, count(*) AS n_cities,
       CAST(sum(total_avaliados) AS BIGINT) AS total_avaliados,
       CAST(sum(total_alfabetizados) AS BIGINT) AS total_alfabetizados,
       max(taxa_alfabetizacao_real) AS best_rate
FROM ind GROUP BY sigla_uf, ano"""


# --- data-quality reports ----------------------------------------------------------------
def _check_sql(source: str, checks: list[tuple], text_cols: set[str]) -> str:
    """One row per check, stated in SQL: (kind, column, value, critical, sentinel_flag).

    ``checks`` entries: (kind, column, value, critical, sentinel) where sentinel is
    the not_null 'N/A' flag or the regex 'N/A' exemption flag.
    """
    measures, rows = ["count(*) AS n"], []
    for i, (kind, col, value, critical, sentinel) in enumerate(checks):
        name = f"{kind}:{col}" if col else kind
        crit = "TRUE" if critical else "FALSE"
        fail = "'FAIL'" if critical else "'WARN'"
        colsql = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        if kind == "skip":
            rows.append(f"SELECT '{value}:{col}', '{value}', {colsql}, {crit}, CAST(NULL AS BIGINT), "
                        f"FALSE, 'SKIP' FROM m")
            continue
        if kind == "min_count":
            obs = "n"
            ok = f"n >= {value}"
        elif kind == "not_null":
            cond = f"{col} IS NULL" + (f" OR {col} = 'N/A'" if sentinel and col in text_cols else "")
            measures.append(f"count(*) FILTER (WHERE {cond}) AS m{i}")
            obs, ok = f"m{i}", f"m{i} = 0"
        elif kind == "unique":
            measures.append(f"count(DISTINCT {col}) + "
                            f"coalesce(max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0) AS m{i}")
            obs, ok = f"n - m{i}", f"n - m{i} = 0"
        elif kind == "regex":
            t = f"CAST({col} AS VARCHAR)"
            cond = f"{t} IS NOT NULL AND NOT regexp_matches({t}, '{value}')"
            if sentinel:
                cond += f" AND {t} <> 'N/A'"
            measures.append(f"count(*) FILTER (WHERE {cond}) AS m{i}")
            obs, ok = f"m{i}", f"m{i} = 0"
        elif kind == "range":
            lo, hi = value
            x = f"TRY_CAST({col} AS DOUBLE)"
            measures.append(f"count(*) FILTER (WHERE {x} < {lo} OR {x} > {hi}) AS m{i}")
            obs, ok = f"m{i}", f"m{i} = 0"
        else:
            raise ValueError(kind)
        rows.append(f"SELECT '{name}' AS check_name, '{kind}' AS kind, {colsql} AS column_name, "
                    f"{crit} AS critical, CAST({obs} AS BIGINT) AS observed, ({ok}) AS passed, "
                    f"CASE WHEN {ok} THEN 'PASS' ELSE {fail} END AS status FROM m")
    return f"WITH src AS ({source}), m AS (SELECT {', '.join(measures)} FROM src)\n" + \
        "\nUNION ALL\n".join(rows)


_STUDENTS_SRC = f"WITH {STUDENTS_SQL} SELECT * FROM students"

DQ_STUDENTS_SQL = _check_sql(_STUDENTS_SRC, [
    ("min_count", None, 1, True, True),
    ("not_null", "id_aluno", None, True, False),
    ("not_null", "ano", None, True, False),
    ("unique", "id_aluno", None, True, True),
    ("regex", "sigla_uf", "^[A-Z]{2}$", False, True),
    ("range", "vl_peso_aluno_lp", (1.0, 40.0), False, True),
    ("skip", "tp_serie", "not_null", True, True),
], {"sigla_uf", "nome_municipio"})

DQ_CITY_INDICATOR_SQL = _check_sql(CITY_INDICATOR_SQL, [
    ("min_count", None, 1, True, True),
    ("range", "taxa_alfabetizacao_real", (0.0, 100.0), True, True),
    ("regex", "sigla_uf", "^[A-Z]{2}$", False, True),
    ("not_null", "nome_municipio", None, True, True),
    ("unique", "id_municipio", None, False, True),
], {"sigla_uf", "nome_municipio"})

DQ_DOCUMENTS_SQL = _check_sql("SELECT * FROM documents", [
    ("min_count", None, 1, True, True),
    ("not_null", "text", None, True, True),
    ("unique", "text", None, False, True),
    ("regex", "lang", "^[a-z]{2}$", True, True),
    ("range", "n_chars", (1.0, 20000.0), False, True),
    ("not_null", "source", None, True, True),
], {"text", "lang", "source"})

def _score_sql(view: str, source: str, checks: list[tuple], text_cols: set[str]) -> str:
    """Score row of one view from its per-check SQL (skipped checks: none here)."""
    rows = _check_sql(source, checks, text_cols)
    return f"""SELECT '{view}' AS view_name, count(*) AS n_checks,
       count(*) FILTER (WHERE passed) AS n_passed,
       count(*) FILTER (WHERE NOT passed AND status <> 'SKIP') AS n_failed,
       count(*) FILTER (WHERE status = 'SKIP') AS n_skipped,
       count(*) FILTER (WHERE status = 'FAIL') AS n_critical_failed,
       CAST(round(count(*) FILTER (WHERE passed) * 100.0 / count(*), 1) AS DOUBLE) AS score,
       count(*) FILTER (WHERE status = 'FAIL') > 0 AS blocked
FROM ({rows}) c"""


DQ_GOLD_SCORES_SQL = "\nUNION ALL\n".join([
    _score_sql("indicador_alfabetizacao_municipio", CITY_INDICATOR_SQL, [
        ("min_count", None, 1, True, True),
        ("range", "taxa_alfabetizacao_real", (0.0, 100.0), True, True)], set()),
    _score_sql("comparativo_metas_resultados", TARGET_COMPARISON_SQL, [
        ("min_count", None, 1, True, True),
        ("not_null", "status_meta", None, True, True)], {"status_meta"}),
    _score_sql("evolucao_temporal_estado", STATE_EVOLUTION_SQL, [
        ("min_count", None, 1, True, True),
        ("regex", "sigla_uf", "^[A-Z]{2}$", False, True),
        ("range", "taxa_alfabetizacao_estado", (0.0, 100.0), True, True)], {"sigla_uf"}),
])

DQ_DUPLICATES_SQL = f"""
WITH {STUDENTS_SQL}
SELECT ano, id_aluno, count(*) AS n_rows FROM students
GROUP BY ano, id_aluno HAVING count(*) > 1"""

DQ_SCORE_SQL = f"""
WITH {STUDENTS_SQL},
m AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE id_aluno IS NULL) AS nn_id,
         count(*) FILTER (WHERE ano IS NULL) AS nn_ano,
         count(DISTINCT id_aluno)
           + coalesce(max(CASE WHEN id_aluno IS NULL THEN 1 ELSE 0 END), 0) AS d_id
  FROM students
),
checks AS (
  SELECT 'common' AS rule_set, n >= 1 AS passed, TRUE AS critical FROM m
  UNION ALL SELECT 'common', nn_id = 0, TRUE FROM m
  UNION ALL SELECT 'common', nn_ano = 0, TRUE FROM m
  UNION ALL SELECT 'students_job', n >= 1, TRUE FROM m
  UNION ALL SELECT 'students_job', nn_id = 0, TRUE FROM m
  UNION ALL SELECT 'students_job', nn_ano = 0, TRUE FROM m
  UNION ALL SELECT 'city_job', n >= 1, TRUE FROM m
  UNION ALL SELECT 'city_job', nn_id = 0, TRUE FROM m
  UNION ALL SELECT 'city_job', nn_ano = 0, TRUE FROM m
  UNION ALL SELECT 'city_job', n - d_id = 0, TRUE FROM m
)
SELECT rule_set, count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed,
       count(*) FILTER (WHERE NOT passed) AS n_failed, CAST(0 AS BIGINT) AS n_skipped,
       count(*) FILTER (WHERE NOT passed AND critical) AS n_critical_failed,
       round(count(*) FILTER (WHERE passed) * 100.0 / count(*), 1)::DOUBLE AS score,
       count(*) FILTER (WHERE NOT passed AND critical) > 0 AS blocked
FROM checks GROUP BY rule_set"""

DQ_MISSING_COLUMN_SQL = f"""
WITH {STUDENTS_SQL},
m AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE id_aluno IS NULL) AS nn_id,
         count(DISTINCT id_aluno)
           + coalesce(max(CASE WHEN id_aluno IS NULL THEN 1 ELSE 0 END), 0) AS d_id
  FROM students
),
checks AS (
  SELECT 'common' AS rule_set, n >= 1 AS passed, FALSE AS skipped FROM m
  UNION ALL SELECT 'common', nn_id = 0, FALSE FROM m
  UNION ALL SELECT 'common', FALSE, TRUE
  UNION ALL SELECT 'students_job', n >= 1, FALSE FROM m
  UNION ALL SELECT 'students_job', nn_id = 0, FALSE FROM m
  UNION ALL SELECT 'students_job', FALSE, FALSE
  UNION ALL SELECT 'city_job', n >= 1, FALSE FROM m
  UNION ALL SELECT 'city_job', nn_id = 0, FALSE FROM m
  UNION ALL SELECT 'city_job', FALSE, TRUE
  UNION ALL SELECT 'city_job', n - d_id = 0, FALSE FROM m
)
SELECT rule_set, count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed,
       count(*) FILTER (WHERE NOT passed AND NOT skipped) AS n_failed,
       count(*) FILTER (WHERE skipped) AS n_skipped,
       count(*) FILTER (WHERE NOT passed AND NOT skipped) AS n_critical_failed,
       round(count(*) FILTER (WHERE passed) * 100.0 / count(*), 1)::DOUBLE AS score,
       count(*) FILTER (WHERE NOT passed AND NOT skipped) > 0 AS blocked
FROM checks GROUP BY rule_set"""

INVALID_PATTERNS_SQL = """
SELECT doc_id, 'regex:lang' AS rule FROM documents
WHERE lang IS NOT NULL AND lang <> 'N/A' AND NOT regexp_matches(lang, '^[a-z]{2}$')
UNION ALL
SELECT doc_id, 'range:n_chars' FROM documents WHERE n_chars < 1 OR n_chars > 20000
UNION ALL
SELECT doc_id, 'regex:source' FROM documents
WHERE source IS NOT NULL AND source <> 'N/A' AND NOT regexp_matches(source, '^src[0-9]$')"""

STREAM_DEDUP_EVENTS_SQL = """
SELECT DISTINCT event_id, ts, user_id, event_type, value, props, 'events' AS _source_entity
FROM events"""

STREAM_DAILY_INDICATOR_SQL = f"""
WITH d AS (
  SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n_events,
         CAST(sum(CASE WHEN value >= 50.0 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged
  FROM events GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n_events,
       n_flagged, {rate_sql('n_flagged', 'n_events')} AS flag_rate
FROM d"""

# append mode: a window is emitted once the watermark (newest event - 1 day)
# has passed its end
STREAM_DAILY_INDICATOR_APPEND_SQL = f"""
SELECT * FROM ({STREAM_DAILY_INDICATOR_SQL}) w
WHERE w.window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""

ORACLE.update({
    "stream_daily_indicator_append": STREAM_DAILY_INDICATOR_APPEND_SQL,
    "stream_dedup_events": STREAM_DEDUP_EVENTS_SQL,
    "stream_daily_indicator": STREAM_DAILY_INDICATOR_SQL,
    "students_latest": STUDENTS_LATEST_SQL,
    "students_union_years": STUDENTS_UNION_YEARS_SQL,
    "clean_text": CLEAN_TEXT_SQL,
    "clean_numeric": CLEAN_NUMERIC_SQL,
    "typed_projection": TYPED_PROJECTION_SQL,
    "rename_cast_drop": RENAME_CAST_DROP_SQL,
    "bronze_audit": BRONZE_AUDIT_SQL,
    "silver_students": SILVER_STUDENTS_SQL,
    "gold_published": GOLD_PUBLISHED_SQL,
    "csv_roundtrip": CSV_ROUNDTRIP_SQL,
    "catalog_sql": CATALOG_SQL_SQL,
    "dq_students": DQ_STUDENTS_SQL,
    "dq_city_indicator": DQ_CITY_INDICATOR_SQL,
    "dq_documents": DQ_DOCUMENTS_SQL,
    "dq_gold_scores": DQ_GOLD_SCORES_SQL,
    "dq_duplicates": DQ_DUPLICATES_SQL,
    "dq_score": DQ_SCORE_SQL,
    "dq_missing_column": DQ_MISSING_COLUMN_SQL,
    # kept up to date batch by batch, they must equal the builds over everything
    "silver_incremental": SILVER_STUDENTS_SQL,
    "gold_incremental": GOLD_PUBLISHED_SQL,
    "invalid_patterns": INVALID_PATTERNS_SQL,
})


# --- single-operator queries -------------------------------------------------------------
TARGET_PROJECTION_SQL = f"""
WITH {TARGETS_SQL}
SELECT DISTINCT CAST(id_municipio AS VARCHAR) AS id_municipio,
       CAST(meta_alfabetizacao_1996 AS DOUBLE) AS meta_1996,
       CAST(meta_alfabetizacao_1997 AS DOUBLE) AS meta_1997
FROM targets"""

TARGET_COMPARISON_LATEST_SQL = TARGET_COMPARISON_SQL.replace(
    """  SELECT DISTINCT CAST(id_municipio AS VARCHAR) AS id_municipio,
         meta_alfabetizacao_1996 AS meta_1996, meta_alfabetizacao_1997 AS meta_1997
  FROM targets""",
    """  SELECT CAST(id_municipio AS VARCHAR) AS id_municipio,
         meta_alfabetizacao_1996 + 1.5 AS meta_1996, meta_alfabetizacao_1997 + 1.5 AS meta_1997
  FROM targets""")
assert TARGET_COMPARISON_LATEST_SQL != TARGET_COMPARISON_SQL

TARGET_COMPARISON_BY_YEAR_SQL = f"""
WITH {STUDENTS_SQL}, {TARGETS_SQL},
base AS (
  SELECT * FROM students
  WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
    AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')
),
agg AS (
  SELECT ano, sigla_uf, id_municipio, nome_municipio,
         count(id_aluno) AS total_avaliados,
         CAST(sum(CASE WHEN in_alfabetizado = 1 THEN 1 ELSE 0 END) AS BIGINT) AS total_alfabetizados
  FROM base GROUP BY ano, sigla_uf, id_municipio, nome_municipio
),
ind AS (
  SELECT *, {rate_sql('total_alfabetizados', 'total_avaliados')} AS taxa_alfabetizacao_real FROM agg
),
history AS (
  SELECT id_municipio, meta_alfabetizacao_1996 AS m96, meta_alfabetizacao_1997 AS m97 FROM targets
  UNION ALL
  SELECT id_municipio, meta_alfabetizacao_1996 + 1.5, meta_alfabetizacao_1997 + 1.5 FROM targets
),
long AS (
  SELECT DISTINCT id_municipio, 1996 AS yr, m96 AS meta FROM history WHERE m96 IS NOT NULL
  UNION
  SELECT DISTINCT id_municipio, 1997, m97 FROM history WHERE m97 IS NOT NULL
),
j AS (
  SELECT ind.*, long.meta AS meta_ano
  FROM ind LEFT JOIN long
    ON CAST(ind.id_municipio AS VARCHAR) = long.id_municipio AND ind.ano = long.yr
),
d AS (SELECT *, {r2('taxa_alfabetizacao_real - meta_ano')} AS desvio_meta FROM j)
SELECT ano, sigla_uf, id_municipio, nome_municipio, total_avaliados, taxa_alfabetizacao_real,
       meta_ano, desvio_meta,
       CASE WHEN meta_ano IS NULL THEN 'Sem Meta Definida'
            WHEN desvio_meta >= 0 THEN 'Atingiu a Meta'
            ELSE 'Abaixo da Meta' END AS status_meta
FROM d"""

PRESENT_STUDENTS_SQL = f"""
WITH {STUDENTS_SQL}
SELECT ano, sigla_uf, id_municipio, nome_municipio, id_aluno, in_alfabetizado, in_presenca_lp
FROM students
WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL
  AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')"""

SILVER_TARGETS_SQL = f"""
WITH {TARGETS_SQL},
history AS (
  SELECT * FROM targets
  UNION ALL
  SELECT 1996, id_municipio, rede, meta_alfabetizacao_1996 + 1.5, meta_alfabetizacao_1997 + 1.5
  FROM targets
),
cleaned AS (
  SELECT ano, {_blank_null('id_municipio')} AS id_municipio, {_blank_null('rede')} AS rede,
         {r2('meta_alfabetizacao_1996')} AS meta_alfabetizacao_1996,
         {r2('meta_alfabetizacao_1997')} AS meta_alfabetizacao_1997
  FROM history
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ano, id_municipio
                               ORDER BY rede DESC NULLS LAST,
                                        meta_alfabetizacao_1996 DESC NULLS LAST,
                                        meta_alfabetizacao_1997 DESC NULLS LAST) AS rn
  FROM cleaned
  WHERE ano IS NOT NULL AND id_municipio IS NOT NULL AND id_municipio <> 'N/A'
)
SELECT ano, id_municipio, coalesce(rede, 'N/A') AS rede, meta_alfabetizacao_1996,
       meta_alfabetizacao_1997, 'v1.8_partitioned_by_date' AS _PIPELINE_VERSION,
       '2026' AS ano_ingestao, '06' AS mes_ingestao, '30' AS dia_ingestao
FROM ranked WHERE rn = 1"""

_UPPER_REST = ("CO_UF", "SG_UF", "ID_ESCOLA", "TP_DEPENDENCIA", "CO_MUNICIPIO", "NO_MUNICIPIO",
               "IN_PRESENCA_LP", "IN_ALFABETIZADO", "VL_PROFICIENCIA_LP", "VL_PESO_ALUNO_LP",
               "CO_BLOCO_1", "TX_RESPOSTA_BLOCO_1", "TX_GABARITO_BLOCO_1", "ANOMESDIA")

SILVER_STUDENTS_UPPER_SQL = f"""
WITH {STUDENTS_SQL},
raw AS (
  SELECT ano AS NU_ANO_AVALIACAO, id_uf AS CO_UF, sigla_uf AS SG_UF, id_aluno AS ID_ALUNO,
         CAST(id_aluno % 1000 AS VARCHAR) AS ID_ESCOLA,
         CAST(id_aluno % 3 + 1 AS DOUBLE) AS TP_DEPENDENCIA, id_municipio AS CO_MUNICIPIO,
         nome_municipio AS NO_MUNICIPIO, in_presenca_lp AS IN_PRESENCA_LP,
         in_alfabetizado AS IN_ALFABETIZADO, vl_proficiencia_lp AS VL_PROFICIENCIA_LP,
         vl_peso_aluno_lp AS VL_PESO_ALUNO_LP, id_aluno % 7 AS CO_BLOCO_1,
         'ABCD' AS TX_RESPOSTA_BLOCO_1, 'ABCE' AS TX_GABARITO_BLOCO_1,
         _ingestion_timestamp AS _INGESTION_TIMESTAMP,
         strftime(_ingestion_timestamp, '%Y%m%d') AS ANOMESDIA
  FROM students
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY NU_ANO_AVALIACAO, ID_ALUNO
    ORDER BY _INGESTION_TIMESTAMP DESC NULLS LAST,
             {', '.join(c + ' DESC NULLS LAST' for c in _UPPER_REST)}) AS rn
  FROM raw WHERE NU_ANO_AVALIACAO IS NOT NULL AND ID_ALUNO IS NOT NULL
)
SELECT NU_ANO_AVALIACAO, CO_UF, {_clean_text('SG_UF')} AS SG_UF, ID_ALUNO,
       {_clean_text('ID_ESCOLA')} AS ID_ESCOLA, {r2('TP_DEPENDENCIA')} AS TP_DEPENDENCIA,
       CO_MUNICIPIO, {_clean_text('NO_MUNICIPIO')} AS NO_MUNICIPIO, IN_PRESENCA_LP,
       IN_ALFABETIZADO, {r2('VL_PROFICIENCIA_LP')} AS VL_PROFICIENCIA_LP,
       {r2('VL_PESO_ALUNO_LP')} AS VL_PESO_ALUNO_LP, CO_BLOCO_1,
       {_clean_text('TX_RESPOSTA_BLOCO_1')} AS TX_RESPOSTA_BLOCO_1,
       {_clean_text('TX_GABARITO_BLOCO_1')} AS TX_GABARITO_BLOCO_1, _INGESTION_TIMESTAMP,
       {_clean_text('ANOMESDIA')} AS ANOMESDIA, 'v1.2_silver_uppercase' AS _PIPELINE_VERSION
FROM ranked WHERE rn = 1"""

BRONZE_STUDENTS_CSV_SQL = f"""
WITH {STUDENTS_SQL}
SELECT ano AS NU_ANO_AVALIACAO, id_uf AS CO_UF, sigla_uf AS SG_UF, id_aluno AS ID_ALUNO,
       CAST(NULL AS INTEGER) AS TP_SERIE, CAST(id_aluno % 1000 AS INTEGER) AS ID_ESCOLA,
       CAST(id_aluno % 3 + 1 AS INTEGER) AS TP_DEPENDENCIA,
       CAST(id_municipio AS INTEGER) AS CO_MUNICIPIO, nome_municipio AS NO_MUNICIPIO,
       in_presenca_lp AS IN_PRESENCA_LP, CAST(NULL AS INTEGER) AS IN_PREENCHIMENTO_LP,
       CAST(NULL AS INTEGER) AS CO_CADERNO_LP, vl_peso_aluno_lp AS VL_PESO_ALUNO_LP,
       vl_proficiencia_lp AS VL_PROFICIENCIA_LP, in_alfabetizado AS IN_ALFABETIZADO,
       TIMESTAMP '2026-06-30 12:00:00' AS _ingestion_timestamp, '2026-06-30' AS _ingestion_date,
       'raw/alunos.csv' AS _source_path, 'alunos' AS _source_entity, 'dev' AS _environment
FROM students"""

ORACLE.update({
    "target_projection": TARGET_PROJECTION_SQL,
    "target_comparison_latest": TARGET_COMPARISON_LATEST_SQL,
    "target_comparison_by_year": TARGET_COMPARISON_BY_YEAR_SQL,
    "present_students": PRESENT_STUDENTS_SQL,
    "silver_targets": SILVER_TARGETS_SQL,
    "silver_students_upper": SILVER_STUDENTS_UPPER_SQL,
    "bronze_students_csv": BRONZE_STUDENTS_CSV_SQL,
})

ORACLE["csv_documents"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, text FROM documents"""

# --- whole jobs ------------------------------------------------------------------------
# bronze batches: each year on its own day, the first year's even ids again on 28 June
_BATCHES_SQL = f"""
WITH {STUDENTS_SQL},
bronze AS (
  SELECT * EXCLUDE (_ingestion_timestamp),
         TIMESTAMP '2026-06-01 08:00:00'
           + to_days(CAST(dense_rank() OVER (ORDER BY ano) - 1 AS INTEGER)) AS _ingestion_timestamp
  FROM students
  UNION ALL
  SELECT * EXCLUDE (_ingestion_timestamp) REPLACE (vl_proficiencia_lp + 1.0 AS vl_proficiencia_lp),
         TIMESTAMP '2026-06-28 08:00:00'
  FROM students WHERE ano = (SELECT min(ano) FROM students) AND id_aluno % 2 = 0
),
cleaned AS (
  SELECT * REPLACE ({r2('vl_proficiencia_lp')} AS vl_proficiencia_lp,
                    {r2('vl_peso_aluno_lp')} AS vl_peso_aluno_lp) FROM bronze
),
lake AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY ano, id_aluno
    ORDER BY _ingestion_timestamp DESC, id_uf DESC, sigla_uf DESC, id_municipio DESC,
             nome_municipio DESC, in_presenca_lp DESC, vl_peso_aluno_lp DESC,
             vl_proficiencia_lp DESC, in_alfabetizado DESC) = 1
)"""

ORACLE["silver_run"] = _BATCHES_SQL + """
SELECT ano, id_aluno, sigla_uf, CAST(id_municipio AS INTEGER) AS id_municipio, in_presenca_lp,
       in_alfabetizado, vl_proficiencia_lp, vl_peso_aluno_lp, _ingestion_timestamp,
       '28' AS dia_ingestao
FROM lake"""

ORACLE["lake_run_log"] = _BATCHES_SQL + """
SELECT 'alunos' AS entity, 'written' AS status, (SELECT count(*) FROM bronze) AS rows_in,
       (SELECT count(*) FROM lake) AS rows_out
UNION ALL SELECT 'meta_alfabetizacao_municipio', 'written', count(*), count(*) FROM supplier
UNION ALL SELECT 'uf', 'skipped', 0, 0
UNION ALL SELECT 'municipio', 'skipped', 0, 0"""

# the goal comparison over the lake's students (silver stores the city id as int)
_LAKE_COMPARISON = TARGET_COMPARISON_SQL.replace(f"WITH {STUDENTS_SQL}", _BATCHES_SQL) \
    .replace("SELECT * FROM students\n  WHERE in_presenca_lp = 1",
             "SELECT * REPLACE (CAST(id_municipio AS INTEGER) AS id_municipio) FROM lake\n"
             "  WHERE in_presenca_lp = 1")
ORACLE["lake_gold"] = _LAKE_COMPARISON

ORACLE["quality_reports"] = DQ_DOCUMENTS_SQL + """
UNION ALL
SELECT 'regex:lang', 'regex', 'lang', FALSE, CAST(NULL AS BIGINT), FALSE, 'WARN' FROM m"""

ORACLE["ordered_sample"] = f"""
SELECT ano, id_aluno, sigla_uf, vl_proficiencia_lp FROM ({SILVER_STUDENTS_SQL}) s
ORDER BY ano, id_aluno LIMIT 50"""

_OTHER_FLAG = "CASE (l.l_orderkey * 10 + l.l_linenumber) % 3 WHEN 0 THEN '0' WHEN 1 THEN 'N/A' END"
_TEXT_STUDENTS_SQL = STUDENTS_SQL \
    .replace("CAST(l.l_linestatus = 'F' AS INTEGER)",
             f"CASE WHEN l.l_linestatus = 'F' THEN '1' ELSE {_OTHER_FLAG} END") \
    .replace("CAST(l.l_returnflag = 'R' AS INTEGER)",
             f"CASE WHEN l.l_returnflag = 'R' THEN '1' ELSE {_OTHER_FLAG} END")
ORACLE["text_flags"] = CITY_INDICATOR_SQL \
    .replace(STUDENTS_SQL, f"{_TEXT_STUDENTS_SQL}, {CONFORMED_SQL}, {SILVER_SQL}") \
    .replace("SELECT * FROM students\n  WHERE in_presenca_lp = 1",
             "SELECT * FROM silver\n  WHERE in_presenca_lp = '1'") \
    .replace("in_alfabetizado = 1", "in_alfabetizado = '1'")

_UPPER_STUDENTS_SQL = f"""
students AS (
  SELECT NU_ANO_AVALIACAO AS ano, SG_UF AS sigla_uf, CO_MUNICIPIO AS id_municipio,
         NO_MUNICIPIO AS nome_municipio, ID_ALUNO AS id_aluno, IN_PRESENCA_LP AS in_presenca_lp,
         IN_ALFABETIZADO AS in_alfabetizado
  FROM ({SILVER_STUDENTS_UPPER_SQL}) u
)"""
ORACLE["gold_upper"] = f"""
SELECT ano AS NU_ANO_AVALIACAO, sigla_uf AS SG_UF, id_municipio AS CO_MUNICIPIO,
       nome_municipio AS NO_MUNICIPIO, total_avaliados AS TOTAL_AVALIADOS,
       taxa_alfabetizacao_real AS TAXA_ALFABETIZACAO_REAL, meta_ano AS META_ANO,
       desvio_meta AS DESVIO_META, status_meta AS STATUS_META
FROM ({TARGET_COMPARISON_SQL.replace(STUDENTS_SQL, _UPPER_STUDENTS_SQL)}) c"""

_ALL_CITIES_SQL = CITY_INDICATOR_SQL.replace("WHERE in_presenca_lp = 1 AND id_municipio IS NOT NULL",
                                             "WHERE TRUE OR id_municipio IS NULL") \
    .replace("AND CAST(id_municipio AS VARCHAR) NOT IN ('N/A', '', 'NaN')", "")
_ENTITY_SQL = {
    "alunos": _STUDENTS_SRC,
    "meta_alfabetizacao_brasil": f"WITH {TARGETS_SQL} SELECT DISTINCT ano, rede FROM targets",
    "meta_alfabetizacao_uf": """SELECT DISTINCT 1995 AS ano,
        chr(65 + n_nationkey) || chr(65 + n_regionkey) AS sigla_uf
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "meta_alfabetizacao_municipio": f"WITH {TARGETS_SQL} SELECT * FROM targets",
    "municipio": f"SELECT ano, id_municipio FROM ({_ALL_CITIES_SQL}) c",
    "uf": f"SELECT DISTINCT ano, sigla_uf FROM ({_ALL_CITIES_SQL}) c",
}
_TEXT_COLUMNS = {"sigla_uf", "rede"}


def _entity_score_sql(entity: str, rule_set: str) -> str:
    checks = [(c.kind, c.column, c.value, c.critical,
               c.sentinel_is_null if c.kind == "not_null" else c.regex_exempt_sentinel)
              for c in RULE_SETS[rule_set][entity]]
    # city targets store the city id as text
    text = _TEXT_COLUMNS | ({"id_municipio"} if entity == "meta_alfabetizacao_municipio" else set())
    scored = _score_sql(entity, _ENTITY_SQL[entity], checks, text)
    return f"SELECT view_name AS entity, '{rule_set}' AS rule_set, * EXCLUDE (view_name) FROM ({scored}) s"


ORACLE["dq_entity_scores"] = "\nUNION ALL\n".join(
    _entity_score_sql(e, r) for e in _ENTITY_SQL for r in ("common", "students_job", "city_job"))
