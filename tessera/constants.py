"""Fixed values.

These must equal the original job's values for identical output: sentinels,
tokens, labels, names and patterns. Listed plainly, in natural order.
"""

# --- fixed values: text sentinel and null tokens ---------------------------
MISSING_TEXT = "N/A"                                  # stands for blank / null text
NULL_TOKENS = ("NaN", "nan", "None", "NULL")          # read as NULL before a typed cast
INVALID_ID_TEXT = ("N/A", "", "NaN")                  # city ids that are not counted

# --- fixed values: goal status labels --------------------------------------
STATUS_NO_TARGET = "Sem Meta Definida"
STATUS_MET = "Atingiu a Meta"
STATUS_BELOW = "Abaixo da Meta"

# --- fixed values: state code pattern --------------------------------------
STATE_CODE_PATTERN = r"^[A-Z]{2}$"

# --- fixed values: student columns renamed to silver names -----------------
STUDENT_RENAMES = {
    "nu_ano_avaliacao": "ano",
    "sg_uf": "sigla_uf",
    "co_uf": "id_uf",
    "co_municipio": "id_municipio",
    "no_municipio": "nome_municipio",
}

# --- fixed values: answer-block columns dropped from students --------------
ANSWER_BLOCK_COLUMNS = (
    "co_bloco_1", "tx_resposta_bloco_1", "tx_gabarito_bloco_1",
    "co_bloco_2", "tx_resposta_bloco_2", "tx_gabarito_bloco_2",
    "co_bloco_3", "tx_resposta_bloco_3", "tx_gabarito_bloco_3",
    "co_bloco_4", "tx_resposta_bloco_4", "tx_gabarito_bloco_4",
)

# --- fixed values: stale bronze batch columns dropped in silver ------------
BATCH_COLUMNS = ("mes", "dia", "ANOMESDIA", "anomesdia")

# --- fixed values: audit column names and versions -------------------------
BRONZE_AUDIT_COLUMNS = ("_ingestion_timestamp", "_ingestion_date", "_source_path",
                        "_source_entity", "_environment")
SILVER_PROCESSED_AT = "_SILVER_PROCESSED_AT"
SILVER_VERSION_COLUMN = "_PIPELINE_VERSION"
SILVER_VERSION = "v1.8_partitioned_by_date"
SILVER_PARTITIONS = ("ano_ingestao", "mes_ingestao", "dia_ingestao")
NOTEBOOK_SILVER_VERSION = "v1.2_silver_uppercase"     # upper-case (notebook) variant
NOTEBOOK_NAME_ALIASES = {"SIGLA_UF": "SG_UF"}
GOLD_PROCESSED_AT = "_gold_processed_at"
GOLD_VERSION_COLUMN = "_analytics_version"
BATCH_PARTITION = "anomesdia"

# --- fixed values: gold view names ------------------------------------------
VIEW_CITY_INDICATOR = "indicador_alfabetizacao_municipio"
VIEW_TARGET_COMPARISON = "comparativo_metas_resultados"
VIEW_STATE_EVOLUTION = "evolucao_temporal_estado"

# fixed values: grouping keys and columns of the gold views
CITY_KEYS = ("ano", "sigla_uf", "id_municipio", "nome_municipio")
STATE_KEYS = ("ano", "sigla_uf")
COMPARISON_COLUMNS = ("ano", "sigla_uf", "id_municipio", "nome_municipio", "total_avaliados",
                      "taxa_alfabetizacao_real", "meta_ano", "desvio_meta", "status_meta")
