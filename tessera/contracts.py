"""Entity contracts: keys, renames, drops, casts and checks per entity.

A contract is data; the same cleaning / dedup / check code runs for every
entity. Unknown columns are kept, missing optional columns are tolerated.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tessera.constants import ANSWER_BLOCK_COLUMNS, STATE_CODE_PATTERN, STUDENT_RENAMES


@dataclass(frozen=True)
class Check:
    """One data-quality rule.

    kind: ``not_null`` | ``min_count`` | ``unique`` | ``regex`` | ``range``
    value: threshold (min_count), pattern (regex) or (lo, hi) (range)
    critical: a failed critical check blocks the write (FAIL), else WARN
    sentinel_is_null: ``not_null`` also counts the 'N/A' text sentinel
    regex_exempt_sentinel: ``regex`` ignores the 'N/A' text sentinel
    """

    kind: str
    column: str | None = None
    value: object = None
    critical: bool = True
    sentinel_is_null: bool = True
    regex_exempt_sentinel: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


@dataclass(frozen=True)
class EntityContract:
    name: str
    keys: tuple[str, ...] = ()
    schema: StructType | None = None          # typed bronze schema (CSV / typed projection)
    lower_case: bool = False                  # lower-case raw names first (students)
    rename: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    int_columns: tuple[str, ...] = ()         # try_cast to int when present
    string_columns: tuple[str, ...] = ()      # cast to string when present
    checks: tuple[Check, ...] = ()
    order_by: tuple[str, ...] = ("_ingestion_timestamp",)  # newest wins in dedup


# --- fixed values: entity column lists, business keys and check rule sets ---
# Column names/types, keys and checks below must equal the original jobs'
# for identical results; they are stated as data, in the original order.

def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


_S, _I, _D, _L = StringType(), IntegerType(), DoubleType(), LongType()

_TARGET_YEARS = tuple((f"meta_alfabetizacao_{y}", _D) for y in range(2024, 2031))

STUDENT_SCHEMA = _schema(
    ("NU_ANO_AVALIACAO", _I), ("CO_UF", _I), ("SG_UF", _S), ("ID_ALUNO", _L), ("TP_SERIE", _I),
    ("ID_ESCOLA", _I), ("TP_DEPENDENCIA", _I), ("CO_MUNICIPIO", _I), ("NO_MUNICIPIO", _S),
    ("IN_PRESENCA_LP", _I), ("IN_PREENCHIMENTO_LP", _I), ("CO_CADERNO_LP", _I),
    ("VL_PESO_ALUNO_LP", _D), ("VL_PROFICIENCIA_LP", _D), ("IN_ALFABETIZADO", _I))

NATIONAL_TARGET_SCHEMA = _schema(("ano", _I), ("rede", _S), ("taxa_alfabetizacao", _D),
                                 *_TARGET_YEARS, ("percentual_participacao", _D))
STATE_TARGET_SCHEMA = _schema(("ano", _I), ("sigla_uf", _S), ("rede", _S),
                              ("taxa_alfabetizacao", _D), *_TARGET_YEARS,
                              ("percentual_participacao", _D))
CITY_TARGET_SCHEMA = _schema(("ano", _I), ("id_municipio", _I), ("rede", _S),
                             ("taxa_alfabetizacao", _D), *_TARGET_YEARS,
                             ("nivel_alfabetizacao", _D), ("percentual_participacao", _D))
_LEVELS = tuple((f"proporcao_aluno_nivel_{i}", _D) for i in range(9))
CITY_RESULT_SCHEMA = _schema(("ano", _I), ("id_municipio", _I), ("serie", _I), ("rede", _I),
                             ("taxa_alfabetizacao", _D), ("media_portugues", _D), *_LEVELS)
STATE_RESULT_SCHEMA = _schema(("ano", _I), ("sigla_uf", _S), ("serie", _I), ("rede", _I),
                              ("taxa_alfabetizacao", _D), ("media_portugues", _D), *_LEVELS)


def _min1() -> Check:
    return Check("min_count", value=1)


def _nn(col: str, **kw) -> Check:
    return Check("not_null", col, **kw)


def _state_regex(critical: bool = False, **kw) -> Check:
    return Check("regex", "sigla_uf", STATE_CODE_PATTERN, critical=critical, **kw)


_TARGET_STRINGS = ("rede", "sigla_uf", "nome_municipio")

# Silver checks of the common silver job (one rule set per entity).
CONTRACTS: dict[str, EntityContract] = {
    "alunos": EntityContract(
        "alunos", keys=("ano", "id_aluno"), schema=STUDENT_SCHEMA, lower_case=True,
        rename=dict(STUDENT_RENAMES), drop=ANSWER_BLOCK_COLUMNS,
        int_columns=("id_escola", "tp_dependencia", "id_municipio", "ano"),
        checks=(_min1(), _nn("id_aluno"), _nn("ano"))),
    "meta_alfabetizacao_brasil": EntityContract(
        "meta_alfabetizacao_brasil", keys=("ano", "rede"), schema=NATIONAL_TARGET_SCHEMA,
        string_columns=_TARGET_STRINGS, checks=(_min1(), _nn("ano"), _nn("rede"))),
    "meta_alfabetizacao_uf": EntityContract(
        "meta_alfabetizacao_uf", keys=("ano", "sigla_uf"), schema=STATE_TARGET_SCHEMA,
        string_columns=_TARGET_STRINGS,
        checks=(_min1(), _nn("ano"), _nn("sigla_uf"), _state_regex())),
    "meta_alfabetizacao_municipio": EntityContract(
        "meta_alfabetizacao_municipio", keys=("ano", "id_municipio"), schema=CITY_TARGET_SCHEMA,
        string_columns=_TARGET_STRINGS, checks=(_min1(), _nn("ano"), _nn("id_municipio"))),
    "municipio": EntityContract(
        "municipio", keys=("ano", "id_municipio"), schema=CITY_RESULT_SCHEMA,
        string_columns=_TARGET_STRINGS, checks=(_min1(), _nn("id_municipio"), _nn("ano"))),
    "uf": EntityContract(
        "uf", keys=("ano", "sigla_uf"), schema=STATE_RESULT_SCHEMA,
        string_columns=_TARGET_STRINGS,
        checks=(_min1(), _nn("sigla_uf"), _nn("ano"), _state_regex())),
    "dicionario": EntityContract("dicionario"),  # bronze only, never cleaned
}

SILVER_ENTITIES = ("alunos", "meta_alfabetizacao_brasil", "meta_alfabetizacao_uf",
                   "meta_alfabetizacao_municipio", "municipio", "uf")

# The two other silver rule-set variants (students job, city job).
STUDENTS_JOB_CHECKS: dict[str, tuple[Check, ...]] = {
    "alunos": (_min1(), _nn("id_aluno"), _nn("ano")),
    "meta_alfabetizacao_brasil": (_min1(), _nn("ano"), _nn("rede")),
    "meta_alfabetizacao_uf": (_min1(), _nn("sigla_uf"), _state_regex()),
    "meta_alfabetizacao_municipio": (_min1(), _nn("id_municipio")),
    "municipio": (_min1(), _nn("id_municipio"), Check("unique", "id_municipio")),
    "uf": (_min1(), _nn("sigla_uf"), _state_regex(critical=True)),
}

_CITY_JOB_NN = {"sentinel_is_null": False}
_CITY_JOB_RX = {"regex_exempt_sentinel": False}
CITY_JOB_CHECKS: dict[str, tuple[Check, ...]] = {
    "alunos": (_min1(), _nn("id_aluno", **_CITY_JOB_NN), _nn("ano", **_CITY_JOB_NN),
               Check("unique", "id_aluno")),
    "meta_alfabetizacao_brasil": (_min1(), _nn("ano", **_CITY_JOB_NN), _nn("rede", **_CITY_JOB_NN)),
    "meta_alfabetizacao_uf": (_min1(), _nn("ano", **_CITY_JOB_NN), _nn("sigla_uf", **_CITY_JOB_NN),
                              _state_regex(**_CITY_JOB_RX)),
    "meta_alfabetizacao_municipio": (_min1(), _nn("ano", **_CITY_JOB_NN),
                                     _nn("id_municipio", **_CITY_JOB_NN)),
    "municipio": (_min1(), _nn("id_municipio", **_CITY_JOB_NN), _nn("ano", **_CITY_JOB_NN)),
    "uf": (_min1(), _nn("sigla_uf", **_CITY_JOB_NN), Check("unique", "sigla_uf"),
           _state_regex(**_CITY_JOB_RX)),
}

# Gold view checks.
GOLD_CHECKS: dict[str, tuple[Check, ...]] = {
    "indicador_alfabetizacao_municipio": (
        _min1(), Check("range", "taxa_alfabetizacao_real", (0.0, 100.0))),
    "comparativo_metas_resultados": (_min1(), _nn("status_meta")),
    "evolucao_temporal_estado": (
        _min1(), _state_regex(critical=False),
        Check("range", "taxa_alfabetizacao_estado", (0.0, 100.0))),
}

RULE_SETS = {"common": {k: v.checks for k, v in CONTRACTS.items() if v.checks},
             "students_job": STUDENTS_JOB_CHECKS, "city_job": CITY_JOB_CHECKS,
             "gold": GOLD_CHECKS}

# What a check on an absent column does under each rule set: the students job
# has no guard, so the column lookup raises and the check fails; the others skip.
MISSING_COLUMN_POLICY = {"common": "skip", "students_job": "fail", "city_job": "skip",
                         "gold": "skip"}
