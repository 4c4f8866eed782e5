"""Column rules and value cleaning (PRJ-4 .. PRJ-14, SRC-4/5): fixtures E1-E3, E18."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tessera.contracts import CONTRACTS
from tessera.operators import columns as cols
from tessera.operators.clean import clean_values, fill_text, typed_projection
from tessera.plans.silver import conform


def test_blank_text_becomes_sentinel_untrimmed(spark):  # E1
    df = spark.createDataFrame([("",), ("  ",), (None,), (" x ",)], "t string")
    out = [r.t for r in clean_values(df).collect()]
    assert out == ["N/A", "N/A", "N/A", " x "]


def test_blank_to_null_without_fill(spark):
    df = spark.createDataFrame([("",), ("a",)], "t string")
    assert [r.t for r in clean_values(df, fill=False).collect()] == [None, "a"]


def test_null_tokens_become_null_before_cast(spark):  # E2
    df = spark.createDataFrame([("NaN", "nan"), ("None", "NULL"), ("7", "1.5"), ("x", "y")],
                               "i string, d string")
    schema = StructType([StructField("i", IntegerType()), StructField("d", DoubleType())])
    out = [tuple(r) for r in typed_projection(df, schema).collect()]
    assert out == [(None, None), (None, None), (7, 1.5), (None, None)]


def test_typed_projection_missing_column_and_no_schema(spark):  # SRC-4 / SRC-5
    df = spark.createDataFrame([("1", "a")], "a string, b string")
    schema = StructType([StructField("a", LongType()), StructField("z", StringType())])
    out = typed_projection(df, schema)
    assert out.columns == ["a", "z"] and tuple(out.first()) == (1, None)
    untyped = typed_projection(spark.createDataFrame([(1, 2.0)], "a int, b double"), None)
    assert all(isinstance(f.dataType, StringType) for f in untyped.schema.fields)


def test_rounding_half_up_and_ints_untouched(spark):  # E3
    df = spark.createDataFrame([(1.005, 7), (2.675, 7), (-0.145, 7), (None, 7)], "d double, i int")
    out = clean_values(df).collect()
    assert [r.d for r in out] == [1.01, 2.68, -0.15, None]
    assert [r.i for r in out] == [7, 7, 7, 7]
    assert dict(clean_values(df).dtypes)["i"] == "int"


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame([(" a", 1.234, ""), (None, None, "b")], "s string, d double, t string")
    once = clean_values(df)
    twice = clean_values(once)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_fill_text_subset(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert tuple(fill_text(df, ["a"]).first()) == ("N/A", None)


def test_lower_upper_rename_drop_cast(spark):  # PRJ-4..10
    df = spark.createDataFrame([(2024, "SP", "12", 3.0, 1, "x")],
                               "NU_ANO_AVALIACAO int, SG_UF string, ID_ESCOLA string, "
                               "TP_DEPENDENCIA double, CO_BLOCO_1 int, anomesdia string")
    out = conform(df, CONTRACTS["alunos"])
    assert out.columns == ["ano", "sigla_uf", "id_escola", "tp_dependencia"]
    assert dict(out.dtypes) == {"ano": "int", "sigla_uf": "string", "id_escola": "int",
                                "tp_dependencia": "int"}
    assert tuple(out.first()) == (2024, "SP", 12, 3)
    up = cols.upper_case_names(spark.createDataFrame([(1,)], "sigla_uf int"), {"SIGLA_UF": "SG_UF"})
    assert up.columns == ["SG_UF"]


def test_name_collision_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`A` int, `b` int").toDF("A", "a")
    with pytest.raises(ValueError):
        cols.lower_case_names(df)


def test_bad_int_text_becomes_null_under_ansi(spark):  # D1
    df = spark.createDataFrame([("12",), ("N/A",)], "id_escola string")
    out = cols.cast_present(df, ["id_escola", "absent"], "int")
    assert [r.id_escola for r in out.collect()] == [12, None]


def test_round_applies_to_decimals(spark):  # D8
    df = spark.createDataFrame([(1,)], "x int").select(F.lit(1.239).cast("decimal(10,3)").alias("d"))
    assert float(clean_values(df).first().d) == 1.24


def test_decimal_text_reaches_int_column(spark):  # PRJ-9 with non-ANSI-compatible result
    df = spark.createDataFrame([("2.0",), ("7",), ("2.9",), ("-1.5",), ("x",), (None,)], "t string")
    out = [r.t for r in cols.cast_present(df, ["t"], "int").collect()]
    assert out == [2, 7, 2, -1, None, None]


def test_upper_case_variant_dedups_first(spark):  # PRJ-5, notebook order
    import datetime as dt
    from tessera.plans.silver import build_silver_upper
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(2024, 1, "sp ", " ", t1), (2024, 1, "SP", "Sé", t2)],
                               "nu_ano_avaliacao int, id_aluno long, sigla_uf string, "
                               "no_municipio string, _ingestion_timestamp timestamp_ntz")
    out = build_silver_upper(df, ("nu_ano_avaliacao", "id_aluno"), processed_at=False)
    assert out.columns == ["NU_ANO_AVALIACAO", "ID_ALUNO", "SG_UF", "NO_MUNICIPIO",
                           "_INGESTION_TIMESTAMP", "_PIPELINE_VERSION"]
    r = out.collect()
    assert len(r) == 1 and (r[0].SG_UF, r[0].NO_MUNICIPIO) == ("SP", "Sé")
