"""Test-table adapter: the driver's star-schema tables in student/target shape.

The literacy files themselves are not available, so every query derives its
inputs from the shared tables with one fixed rule (SURVEY 7.4):

    student          <- lineitem row, its supplier (city) and nation (state)
    ano              <- year(l_shipdate)
    id_uf, sigla_uf  <- n_nationkey, chr(65 + n_nationkey) || chr(65 + n_regionkey)
    id_municipio     <- s_suppkey, nome_municipio <- s_name
    id_aluno         <- l_orderkey * 10 + l_linenumber (not unique: dedup load)
    in_presenca_lp   <- l_linestatus = 'F';  in_alfabetizado <- l_returnflag = 'R'
    proficiency, weight <- l_extendedprice, l_quantity
    ingestion time   <- l_shipdate

    city target      <- supplier row: meta for 1996 = 20 + key % 30,
                        meta for 1997 = NULL when key % 7 = 0 else 25 + key % 30

The supplier and nation joins carry no hint: Spark broadcasts a side only while
its measured size is under the session's thresholds. Supplier grows with the
data, so beyond them its join is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# target year -> source column in the adapter's target table
TARGET_YEARS = {1996: "meta_alfabetizacao_1996", 1997: "meta_alfabetizacao_1997"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation keys with their state codes."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"),
        F.concat(F.char(F.lit(65) + F.col("n_nationkey")),
                 F.char(F.lit(65) + F.col("n_regionkey"))).alias("sigla_uf"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities: supplier keys with name and nation."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier ⋈ nation: one row per city with its state code."""
    nation, supplier = states(spark, sf_dir), suppliers(spark, sf_dir)
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "inner")


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped student rows (one per lineitem row)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    # suppliers first: the size of their file is known, that of their join with nation is
    # taken for the product of both, and lineitem would be shuffled for it
    supplier, nation = suppliers(spark, sf_dir), states(spark, sf_dir)
    joined = li.join(supplier, li.l_suppkey == supplier.s_suppkey, "inner") \
        .join(nation, F.col("s_nationkey") == nation.n_nationkey, "inner")
    return joined.select(
        F.year("l_shipdate").alias("ano"),
        F.col("n_nationkey").alias("id_uf"),
        F.col("sigla_uf"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_aluno"),
        F.col("s_suppkey").alias("id_municipio"),
        F.col("s_name").alias("nome_municipio"),
        # flag = (code = X) as int: a presence filter on it reaches the lineitem scan
        (F.col("l_linestatus") == "F").cast("int").alias("in_presenca_lp"),
        (F.col("l_returnflag") == "R").cast("int").alias("in_alfabetizado"),
        F.col("l_extendedprice").alias("vl_proficiencia_lp"),
        F.col("l_quantity").alias("vl_peso_aluno_lp"),
        F.col("l_shipdate").alias("_ingestion_timestamp"),
    )


def raw_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped students: upper-case raw names, answer blocks, batch columns.

    Same rows as :func:`students`, named as in the raw yearly files so the
    silver rules (lower-case, rename, drop, casts) have real work to do.
    """
    s = students(spark, sf_dir)
    li = F.col("id_aluno")
    return s.select(
        F.col("ano").alias("NU_ANO_AVALIACAO"),
        F.col("id_uf").alias("CO_UF"),
        F.col("sigla_uf").alias("SG_UF"),
        F.col("id_aluno").alias("ID_ALUNO"),
        (li % 1000).cast("string").alias("ID_ESCOLA"),
        (li % 3 + 1).cast("double").alias("TP_DEPENDENCIA"),
        F.col("id_municipio").alias("CO_MUNICIPIO"),
        F.col("nome_municipio").alias("NO_MUNICIPIO"),
        F.col("in_presenca_lp").alias("IN_PRESENCA_LP"),
        F.col("in_alfabetizado").alias("IN_ALFABETIZADO"),
        F.col("vl_proficiencia_lp").alias("VL_PROFICIENCIA_LP"),
        F.col("vl_peso_aluno_lp").alias("VL_PESO_ALUNO_LP"),
        (li % 7).alias("CO_BLOCO_1"),
        F.lit("ABCD").alias("TX_RESPOSTA_BLOCO_1"),
        F.lit("ABCE").alias("TX_GABARITO_BLOCO_1"),
        F.col("_ingestion_timestamp"),
        F.date_format("_ingestion_timestamp", "yyyyMMdd").alias("anomesdia"),
    )


def city_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City target table (one row per supplier)."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.lit(1995).alias("ano"),
        k.cast("string").alias("id_municipio"),
        F.lit("publica").alias("rede"),
        (F.lit(20) + k % 30).cast("double").alias("meta_alfabetizacao_1996"),
        F.when(k % 7 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(25) + k % 30).cast("double")).alias("meta_alfabetizacao_1997"),
    )


# DuckDB text of the same adapter, used by the oracle SQL.
STUDENTS_SQL = """
students AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano,
         n.n_nationkey AS id_uf,
         chr(65 + n.n_nationkey) || chr(65 + n.n_regionkey) AS sigla_uf,
         l.l_orderkey * 10 + l.l_linenumber AS id_aluno,
         s.s_suppkey AS id_municipio,
         s.s_name AS nome_municipio,
         CAST(l.l_linestatus = 'F' AS INTEGER) AS in_presenca_lp,
         CAST(l.l_returnflag = 'R' AS INTEGER) AS in_alfabetizado,
         l.l_extendedprice AS vl_proficiencia_lp,
         l.l_quantity AS vl_peso_aluno_lp,
         l.l_shipdate AS _ingestion_timestamp
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

TARGETS_SQL = """
targets AS (
  SELECT 1995 AS ano, CAST(s_suppkey AS VARCHAR) AS id_municipio, 'publica' AS rede,
         CAST(20 + s_suppkey % 30 AS DOUBLE) AS meta_alfabetizacao_1996,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL
              ELSE CAST(25 + s_suppkey % 30 AS DOUBLE) END AS meta_alfabetizacao_1997
  FROM supplier
)"""
