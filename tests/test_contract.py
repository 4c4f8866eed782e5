"""Driver contract: entry() smoke and every registered query against its oracle (sf0.001)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ano", "sigla_uf", "id_municipio", "nome_municipio", "total_avaliados",
                          "taxa_alfabetizacao_real", "meta_ano", "desvio_meta", "status_meta"]


def test_every_query_has_oracle_or_reason():
    # corpus queries that SQL cannot express are tested by brute force in their own folder
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    assert dict(df.dtypes) == {c: DUCK_TO_SPARK.get(str(t), str(t))
                               for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)
