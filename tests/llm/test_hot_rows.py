"""Copies of one row, or one id, that make up a third of a table."""

import random

import pytest

pytest.importorskip("tessera.llm")
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import line_dedup as ld  # noqa: E402
from tessera.llm import near_duplicates as nd  # noqa: E402
from tessera.llm.common import BUCKETS, ordered_buckets, stored  # noqa: E402
from tessera.llm.packing import pack  # noqa: E402
from tessera.llm.sharding import interleaved_shards  # noqa: E402


def test_copies_are_dealt_over_buckets(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
                                    .alias("x"), F.col("id").alias("row"))
    rows = stored(rows.withColumn("h", F.xxhash64("x")), "hot")
    found = ordered_buckets(rows, "h", "row", 3000)
    sizes = [r["count"] for r in found.groupBy(*BUCKETS).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 200
    # the buckets ascend with the hash
    spans = [(tuple(r[b] for b in BUCKETS), r["lo"], r["hi"]) for r in found.groupBy(*BUCKETS).agg(
        F.min("h").alias("lo"), F.max("h").alias("hi")).collect()]
    spans.sort()
    assert all(a[2] <= b[1] for a, b in zip(spans[:-1], spans[1:], strict=True))


def test_shards_with_a_third_equal_rows_and_many_small_sources(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("even"))
        .otherwise(F.concat(F.lit("s"), "id")).alias("source"))
    rows = interleaved_shards(docs, 8).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    assert sorted(len(s) for s in shards.values()) == [375] * 8
    assert all(sorted(r["slot"] for r in s) == list(range(375)) for s in shards.values())
    # every shard holds the hot source's share, an eighth of its rows or so
    assert all(abs(sum(r["doc_id"] == 7 for r in s) - 125) <= 8 for s in shards.values())


def test_packing_with_a_third_equal_pieces(spark):
    pieces = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0L, id) AS doc_id", "0 AS piece", "0L AS start",
        "if(id % 3 = 0, 20L, 1 + id % 50) AS length", "if(id % 3 = 0, 0L, id) AS ids_crc32")
    rows = pack(pieces, 64).collect()
    assert len(rows) == 3000
    taken = {}
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64


def test_one_set_for_rows_that_share_an_id(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    one, two = " ".join(words), " ".join([*words[:-1], "other"])
    docs = spark.createDataFrame([(i % 2, one if i % 2 else two) for i in range(80)],
                                 "doc_id long, text string")
    seen = {}
    verify = nd.verified_pairs

    def counted(pairs, sets, percent):
        seen["sets"] = sets.count()
        return verify(pairs, sets, percent)

    monkeypatch.setattr(nd, "verified_pairs", counted)
    rows = nd.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == 80 and {r["component_id"] for r in rows} == {0}
    assert seen["sets"] == 2


def test_a_crowd_of_long_lines_is_not_paired_out(spark, monkeypatch):
    rng, lines = random.Random(3), []
    for i in range(300):
        line = [f"w{j}" for j in range(40)]
        places = rng.sample(range(40), 3)
        if i % 8 == 7:                                # near an earlier one that is not an early one
            line, places = list(lines[rng.randrange(i // 2, i)]), places[:2]
        if i % 60 == 9:                               # the first words in another order
            line = line[5:] + line[:5]
        for j in places:                              # others are six edits apart, the bound is four
            line[j] = f"x{rng.randrange(900)}"
        lines.append(line)
    sizes, write = {}, ld.stored

    def counted(df, name):
        out = write(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(ld, "stored", counted)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    gone = {r.doc_id for r in ld.dedup_lines(docs).collect() if not r.text}
    assert gone == {i for i, x in enumerate(lines) if any(
        x == y or ld.word_distance_within(x, y, ld.edits(40)) for y in lines[:i])}
    assert len(gone) > 25 and sizes["second_near"] and sizes["second_pairs"] < 300 * 299 // 2 // 10
