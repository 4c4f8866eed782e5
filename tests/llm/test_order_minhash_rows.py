"""Order MinHash over tables where one id or one row is a third of all rows."""

import hashlib
import itertools

import numpy as np
import pytest

pytest.importorskip("tessera.llm")
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import order_minhash as omh  # noqa: E402


def keyed(docs):
    return omh.ranked(docs).select(*omh.ORDER)


@pytest.mark.parametrize("shape", ["one id", "wide ids", "no id", "one row"])
def test_ranges_stay_small_when_a_third_of_all_rows_share_an_id(spark, shape):
    key = {"no id": F.lit(None).cast("long"), "wide ids": F.lit(2**61 + 70)}.get(
        shape, F.lit(70).cast("long"))
    base = 2**61 if shape == "wide ids" else 0
    text = F.lit("same text") if shape == "one row" else F.concat(F.lit("t"), "id")
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, key).otherwise(F.col("id") + F.lit(base)).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, text).otherwise(F.concat(F.lit("u"), "id")).alias("text"))
    rows = [tuple(r) for r in keyed(docs).collect()]
    cuts = omh.range_cuts(keyed(docs), 30)
    parts = omh.cuts_below(cuts, [np.array([r[i] for r in rows], np.int64) for i in range(4)])
    assert max(np.bincount(parts)) <= 220 and len(cuts[0]) < 90
    ordered = [p for _, p in sorted(zip(rows, parts.tolist(), strict=True))]
    assert ordered == sorted(ordered)


def test_cuts_below_counts_like_a_loop():
    rng = np.random.default_rng(2)
    cuts = sorted({tuple(map(int, rng.integers(0, 4, 3))) for _ in range(25)})
    keys = [tuple(map(int, rng.integers(-1, 5, 3))) for _ in range(200)]
    got = omh.cuts_below([np.array(c) for c in zip(*cuts, strict=True)],
                         [np.array(c) for c in zip(*keys, strict=True)])
    assert got.tolist() == [sum(c <= k for c in cuts) for k in keys]


def slow_signature(text, make):
    """Tuples of the least numbered k-mers in text order, function by function."""
    if not text:
        return None
    n = max(len(text) - make.k + 1, 1)
    kmers = make.kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    pieces = [text[i:i + make.k] for i in range(n)]
    seen, nth = {}, []
    for p in pieces:
        nth.append(seen.get(p, 0))
        seen[p] = nth[-1] + 1
    values = make.numbered(kmers)
    # one value for each (k-mer, occurrence number)
    assert len(set(values.tolist())) == len(set(zip(pieces, nth, strict=True)))
    out = []
    for f in range(make.m):
        x = (values ^ make.flip[f]) * make.times[f]
        x ^= x >> np.uint32(15)
        x = (x * np.uint32(0x2C1B3C6D)).tolist()
        least = sorted(range(n), key=lambda i: (x[i], i))[:make.l]
        out.append(tuple(pieces[i] for i in sorted(least)))
    return out


def test_whole_results_against_a_plain_loop(spark):
    words = "red blue green cat dog tree house river stone cloud bird fish moon".split()
    texts = [" ".join(words[(i * j) % 13] for j in range(1, 3 + i % 9)) for i in range(1, 25)]
    data = list(enumerate([*texts, "", "ab", texts[3]]))
    docs = spark.createDataFrame([(i, t or None) for i, t in data], "doc_id long, text string")
    got = {r["doc_id"]: r for r in omh.fingerprints(docs).collect()}
    make = omh.OrderMinHash()
    for (i, text), (_, after) in zip(data, data[1:] + data[:1], strict=True):
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (
            len(text), hashlib.sha256(changed.encode()).hexdigest())
        own, edit, follow = (slow_signature(t, make) for t in (text, changed, after))
        for column, other in (("near_edited", edit), ("near_next", follow)):
            same = (float(own is other) if own is None or other is None
                    else sum(a == b for a, b in zip(own, other, strict=True)) / make.m)
            assert r[column] == pytest.approx(same, abs=1e-9), (i, column)
    prints = [r["fingerprint"] for r in got.values()]
    assert got[26]["fingerprint"] == got[3]["fingerprint"]
    assert all((got[a]["fingerprint"] == got[b]["fingerprint"]) == (data[a][1] == data[b][1])
               for a, b in itertools.combinations(range(len(data)), 2)) or len(set(prints)) < len(data)


def test_copies_of_one_row_keep_their_followers(spark):
    data = [(5, "the same text of a copied row")] * 40 + [(i, f"text number {i} here") for i in range(20)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for ranges in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            seen.append(sorted(map(str, omh.fingerprints(docs).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    assert seen[0] == seen[1] and len(seen[0]) == 60
