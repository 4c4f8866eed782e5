"""Collocations, n-gram join and centroid clusters against brute force, with their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tessera.llm.queries")

from tessera.llm import collocations as phrases  # noqa: E402
from tessera.llm import set_join  # noqa: E402
from tessera.llm.centroids import Orchard, centroid_clusters, limbs  # noqa: E402

WORDS = "red blue green cat dog tree house river stone cloud bird fish moon star wind".split()


# --- phrase collocations -----------------------------------------------------------
def naive_collocations(data, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in data:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    often = {p: c for p, c in f.items() if c >= least}
    rows = {}
    for p, a in often.items():
        if len(p) < 3 or any(len(q) > len(p) and c >= a and q[0] == p[0]
                             and any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2))
                             for q, c in often.items()):
            continue
        cuts = [(1000 * a * n[p[0]] // (f[p[:k + 1]] * f[p[:1] + p[k + 1:]]), k, f[p[:k + 1]],
                 f[p[:1] + p[k + 1:]]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        rows.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return {(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0])
            for lang, found in rows.items() for i, r in enumerate(sorted(found)[:top])}


def phrase_rows():
    rng, data = random.Random(3), []
    for i in range(120):
        words = [rng.choice(WORDS[:7]) + rng.choice(["", "", ".", "\t", ",", "\nX"]) for _ in range(30)]
        data.append(("A House of Cards, " * (i % 3) + " ".join(words), [None, "und", "en", "fr"][i % 4]))
    data += [(None, "en"), ("", "en"), ("  \n. ", "fr"), ("a a a a a a", "en"), ("é à É", None),
             ("very " * 3000, "fr"), data[0], data[0]]
    return data


@pytest.mark.parametrize("buckets", [1, 512])
def test_collocations_match_a_naive_count(spark, monkeypatch, buckets):
    data = phrase_rows()
    monkeypatch.setattr(phrases, "LEAST_BUCKETS", buckets)
    monkeypatch.setattr(phrases, "ROW_ENTRIES", 7)
    docs = spark.createDataFrame([(t, x, 1, "k") for t, x in data],
                                 "text string, lang string, n int, key string").repartition(5)
    got = {tuple(r) for r in phrases.collocations(docs, least=9, top=40).collect()}
    assert got == naive_collocations(data, 9, top=40)
    assert {r[0] for r in got} == {"und", "en", "fr"}


def test_hot_prefixes_are_dealt_over_segments(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 16)
    monkeypatch.setattr(phrases, "HELD", 50)
    data = [(f"the {w}{i % 9} end", "en") for i in range(400) for w in ("cat", "dog")]
    docs = spark.createDataFrame(data, "text string, lang string")
    got = {tuple(r) for r in phrases.collocations(docs, least=20).collect()}
    assert got == naive_collocations(data, 20) and len(got) == 18


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    one = spark.createDataFrame([(None, None), ("one two", "en")], "text string, lang string")
    assert phrases.collocations(one).collect() == []


# --- n-gram join -------------------------------------------------------------------
def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def join_rows():
    rng, data = random.Random(11), [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"),
                                    (905, "one two"), (None, "one"), (906, "w " * 5000), (907, "w " * 4000)]
    number = iter(range(800))
    for n in (4, 9, 12, 14, 20, 22, 25, 31, 40, 80, 200):
        base = [f"b{rng.randrange(10**6)}" for _ in range(n)]
        data.append((next(number), " ".join(base)))
        for e in (0, 1, 1, 2, 3):
            text = list(base)
            for _ in range(e):
                place = rng.choice([0, len(text) - 1, rng.randrange(len(text))])
                text[place:place + 1] = rng.choice([[], [f"x{rng.randrange(10**6)}"], [text[place], "y"]])
            data.append((next(number), " ".join(text)))
    base = [f"w{i}" for i in range(120)]
    for _ in range(60):  # a crowd around one text
        data.append((next(number), " ".join(f"c{rng.randrange(10**6)}" if rng.random() < 0.02 else w
                                            for w in base)))
    # one id with two texts ties both groups together, and repeated rows
    data += [(950, data[20][1]), (950, data[40][1]), data[20], data[20]]
    return data


def naive_join(data, percent):
    sets = [shingles(t, 3) for _, t in data]
    parent = {i: i for i, _ in data}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, one in zip(data, sets, strict=True):
        for b, two in zip(data, sets, strict=True):
            both = len(one & two)
            if both and None not in (a[0], b[0]) and 100 * both >= percent * len(one | two):
                x, y = root(a[0]), root(b[0])
                parent[max(x, y)] = min(x, y)
    return sorted((-1 if i is None else i, len(s), -1 if i is None else root(i))
                  for (i, _), s in zip(data, sets, strict=True))


@pytest.mark.parametrize(("percent", "light", "crowd"), [(90, None, 24), (90, 0, 6), (90, 24, 3), (80, None, 6)])
def test_ngram_join_matches_all_pairs(spark, monkeypatch, percent, light, crowd):
    data = join_rows()
    monkeypatch.setattr(set_join, "CROWD", crowd)
    if light is not None:
        monkeypatch.setattr(set_join, "boundary", lambda sizes, percent: light)
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in data], "doc_id long, text string, node int, a int")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles,
                  -1 if r.component_id is None else r.component_id)
                 for r in set_join.ngram_join(docs, 3, percent).collect())
    assert got == naive_join(data, percent)


def test_needed_overlap_and_boundary():
    for percent in (80, 85, 90):
        for n in range(1, 60):
            for m in range(1, 60):
                o = set_join.needed(n, m, percent)
                assert 100 * o >= percent * (n + m - o) and 100 * (o - 1) < percent * (n + m - o + 1)
                assert (m in set_join.partner_sizes(n, percent)) == (o <= min(n, m))
    assert set_join.boundary([(5, 10, 1000), (20, 10, 10**9), (25, 10**6, 3)], 90) == 20
    assert set_join.boundary([], 90) == 0 and set_join.boundary([(9, 10, 0)], 90) == 0


def test_ngram_join_of_nothing(spark):
    assert set_join.ngram_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- centroid clusters -------------------------------------------------------------
def naive_clusters(data, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**40 else int(x) * 1024 for x in v]) for i, v in data
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        centroids = [[sum(v[i] for (_, v), o in zip(kept, of, strict=True) if o == j) // of.count(j)
                      for i in range(size)] if j in of else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in found)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_centroid_clusters_match_naive_rounds(spark, kind):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 64))
    data = [(i, [float(np.float32(x)) for x in centres[i % 9] + rng.normal(size=64) / 9]) for i in range(250)]
    data += [data[3], data[3], (7, data[4][1]), (None, data[5][1]), (1001, None), (1002, []),
             (1003, [0.5] * 63), (1004, [0.5] * 65), (1005, [0.5] * 63 + [None]),
             (1006, [0.5] * 63 + [float("nan")]), (1007, [float("-inf")] + [0.5] * 63),
             (1008, [0.0] * 64), (1009, [-0.0] * 64), (1010, [400000.0] + [0.0] * 63)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in data],
                                  f"vec_id long, embedding array<{kind}>, cluster int, id int").repartition(3)
    got = centroid_clusters(table)
    assert Counter(tuple(r) for r in got.collect()) == naive_clusters(data)
    assert dict(got.dtypes)["distance"] == "bigint"


def test_distances_beyond_64_bits_are_null(spark):
    data = [(1, [3e38] * 2), (2, [1.0, 2.0]), (3, [1.0, 2.5])]
    rows = centroid_clusters(spark.createDataFrame(data, "vec_id long, embedding array<float>"),
                             k=1, size=2).collect()
    assert len(rows) == 3 and {r.cluster for r in rows} == {0}
    assert all(r.distance is None and r.inertia is None for r in rows)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroid_clusters(spark.createDataFrame([], schema)).collect() == []
    two = [(1, [0.25] * 64), (2, [0.75] * 64)]
    rows = centroid_clusters(spark.createDataFrame(two, schema)).collect()
    assert Counter(map(tuple, rows)) == naive_clusters(two)


def test_orchard_finds_the_smallest_number_among_ties():
    rng = np.random.default_rng(6)
    for k in (1, 2, 5, 12):
        centroids = rng.integers(-3, 4, (k, 3)).tolist()
        rows = rng.integers(-4, 5, (400, 3))
        for start in range(k):
            best, far = Orchard(centroids).nearest(rows, start)
            for row, b, d in zip(rows.tolist(), best, far, strict=True):
                every = [sum((x - y) ** 2 for x, y in zip(row, c, strict=True)) for c in centroids]
                assert (d, b) == (min(every), every.index(min(every)))


def test_limbs_hold_any_integer():
    for x in (0, 1, -1, 2**32, -2**32, 2**31, 10**40, -10**40, -5, 2**64 - 1):
        assert sum(d << (32 * p) for p, d in limbs(x)) == x


def test_rows_of_many_ids_are_found_without_a_shuffle(spark):
    from tessera.llm.common import rows_of, stored

    rows = spark.createDataFrame([(i if i % 10 else None, f"text {i}") for i in range(300)]
                                 + [(7, "again"), (-5, "below"), (900, None)], "doc_id long, text string")
    ids = stored(spark.createDataFrame([(i,) for i in (900, 7, 12, 20, 77, 5000)], "doc_id long"), "ids")
    expected = [(7, "again"), (7, "text 7"), (12, "text 12"), (77, "text 77"), (900, None)]
    for limits in ((0, 100), (100, 1000), (0, 0)):      # a list, a broadcast join, a join
        found = rows_of(rows, ids, *limits)
        assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)
    listed = rows_of(rows, ids, 0, 100)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
