"""Marks of long lines and the groups they make."""

import random
import time

import pytest

pytest.importorskip("tessera.llm")
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402

from tessera.llm import line_dedup as ld  # noqa: E402


def edited(rng, line, k):
    line = list(line)
    for _ in range(k):
        place = rng.randrange(len(line))
        line[place:place + 1] = rng.choice(([f"y{rng.randrange(9)}"], [], [line[place], f"y{rng.randrange(9)}"]))
    return line


def marks_of(lines, levels):
    x = ld.LineWords(pa.array([" ".join(line) for line in lines]))
    line, mark = x.marks(np.arange(len(lines)), levels)
    return [set(mark[line == i].tolist()) for i in range(len(lines))]


def test_near_long_lines_share_marks_and_have_few():
    rng = random.Random(5)
    levels = np.random.default_rng(5).integers(0, 30, ld.CELLS).astype(np.uint8)
    few = most = 0
    for words in (4, 30, 5000):                       # few words: most pairs stand there again and again
        for n in (20, 29, 60, 118, 300):
            base = [f"w{rng.randrange(words)}" for _ in range(n)]
            lines = [base, *(edited(rng, base, n // ld.PER_EDIT) for _ in range(40))]
            lines = [x for x in lines if ld.word_distance_within(base, x, ld.edits(max(n, len(x))))]
            own = marks_of(lines, levels)
            assert all(len(own[0] & other) >= ld.SHARED for other in own[1:])
            few += len(own[0])
            most += 2 * (n // (ld.PER_EDIT - 1)) + ld.SHARED
    assert few < 0.9 * most                           # an edit breaks one of two pairs that stand apart


def test_meetings_are_those_of_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(ld, "MARKS_AT_ONCE", 7)
    rng = random.Random(6)
    groups = {mark: rng.sample(range(-500, 500), size) for mark, size in
              enumerate([1, 2, 3, 16, 17, 40, 1, 16, 2, 18, 90, 1] * 3)}
    rows = [(mark, ref) for mark, refs in groups.items() for ref in refs for _ in range(rng.choice((1, 1, 3)))]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = [tuple(r) for r in ld.meetings(spark.createDataFrame(rows, ld.MARKS)).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    expected = []
    for mark, refs in groups.items():
        if len(refs) > ld.FEW:
            expected += [(mark, ref, None) for ref in refs]
        else:
            expected += [(None, a, b) for a in refs for b in refs if a < b]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_words_within_is_the_plain_distance():
    rng = random.Random(7)
    for _ in range(600):
        one = [rng.randrange(12) for _ in range(rng.randrange(18, 50))]
        two = edited(rng, one, rng.randrange(9))
        two = [x if isinstance(x, int) else 100 + int(x[1:]) for x in two]
        if rng.random() < 0.2:
            two = two[7:] + two[:7]
        args = np.array(one, np.uint64), np.array(two, np.uint64)
        for most in (1, 3, 6):
            assert ld.words_within(*args, most) == ld.word_distance_within(one, two, most)


def test_forms_deny_no_near_lines_and_most_others():
    rng = random.Random(8)
    denied = others = 0
    for words in (4, 30, 5000):
        for n in (18, 20, 29, 60, 118, 300, 5000):
            base = [f"w{rng.randrange(words)}" for _ in range(n)]
            near = [edited(rng, base, max(1, n // ld.PER_EDIT)) for _ in range(40)]
            near = [x for x in near if len(x) >= ld.LEAST_LONG and abs(len(x) - n) <= ld.edits(max(n, len(x)))]
            far = [[f"w{rng.randrange(words)}" for _ in range(n)] for _ in range(40)] if words > 4 and n < 300 else []
            x = ld.LineWords(pa.array([" ".join(line) for line in (base, *near, *far)]))
            form = x.forms(np.arange(1 + len(near) + len(far)))
            ok = ld.alike(form[0], form)
            assert ok[:1 + len(near)].all()
            denied += (~ok[1 + len(near):]).sum()
            others += len(far)
            if n >= 300:                               # nor do wide ones, which also deny long lines
                wide = x.wide_forms(np.arange(1 + len(near)))
                assert all(ld.wide_alike(wide[0], other) for other in wide[1:])
    assert denied > 0.98 * others


def test_wide_forms_deny_long_lines():
    rng = random.Random(10)
    for n in (300, 900, 5000):
        lines = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(n, n + n // 12)))
                 for _ in range(30)]
        wide = ld.LineWords(pa.array(lines)).wide_forms(np.arange(30))
        assert not any(ld.wide_alike(wide[i], wide[j]) for j in range(30) for i in range(j))
    assert ld.LineWords(pa.array(["a " * 199, "a " * 200])).wide_forms(np.arange(2))[0] is None


def test_lines_that_share_a_mark_by_chance_make_no_pairs_and_no_crowd(spark):
    rng = random.Random(9)
    texts = [[f"w{rng.randrange(5000)}" for _ in range(30)] for _ in range(60)]
    alike = [[*texts[0][:-1], f"x{i}"] for i in range(20)] + [[*texts[1][:-1], "x"]]
    x = ld.LineWords(pa.array([" ".join(line) for line in texts + alike]))
    form = x.forms(np.arange(len(texts + alike))).view(np.int64).tolist()
    rows = [(mark, ref, form[ref], None) for mark in (5, 6) for ref in range(len(form))]
    got = [tuple(r) for r in ld.meetings(spark.createDataFrame(rows, ld.FORMED)).collect()]
    crowds = {}
    for mark, ref, other in got:
        if other is None:
            crowds.setdefault(mark, set()).add(ref)
    assert set(crowds) == {5, 6}                       # the clusters of each group's first line
    assert all(own == {0, *range(60, 80)} for own in crowds.values())
    pairs = [r for r in got if r[0] is None]
    assert pairs.count((None, 1, 80)) == 2 and len(pairs) < 0.01 * 60 * 59


def test_shuffles_of_a_stored_result_are_removed(spark):
    from tessera.llm import common

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in blocks.getAllFiles().mkString(",").split(",") if "/shuffle_" in x}

    table = spark.range(500)
    df = table.repartition(3, "id").groupBy((table.id % 7).alias("k")).count()
    before, seen = shuffles(), spark.conf.get(common.SHUFFLE_CLEANUP)
    assert df.filter("count > 71").count() == 3
    assert shuffles() - before                          # as other jobs leave them
    before = shuffles()
    counted = common.stored(df, "counted")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == seen
    assert counted.count() == df.count() == 7           # the plan itself can run again
