"""The lattice of spaced-out and masked words, against the enumeration of all readings."""

import itertools
import random

import pytest

pytest.importorskip("tessera.llm")
from tessera.llm.toxicity import (  # noqa: E402
    EDGE, INDEX, OTHER, SIZE, SPACED, Characters, fit, toxicity)

TOLD = ["idiot", "stupid", "trash", "loser", "hello", "house", "what", "a", "you", "he", "is",
        "ass", "stu", "good", "book", "small"]


@pytest.fixture(scope="module")
def model():
    counts = {}
    for word in TOLD * 50:
        codes = [EDGE, EDGE, *(INDEX[c] for c in word), EDGE]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            code = (a * SIZE + b) * SIZE + c
            counts[code] = counts.get(code, 0) + 1
    return Characters(counts)


def likelihood(model, reading):
    """The logarithm of a reading's letters, word by word."""
    total = 0.0
    for word in reading.split(" "):
        a = b = EDGE
        for c in word:
            z = INDEX.get(c, OTHER)
            total += float(model.log[a, b, z])
            a, b = b, z
        if word:
            total += float(model.log[a, b, EDGE])
    return total


def best_of_all(model, lattice):
    return max(likelihood(model, "".join(x for x, _ in chosen)) - sum(c for _, c in chosen)
               for chosen in itertools.product(*lattice))


@pytest.mark.parametrize(("written", "meant"), [
    ("what a l o s e r", "loser"), ("y o u i d i o t", "idiot"), ("l 0 $ e r", "loser"),
    ("s-t-u", "stu"), ("!diot", "idiot"), ("a$$", "ass"), ("1.d.1.o.t", "idiot"),
    ("i_d_i_o_t", "idiot"), ("y o u   l o s e r", "loser"), ("id*ot", "idiot"),
    ("st*pid!!", "stupid"), ("loser!", "loser"), ("*loser*", "loser"), ("gooood", "good"),
    ("losser", "loser"), ("book", "book"), ("small", "small")])
def test_written_forms_decode(model, written, meant):
    assert meant in [model.restore(w) for w in model.words(written)]


def test_words_that_stand_apart_stay_parted(model):
    assert model.words("y o u i d i o t") == ["you", "idiot"]
    assert model.words("what a l o s e r he is")[-3:] == ["loser", "he", "is"]
    # numbers and lists of figures are no letters
    assert model.words("1 2 3 4 5") == ["1", "2", "3", "4", "5"]


def test_viterbi_finds_the_best_of_all_readings(model):
    rng = random.Random(4)
    for _ in range(150):
        word = "".join(rng.choice("idotlser01$!*a@3") for _ in range(rng.randint(1, 7)))
        lattice = model.lattice(word)
        got, best = model.best(lattice), best_of_all(model, lattice)
        costs = [sum(c for _, c in ch) for ch in itertools.product(*lattice)
                 if "".join(x for x, _ in ch) == got]
        assert likelihood(model, got) - min(costs) == pytest.approx(best, abs=1e-3)
    for _ in range(60):
        run = rng.choice("ilyo") + "".join(
            rng.choice([" ", ".", "  "]) + rng.choice("idotls0$e") for _ in range(rng.randint(2, 5)))
        assert SPACED.fullmatch(run)
        lattice = model.spaced_lattice(run)
        got, best = model.best(lattice), best_of_all(model, lattice)
        found = [likelihood(model, got) - sum(c for _, c in ch) for ch in itertools.product(*lattice)
                 if "".join(x for x, _ in ch) == got]
        assert max(found) == pytest.approx(best, abs=1e-3)


def test_a_very_long_run_takes_time_in_proportion(model):
    run = " ".join("loser" * 20_000)
    assert len(model.words(run)) >= 1


def test_an_id_on_many_rows_gives_one_text_and_small_samples_learn(spark):
    texts = [(i, "you vilething there" if i % 2 else "a quiet clean line") for i in range(60)]
    docs = spark.createDataFrame(texts + [(7, "you vilething there")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert fit(docs, labels).weights == fit(docs.distinct(), labels).weights != {}
    found = {r["doc_id"]: r["predicted"] for r in toxicity(docs, labels).collect()}
    assert all(found[i] == i % 2 for i in range(60))
