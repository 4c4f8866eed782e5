"""Trigrams of signs are counted piece by piece."""

import tracemalloc

import pytest

pytest.importorskip("tessera.llm")
import numpy as np  # noqa: E402

from tessera.llm import toxicity as tx  # noqa: E402


def test_trigrams_take_little_memory():
    table = np.arange(0x181, dtype=np.int32) % tx.SIZE
    texts = ["some words of a text. ", None, "", "x" * 7] * 60_000
    n = tx.trigrams(texts[:400], table)
    tracemalloc.start()
    whole = tx.trigrams(texts, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    signs = 2 + sum(len(t) + 2 for t in texts if t)
    assert whole.sum() == signs - 2 and n.sum() == 2 + 100 * (24 + 9) - 2
    assert peak < 6 * signs + 12_000_000              # before: more than 30 bytes a sign
