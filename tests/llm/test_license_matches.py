"""Matching statistics against a plain search, and covers of templates that share clauses."""

import random

import numpy as np
import pytest

pytest.importorskip("tessera.llm")
from tessera.llm.licenses import LicenseScanner  # noqa: E402


def ids_of(scanner: LicenseScanner, templates: list[str], text: str) -> np.ndarray:
    vocabulary = sorted({w for t in templates for w in t.encode().split()})
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    return np.array([number.get(w, 0) for w in text.encode().split()])


def plain(sequences: list[list[str]], words: list[str], least: int) -> dict:
    out = {}
    for name, own in enumerate(sequences):
        for end in range(1, len(words) + 1):
            for place in range(1, len(own) + 1):
                size = 0
                while size < min(end, place) and words[end - 1 - size] == own[place - 1 - size]:
                    size += 1
                goes_on = end < len(words) and place < len(own) and words[end] == own[place]
                if size >= least and not goes_on:
                    out.setdefault(name, []).append((end - size, end, place))
    return {k: sorted(v) for k, v in out.items()}


def test_matches_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        templates = [" ".join(rng.choices("abc", k=rng.randint(2, 9))) for _ in range(4)]
        text = " ".join(rng.choices("abcx", (4, 4, 4, 1), k=rng.randint(0, 40)))
        scanner = LicenseScanner({}, {f"t{i}": (t,) for i, t in enumerate(templates)}, 2, 0.8, 3)
        _, matches = scanner.scan(ids_of(scanner, templates, text))
        found = {k: sorted(set(v)) for k, v in matches.items()}
        assert all(len(v) == len(set(v)) for v in matches.values())
        assert found == plain([t.split() for t in templates], text.split(), 2)


def test_a_template_inside_another_is_found():
    templates = {"a": ("w1 w2 w3 w4 w5 w6 w7 w8",), "b": ("w3 w4 w5 w6",)}
    scanner = LicenseScanner({}, templates, 4, 0.8, 6)
    row = scanner.row(ids_of(scanner, [t for v in templates.values() for t in v],
                             "x w1 w2 w3 w4 w5 w6 w7 w8 x"))
    assert row[4] == "a,b" and row[6] == "a:1:9,b:3:7"


def test_a_clause_twice_in_a_template_is_covered_in_order():
    template = "p q r s e f g h p q r s"
    scanner = LicenseScanner({}, {"t": (template,)}, 4, 0.6, 6)
    ids = ids_of(scanner, [template], "p q r s x x p q r s")
    assert scanner.row(ids)[4] == "t"  # 8 of 12 words, the clause at both its places
    whole = scanner.row(ids_of(scanner, [template], template + " x x x x x x x " + template))
    assert whole[6] == "t:0:12,t:19:31" and whole[5] == 1.0


def test_repeats_are_not_counted_twice():
    template = "a b c d e f g h i j"
    scanner = LicenseScanner({}, {"t": (template,)}, 4, 0.8, 6)
    assert scanner.row(ids_of(scanner, [template], "a b c d x a b c d x a b c d"))[4] == ""
