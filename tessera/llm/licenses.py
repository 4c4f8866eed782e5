"""License scans with a generalised suffix automaton of licence words.

The automaton holds every stretch of words of all templates. Streaming a
file's words through it gives, at each word, the longest stretch ending there
that stands in some template (matching statistics). Long stretches are chained
into spans that cover a template; a template counts as found if enough of it
is covered in order.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import _cut, small_batches
from tessera.llm.shingles import text_bytes, word_hashes

# Phrases whose every place counts, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public licence names and notices, by label.
TEMPLATES = {
    "agpl-3": ("gnu affero general public license version 3",),
    "apache-2": (
        "licensed under the apache license version 2.0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied",
    ),
    "bsd-3": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission",
    ),
    "cc-by": ("creative commons attribution 4.0 international license",),
    "cc-by-nc": ("creative commons attribution noncommercial 4.0 international license",),
    "cc-by-sa": ("creative commons attribution sharealike 4.0 international license",),
    "cc0": ("cc0 1.0 universal public domain dedication",),
    "gpl-2": ("gnu general public license version 2",),
    "gpl-3": (
        "gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    "lgpl-3": ("gnu lesser general public license version 3",),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software",
    ),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2.0",
              "mozilla public license version 2.0"),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
SCANS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
         "base_labels string, labels string, score double, spans string")


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class SuffixAutomaton:
    """All stretches of some word sequences, with where they end in each sequence."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (sequence, place of an end in it)

    def _state(self, length: int, copy_of: int | None = None) -> int:
        self.next.append({} if copy_of is None else dict(self.next[copy_of]))
        self.link.append(0 if copy_of is None else self.link[copy_of])
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, q)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, sequence: list[int], name: int) -> int:
        """Adds a sequence and returns the state of all of it."""
        last = 0
        for place, c in enumerate(sequence):
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
            else:
                new, p = self._state(self.length[last] + 1), last
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][c]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 \
                        else self._clone(p, c, q)
                last = new
            self.ends[last].add((name, place + 1))
        return last

    def finish(self) -> None:
        """Hands the ends of longer stretches down to their suffixes."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[s]] |= self.ends[s]


def without_worse(chains: list[tuple[int, int, float, str]]) -> list[tuple[int, int, float, str]]:
    """Leaves out chains inside a better covered one: its words are the other template's.

    ("version 3" of a licence is not four fifths of its "version 2".) A template that
    is there as a whole stays, wherever it lies.
    """
    out, open_now = [], []
    for chain in sorted(chains, key=lambda c: (c[0], -c[1], -c[2])):
        open_now = [c for c in open_now if c[1] > chain[0]]  # at most a few a template
        if not any(c[1] >= chain[1] and c[2] > chain[2] for c in open_now):
            out.append(chain)
        open_now.append(chain)
    return out


class LicenseScanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, tuple[str, ...]],
                 least_match: int, least_cover: float, widest_gap: int) -> None:
        self.least_match, self.least_cover, self.widest_gap = least_match, least_cover, widest_gap
        self.labels, sequences = [], []
        for label, texts in [*((v, (k,)) for k, v in phrases.items()), *templates.items()]:
            for text in texts:
                self.labels.append(label)
                sequences.append(words_of(text))
        self.n_base = len(phrases)
        self.sizes = [len(s) for s in sequences]
        self.shortest = min([least_match, *self.sizes[:self.n_base]])  # runs below hold nothing
        vocabulary = sorted({w for s in sequences for w in s})
        raw = np.frombuffer(b" ".join(vocabulary), np.uint8)
        hashes, _ = word_hashes(raw, np.array([0, len(raw)]), NOT_WORD)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.automaton = SuffixAutomaton()
        own = [self.automaton.add([ids[w] for w in s], i) for i, s in enumerate(sequences)]
        self.automaton.finish()
        # by state: all places in templates that end there, of its suffixes too: (sequence, place, next word, length or 0 for the whole)
        follow = [[*(ids[w] for w in s), -1] for s in sequences]
        self.held: list[list[tuple[int, int, int, int]]] = [[] for _ in self.automaton.next]
        for s in range(1, len(self.held)):
            met: set[tuple[int, int]] = set()
            at = s
            while at > 0 and self.automaton.length[at] >= least_match:
                for name, place in sorted(self.automaton.ends[at] - met):
                    self.held[s].append((name, place, follow[name][place],
                                         0 if at == s else self.automaton.length[at]))
                met |= self.automaton.ends[at]
                at = self.automaton.link[at]
        # the base phrases that end wherever a state's longest stretch ends
        phrase_at: dict[int, list[int]] = {}
        for i in range(self.n_base):
            phrase_at.setdefault(own[i], []).append(i)
        self.phrases: list[tuple[int, ...]] = [()] * len(self.automaton.next)
        for s in sorted(range(1, len(self.phrases)), key=self.automaton.length.__getitem__):
            up = self.phrases[self.automaton.link[s]]
            self.phrases[s] = up + tuple(phrase_at.get(s, ()))

    def known(self, words: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word hash, 0 if it is in no template."""
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.order[at] + 1, 0)

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], dict[int, list]]:
        """Base places (phrase, start) and, by template, maximal matches (start, end, place).

        A match is maximal for a place of a template if neither the word before nor
        the word after is the template's too, whatever other templates hold there.
        """
        base, matches = [], {}
        step, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        known = ids > 0
        edges = np.flatnonzero(np.diff(np.r_[False, known, False]))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if hi - lo < self.shortest:
                continue
            state = size = 0
            run = ids[lo:hi].tolist()
            for j, c in enumerate([*run, 0]):
                if size >= self.least_match:
                    for name, place, following, own in self.held[state]:
                        if following != c:  # cannot be made longer there
                            matches.setdefault(name, []).append(
                                (lo + j - (own or size), lo + j, place))
                after = step[state].get(c)
                if after is None:
                    while state and after is None:
                        state = link[state]
                        size = length[state]
                        after = step[state].get(c)
                if after is None:
                    state = size = 0
                else:
                    state, size = after, size + 1
                    for i in self.phrases[state]:
                        if size >= self.sizes[i]:
                            base.append((i, lo + j + 1 - self.sizes[i]))
        return base, matches

    def chains(self, name: int, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
        """(start, end, covered share) of spans that cover enough of a template in order.

        The best chain that ends with each match, by words that are the span's and the
        template's and are counted once in either; of chains that overlap, the one
        with the best cover stays (then the shortest, then the first).
        """
        size, found = self.sizes[name], []
        matches = sorted(set(matches), key=lambda m: (m[1], m[2]))
        best: list[tuple[int, int]] = []  # words covered, start of the chain
        for i, (start, end, place) in enumerate(matches):
            top = (end - start, start)
            for j in range(i - 1, -1, -1):
                _, upto, before = matches[j]
                if start - upto > self.widest_gap:
                    break  # those before end earlier still
                if before < place and upto < end:
                    more = min(place - before, end - upto, end - start)
                    top = max(top, (best[j][0] + more, best[j][1]))
            best.append(top)
            if top[0] >= self.least_cover * size:
                found.append((-top[0], end - top[1], top[1], end))
        out: list[tuple[int, int, float]] = []
        for covered, _, start, end in sorted(found):
            at = bisect.bisect_left(out, (end,))
            if at == 0 or out[at - 1][1] <= start:
                out.insert(at, (start, end, min(-covered / size, 1.0)))
        return out

    def row(self, ids: np.ndarray) -> tuple:
        base, matches = self.scan(ids)
        starts = [s for _, s in base]
        base_labels = {self.labels[i] for i, _ in base}
        labels, best, spans = set(base_labels), 1.0 if base else 0.0, []
        chains = [(start, end, cover, self.labels[name]) for name, found in matches.items()
                  for start, end, cover in self.chains(name, found)]
        for start, end, cover, label in without_worse(chains):
            labels.add(label)
            best = max(best, cover)
            spans.append((start, end, label))
        join = ",".join
        return (len(base), min(starts, default=None), max(starts, default=None),
                join(sorted(base_labels)), join(sorted(labels)), best,
                join(f"{label}:{a}:{b}" for a, b, label in sorted(set(spans))))


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None,
                 templates: dict[str, tuple[str, ...]] | None = None, least_match: int = 4,
                 least_cover: float = 0.8, widest_gap: int = 6, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Licence phrases and covered template spans of every row of ``docs``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` describe the
    phrases (every place); ``labels`` adds templates of which ``least_cover``
    is covered by matches of ``least_match`` words or more, in order and at
    most ``widest_gap`` words apart, and which lie in no better covered template's
    span; ``score`` is the largest covered share and
    ``spans`` lists label:start:end in words.

    Defined cases: null and empty texts have no word and score 0; null ids and
    repeated rows are scanned like any other; an empty table gives an empty
    result; other columns are not read. Words outside all templates end every
    match, so only runs of template words are streamed, of any length.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    schema = to_arrow_schema(StructType.fromDDL(SCANS))
    small_batches(docs.sparkSession)

    def run(batches):
        scanner = LicenseScanner(phrases, templates, least_match, least_cover, widest_gap)
        empty = (0, None, None, "", "", 0.0, "")
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                words, at = word_hashes(*text_bytes(part.column(1)), NOT_WORD)
                ids = scanner.known(words)
                some = np.r_[0, np.cumsum(ids > 0)][at]
                rows = [scanner.row(ids[at[i]:at[i + 1]]) if some[i + 1] - some[i] >= scanner.shortest else empty
                        for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(at))]
                    + [pa.array(list(c), f.type) for c, f in
                       zip(zip(*rows, strict=True), list(schema)[2:], strict=True)]
                    if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCANS)
