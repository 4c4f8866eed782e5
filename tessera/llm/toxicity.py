"""Toxicity of documents: noisy-channel deobfuscation, then a score of the restored text.

1. A character trigram model is counted over the whole corpus.
2. Obfuscated words (leetspeak, symbols inside or around, letters repeated or
   spaced out) are decoded: every written character allows some intended ones,
   a gap between single signs joins them or parts two words, and Viterbi finds
   the likeliest reading under the trigram model. Words of plain letters
   without a doubled one allow one reading only, so they need no search.
3. Word beginnings and whole words get weights from labelled documents; a
   document is scored from the weighted words of its restored text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, by_value, release, stored

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"
EDGE, OTHER, SIZE = 0, len(LETTERS) + 1, len(LETTERS) + 2
INDEX = {c: i + 1 for i, c in enumerate(LETTERS)}

# What a written sign may stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
              "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou"}
WORD = re.compile(r"[@$!|+*]{0,2}[^\W_]+(?:[@$!|+*]{1,3}[^\W_]+)*[@$!|+*]{0,3}")
SIGN = r"(?:[^\W_]|[@$!|+])"
SPACED = re.compile(rf"(?<![\w@$!|+]){SIGN}(?:[ .\-_*/]{{1,3}}{SIGN}(?![^\W_]|[@$!|+])){{2,}}")
SPACED_PARTS = re.compile(rf"({SIGN})([ .\-_*/]*)")
DOUBLED = re.compile(r"(.)\1")
#: Costs of a reading, in natural logarithms like the trigram model's.
COST_SIGN, COST_DROP, COST_AS_IS = 1.5, 4.0, 3.0
COST_REPEAT, COST_DOUBLE, COST_WIDE = 1.0, 2.0, 2.0
#: Marks that also stand around words as plain punctuation: left out at no cost there.
AROUND = {"!": (COST_DROP, 0.0), "*": (0.5, 0.5), "+": (0.0, 0.0), "|": (0.0, 0.0)}
Options = list[tuple[str, float]]

#: Bounds of the labelled sample that the weights are fitted on (rows a label).
SAMPLE_ROWS = 4_000
#: Signs whose trigrams are counted at once.
PIECE = 100_000


class Characters:
    """Character trigram model with add-one counts, interpolated with bigrams."""

    def __init__(self, counts: dict[int, int]) -> None:
        three = np.zeros(SIZE**3)
        for code, n in counts.items():
            three[code] = n
        three = three.reshape(SIZE, SIZE, SIZE)
        two = three.sum(0)
        p3 = (three + 0.1) / (three.sum(2, keepdims=True) + 0.1 * SIZE)
        p2 = (two + 0.1) / (two.sum(1, keepdims=True) + 0.1 * SIZE)
        self.log = np.log(0.8 * p3 + 0.2 * p2[None]).astype(np.float32)
        # the same numbers for one look at a time: [before * SIZE + letter], before = two letters
        self.after: list[float] = self.log.ravel().tolist()

    def restore(self, written: str) -> str:
        """The likeliest letters behind ``written`` (Viterbi over its lattice)."""
        return self.best(self.lattice(written))

    @staticmethod
    def lattice(written: str) -> list[Options]:
        """What each run of one sign may stand for: letters and their cost."""
        out: list[Options] = []
        i = 0
        while i < len(written):
            c, j = written[i], i + 1
            while j < len(written) and written[j] == c:
                j += 1
            if c in STANDS_FOR:
                options = [(x, COST_SIGN) for x in STANDS_FOR[c]]
                if c.isdigit():
                    options.append((c, COST_AS_IS))
                elif i == 0 or j == len(written):
                    options.append(("", AROUND.get(c, (COST_DROP, COST_DROP))[i > 0]))
                else:
                    options.append(("", COST_DROP))
                out += [options] * (j - i)
            elif j - i >= 3:
                out.append([(c, COST_REPEAT), (c * 2, COST_REPEAT), (c * (j - i), 0.0)])
            elif j - i == 2:
                out.append([(c, COST_DOUBLE), (c * 2, 0.0)])
            else:
                out.append([(c, 0.0)])
            i = j
        return out

    @staticmethod
    def spaced_lattice(run: str) -> list[Options]:
        """The lattice of signs that stand apart: every gap joins its signs or parts two words.

        A gap wider than the run's narrowest one joins at a cost only.
        """
        parts = SPACED_PARTS.findall(run)
        narrow = min(len(gap) for _, gap in parts[:-1])
        out: list[Options] = []
        for at, (sign, gap) in enumerate(parts):
            if sign in STANDS_FOR:
                out.append([*((x, COST_SIGN) for x in STANDS_FOR[sign]),
                            (sign, COST_AS_IS) if sign.isdigit() else ("", COST_DROP)])
            else:
                out.append([(sign, 0.0)])
            if at + 1 < len(parts):
                out.append([("", COST_WIDE * (len(gap) - narrow)), (" ", 0.0)])
        return out

    def best(self, lattice: list[Options]) -> str:
        """The likeliest reading; of equally likely ones the first by the order of options.

        A blank ends a word: it counts as the edge, and after it only the edge
        does. A state is the two letters before, as one number. Readings are
        kept as links to what came before, so time and memory grow with the
        lattice's length.
        """
        log, edges = self.after, EDGE * SIZE + EDGE
        states: dict[int, tuple[float, tuple | None]] = {edges: (0.0, None)}
        for options in lattice:
            coded = [(letters, cost, [EDGE if c == " " else INDEX.get(c, OTHER) for c in letters])
                     for letters, cost in options]
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, before) in states.items():
                for letters, cost, codes in coded:
                    x, s = state, score - cost
                    for z in codes:
                        if z != EDGE:
                            s += log[x * SIZE + z]
                            x = x % SIZE * SIZE + z
                        elif x != edges:
                            s += log[x * SIZE + EDGE]
                            x = edges
                    if x not in after or s > after[x][0]:
                        after[x] = (s, (letters, before) if letters else before)
            states = after
        ends = [(s + (log[x * SIZE + EDGE] if x != edges else 0.0), link)
                for x, (s, link) in states.items()]
        link, text = max(ends, key=lambda e: e[0])[1], []
        while link is not None:
            letters, link = link
            text.append(letters)
        return "".join(reversed(text))

    def joined(self, run: re.Match) -> str:
        """A run of signs that stand apart as words; as written if few of its signs are letters."""
        signs = [s for s, _ in SPACED_PARTS.findall(run.group())]
        if 2 * sum(s.isalpha() for s in signs) < len(signs):
            return run.group()
        return f" {self.best(self.spaced_lattice(run.group()))} "

    def words(self, text: str) -> list[str]:
        """Words of the text as written, but for letters that stand apart, which are joined."""
        return WORD.findall(SPACED.sub(self.joined, text.lower()))


def needs_decoding(word: str) -> bool:
    return (not word.isalpha() and any(c.isalpha() for c in word)) \
        or DOUBLED.search(word) is not None


def trigrams(texts: list[str | None], table: np.ndarray) -> np.ndarray:
    """How often each trigram of signs, numbered by ``table``, stands in ``texts``: memory grows with these alone."""
    joined = "\n\n" + "\n\n".join(t for t in texts if t) + "\n\n"
    n = np.zeros(SIZE**3, np.int64)
    for lo in range(0, len(joined) - 2, PIECE):
        cp = np.frombuffer(joined[lo:lo + PIECE + 2].encode("utf-32-le"), np.uint32)
        x = table[np.minimum(cp, len(table) - 1)]
        codes = (x[:-2] * SIZE + x[1:-1]) * SIZE + x[2:]
        # a word's first letter follows two edges, whatever stands before the blank
        codes = np.where(x[1:-1] == EDGE, x[2:], codes)
        n += np.bincount(codes, minlength=len(n))
    return n


def character_counts(docs: DataFrame, text_col: str = "text") -> dict[int, int]:
    """Trigram counts of all texts: at most ``SIZE``**3 rows whatever the corpus."""
    upper = 0x180
    table = np.full(upper + 1, EDGE, np.int32)
    for cp in range(upper):
        if chr(cp).isalpha():
            table[cp] = INDEX.get(chr(cp).lower()[:1], OTHER)
    table[upper] = OTHER

    def rows(cols: dict) -> dict:
        n = trigrams(cols["text"], table)
        seen = np.flatnonzero(n)
        return {"code": seen, "n": n[seen]}

    per = arrow_rows(docs.select(F.col(text_col).cast("string").alias("text")), ["text"],
                     "code long, n long", rows, text_col="text")
    return {r["code"]: r["n"] for r in per.groupBy("code").agg(F.sum("n").alias("n")).collect()}


def features(word: str) -> list[str]:
    """A word's beginnings of 4 to 8 letters and the whole word."""
    return [word[:k] for k in range(4, min(len(word), 8) + 1)] + [word + "$"]


@dataclass
class Scorer:
    """Weights of word features and of a document's statistics."""

    letters: Characters
    weights: dict[str, float]
    model: np.ndarray | None = None
    max_words: int = 300_000
    cache: dict[str, float] = field(default_factory=dict)
    heads: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        # all features of a word agree in their first four signs: few words have any with a weight
        self.heads = frozenset(f[:4] for f in self.weights)

    def weight(self, word: str) -> float:
        if (word + "$")[:4] not in self.heads:
            return 0.0
        return max(self.weights.get(f, 0.0) for f in features(word))

    def word_score(self, word: str) -> float:
        best = self.weight(word)
        return max(best, self.weight(self.letters.restore(word))) if needs_decoding(word) else best

    def statistics(self, text: str | None) -> list[float]:
        words = Counter(self.letters.words(text) if text else [])
        if len(self.cache) > self.max_words:
            self.cache.clear()
        for w in set(words).difference(self.cache):
            self.cache[w] = self.word_score(w)
        # a word counts once, and by the logarithm of how often it is repeated
        found = [(s, words[w]) for w, s in zip(words, map(self.cache.__getitem__, words),
                                               strict=True) if s]
        hits = sorted((s for s, _ in found), reverse=True)
        n, total = max(len(words), 1), sum(s * (1 + math.log(c)) for s, c in found)
        strong = sum(s > 3.0 for s in hits)
        top = (hits + [0.0, 0.0])[:2]
        return [1.0, math.log1p(1000 * total / n) / 5, math.log1p(1000 * strong / n) / 3,
                math.log1p(total) / 3, math.log1p(strong), *(t / 3 for t in top),
                math.log1p(n) / 5]

    def score(self, text: str | None) -> float:
        if self.model is None:
            return 0.0
        z = float(np.dot(self.model, self.statistics(text)))
        return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05,
                 steps: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton's method (the constant is not shrunk)."""
    beta, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - pull * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(beta)), grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Fits a :class:`Scorer`: characters on all of ``docs``, weights on labelled rows.

    Labelled rows that are held out (crc32 of the id, modulo 5, is 0) are never
    used. Of the others at most ``sample_rows`` a label are, the same ones each
    time, weighted back to the labels' true shares. An id on many rows gives one
    text, the same one each time. The weights of a document's statistics come from describing
    either half of them with the words' weights of the other half.
    """
    letters = Characters(character_counts(docs, text_col))
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return Scorer(letters, {})
    picked = None
    for y in (0, 1):
        some = known.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit("pick"), "doc_id"), "doc_id") \
            .limit(sample_rows)
        picked = some if picked is None else picked.union(some)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    # at most 2 * sample_rows ids, hence bounded windows; halves alternate within a label
    nth = F.row_number().over(Window.partitionBy("y").orderBy(
        F.xxhash64(F.lit("half"), "doc_id"), "doc_id"))
    picked = picked.withColumn("half", (nth % 2).cast("long"))
    sample = stored(texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y", "half").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")), "labelled")

    columns = [f"{kind}{half}" for half in (0, 1) for kind in ("clean", "toxic")]

    def count(cols: dict) -> dict:
        seen: dict[str, list[int]] = {}
        for text, y, half in zip(cols["text"], cols["y"], cols["half"], strict=True):
            own: set[str] = set()
            for w in set(letters.words(text or "")):
                own.update(features(letters.restore(w) if needs_decoding(w) else w))
            for f in own:
                seen.setdefault(f, [0, 0, 0, 0])[2 * half + y] += 1
        return {"feature": list(seen)} | {
            c: [v[i] for v in seen.values()] for i, c in enumerate(columns)}

    sizes = {(r["half"], r["y"]): r["n"] for r in
             sample.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 4:
        return Scorer(letters, {})
    per = arrow_rows(sample, ["text", "y", "half"],
                     "feature string, " + ", ".join(f"{c} long" for c in columns), count,
                     text_col="text", max_chars=1_000_000)
    per = per.groupBy("feature").agg(*[F.sum(c).alias(c) for c in columns])
    # bounded by the sample: features of at least three of its toxic rows
    kept = per.filter("toxic0 + toxic1 >= 3").collect()

    def weights(halves: tuple[int, ...], least: int) -> dict[str, float]:
        out = {}
        for r in kept:
            toxic = sum(r[f"toxic{h}"] for h in halves)
            clean = sum(r[f"clean{h}"] for h in halves)
            if toxic >= least:
                of = [sum(sizes[h, y] for h in halves) for y in (0, 1)]
                w = math.log(toxic / of[1]) - math.log((clean + 1) / (of[0] + 1))
                if w > 1.5:
                    out[r["feature"]] = w
        return out

    # each half is described with the weights of the other one
    others = tuple(Scorer(letters, weights((1 - half,), 2)) for half in (0, 1))

    def describe(cols: dict, own: tuple[Scorer, Scorer]) -> dict:
        return {"y": cols["y"], "x": [own[half].statistics(t) for t, half in
                                      zip(cols["text"], cols["half"], strict=True)]}

    rest = arrow_rows(sample, ["text", "y", "half"], "y int, x array<double>", describe,
                      text_col="text", setup=lambda: others).collect()
    scorer = Scorer(letters, weights((0, 1), 3))
    y = np.array([r["y"] for r in rest], float)
    x = np.array([r["x"] for r in rest])
    whole = shares[0] + shares[1]
    weight = np.where(y == 1, shares[1] / whole / y.mean(), shares[0] / whole / (1 - y.mean()))
    scorer.model = fit_logistic(x, y, weight)
    return scorer


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Only the text enters a score. Defined cases: null and empty texts get the
    score of a text without words; a null id is not held out; repeated rows
    are scored alike; with fewer than two sampled documents of either label
    every score is 0, as there is nothing to learn a half from; an empty table
    gives an empty result; other columns are not read.
    """
    scorer = fit(docs, labels, id_col, text_col)
    held = by_value(docs.sparkSession, scorer)  # bounded: features of the sample

    def rows(cols: dict, own: Scorer) -> dict:
        return {"doc_id": cols["doc_id"], "score": [own.score(t) for t in cols["text"]]}

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    scored = arrow_rows(named, ["doc_id", "text"], "doc_id long, score double", rows,
                        text_col="text", setup=held)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` with a score below ``threshold``; cases as in :func:`toxicity`."""
    held = by_value(docs.sparkSession, fit(docs, labels, id_col, text_col))

    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = held()
        for part in texts:
            yield pd.Series([own.score(t) for t in part], dtype="float64")
        del own
        release()

    score = F.pandas_udf(scores, "double")
    return docs.filter(score(F.col(text_col).cast("string")) < threshold)
