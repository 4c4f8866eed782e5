"""Personal data by a linear-chain conditional random field and base patterns.

The base patterns are exact. The field reads the words around digits and @
signs, each described by its shape and its neighbours' shapes, and Viterbi
decodes the likeliest labels of many windows at once. It adds spans the
patterns miss; those must still look like their kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows
from tessera.llm.pii_training import labelled_rows

KINDS = ("email", "ip", "card", "phone")
OUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
       "spans string")

# --- base patterns ----------------------------------------------------------------
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits can only match if the run's start does
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their @ signs in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def small_part(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def card_number(text: str) -> bool:
    digits = "".join(c for c in text if "0" <= c <= "9")
    return 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every base match."""
    out = [(a, "email", b) for a, b in emails(text)]
    if DIGITS.search(text):
        out += [(m.start(), "ip", m.end()) for m in IP.finditer(text)
                if all(map(small_part, m.group().split(".")))]
        out += [(m.start(), "card", m.end()) for m in CARD.finditer(text) if card_number(m.group())]
        if "+" in text:
            out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text)
                    if 9 <= len(DIGITS.findall(m.group())) <= 15]
    return out


def joined(spans: list[tuple[int, str, int]]) -> str:
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in order)


# --- the random field -------------------------------------------------------------
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
# Words whose spelling is a feature of its own.
CUES = frozenset("at dot com org net de edu example mail email e tel phone call fax mobile ring "
                 "whatsapp number contact card visa pay charged host server ping ip from isbn "
                 "token password sha version license section".split())
WINDOW = 60
#: Tokens decoded together, padding included, if more than one window is.
CELLS = 200_000


def shape(token: str, spaced: bool) -> str:
    if token[0].isdigit():
        n = len(token)
        out = f"d{n if n <= 4 else '5' if n <= 7 else '8' if n <= 11 else '12' if n <= 19 else '20'}"
    elif token[0].isalpha():
        low = token.lower()
        out = low if low in CUES else "w1" if len(low) == 1 else "w"
    else:
        out = token if token in "+()-.@:=/[]\",%" else "p"
    return out + ("_" if spaced else "")


def tokens(text: str, lo: int, hi: int) -> list[tuple[int, int, str]]:
    """(start, end, shape) of the tokens between two places of the text."""
    out, end = [], lo
    for m in TOKEN.finditer(text, lo, hi):
        out.append((m.start(), m.end(), shape(m.group(), m.start() > end)))
        end = m.end()
    return out


class ChainField:
    """Weights of shape features and label transitions."""

    def __init__(self) -> None:
        self.features: dict[str, int] = {}
        self.emit = np.zeros((1, len(LABELS)))
        self.move = np.zeros((len(LABELS), len(LABELS)))

    def described(self, shapes: list[str]) -> Iterator[list[str]]:
        s = ["<", "<", *shapes, ">", ">"]
        return ([f"0{s[i]}", f"-{s[i - 1]}", f"+{s[i + 1]}", f"a{s[i - 1]}|{s[i]}",
                 f"b{s[i]}|{s[i + 1]}", f"c{s[i - 1]}|{s[i]}|{s[i + 1]}",
                 f"d{s[i - 2]}|{s[i - 1]}", f"e{s[i + 1]}|{s[i + 2]}"]
                for i in range(2, len(shapes) + 2))

    def matrix(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, length, features) numbers, 0 for unknown ones and padding, and lengths."""
        out = np.zeros((len(rows), max(map(len, rows), default=0), 8), np.int64)
        for i, row in enumerate(rows):
            for j, names in enumerate(self.described(row)):
                out[i, j] = [self.features.get(n, 0) for n in names]
        return out, np.array([len(r) for r in rows])

    def train(self, table: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 250,
              rate: float = 0.1, shrink: float = 0.01) -> ChainField:
        """Maximum likelihood with an L2 penalty, by Adam on the whole table."""
        shapes, gold = [], []
        for text, spans in table:
            row = tokens(text, 0, len(text))
            shapes.append([s for _, _, s in row])
            gold.append([next((LABELS.index(("B-" if a == lo or not any(
                lo <= x < a for x, _, _ in row) else "I-") + kind)
                for kind, lo, hi in spans if lo <= a and b <= hi), 0) for a, b, _ in row])
        for row in shapes:
            for names in self.described(row):
                for n in names:
                    self.features.setdefault(n, len(self.features) + 1)
        x, n = self.matrix(shapes)
        width, k = x.shape[1], len(LABELS)
        self.emit = np.zeros((len(self.features) + 1, k))
        y = np.zeros((len(gold), width), np.int64)
        for i, g in enumerate(gold):
            y[i, :len(g)] = g
        here = np.arange(width)[None, :] < n[:, None]
        eye = np.eye(k)
        seen = eye[y] * here[..., None]
        both = np.einsum("rtk,rtl->kl", seen[:, :-1], seen[:, 1:])
        state = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.emit, self.move)]
        for step in range(1, steps + 1):
            e = self.emit[x].sum(2)
            fwd, bwd = np.zeros_like(e), np.zeros_like(e)
            fwd[:, 0] = e[:, 0]
            for t in range(1, width):
                fwd[:, t] = e[:, t] + _logsum(fwd[:, t - 1, :, None] + self.move, 1)
            for t in range(width - 2, -1, -1):
                on = _logsum(self.move + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
                bwd[:, t] = np.where(here[:, t + 1, None], on, 0.0)
            z = _logsum(fwd[np.arange(len(n)), n - 1], 1)
            p = np.exp(fwd + bwd - z[:, None, None]) * here[..., None]
            pair = fwd[:, :-1, :, None] + self.move + (e + bwd)[:, 1:, None, :] - z[:, None, None, None]
            pairs = (np.exp(np.minimum(pair, 0)) * here[:, 1:, None, None]).sum((0, 1))
            g_emit = np.zeros_like(self.emit)
            np.add.at(g_emit, x.reshape(-1), np.repeat((p - seen).reshape(-1, k), 8, 0))
            g_emit[0] = 0
            for w, g, (m, v) in zip((self.emit, self.move), (g_emit, pairs - both), state,
                                    strict=True):
                g = g + shrink * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, rows: list[list[str]]) -> list[np.ndarray]:
        """The likeliest labels of each row (Viterbi over all rows at once)."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(rows)
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        lo = 0
        while lo < len(order):  # rows of like length together, long ones few at a time
            hi = lo + 1
            while hi < min(lo + 512, len(order)) and (hi - lo + 1) * len(rows[order[hi]]) <= CELLS:
                hi += 1
            part, lo = order[lo:hi], hi
            x, n = self.matrix([rows[i] for i in part])
            e = sum(self.emit[x[:, :, f]] for f in range(x.shape[2]))
            best, back = e[:, 0].copy(), np.zeros(e.shape, np.int8)
            final = best.copy()
            for t in range(1, e.shape[1]):
                via = best[:, :, None] + self.move
                back[:, t] = via.argmax(1)
                best = via.max(1) + e[:, t]
                final[n - 1 == t] = best[n - 1 == t]
            label = final.argmax(1)
            paths = np.zeros(e.shape[:2], np.int64)
            each = np.arange(len(part))
            for t in range(e.shape[1] - 1, -1, -1):
                paths[:, t] = np.where(t < n, label, 0)
                label = np.where((t < n) & (t > 0), back[each, t, label], label)
            for i, path, size in zip(part, paths, n, strict=True):
                out[i] = path[:size]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


# the words as the field's tokens have them: between letters of no other word, in any case
AT = re.compile(r"@|(?<![^\W\d_])at(?![^\W\d_])", re.IGNORECASE)
DOT = re.compile(r"\.|(?<![^\W\d_])dot(?![^\W\d_])", re.IGNORECASE)
TRIGGER = re.compile(r"[0-9@]+|(?<![^\W\d_])(?:at|dot)(?![^\W\d_])", re.IGNORECASE)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches of whole words around digits, @ signs and the words at and dot.

    A span without a digit, an @ sign or the word at is not plausible, so none
    lies elsewhere.
    """
    places = (m.span() for m in TRIGGER.finditer(text))
    out: list[list[int]] = []
    for a, b in places:
        lo, hi = max(a - WINDOW, 0), min(b + WINDOW, len(text))
        # not inside a word, whose shape would change
        while lo and text[lo].isalnum() and text[lo - 1].isalnum() and a - lo < 2 * WINDOW:
            lo -= 1
        while hi < len(text) and text[hi].isalnum() and text[hi - 1].isalnum() and hi - b < 2 * WINDOW:
            hi += 1
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def plausible(kind: str, text: str) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    if kind == "card":
        return card_number(text)
    if kind == "phone":
        return 7 <= digits <= 15 and not any(c.isalpha() for c in text)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(small_part, parts))
    return AT.search(text) is not None and DOT.search(text) is not None


def added_spans(texts: list[str], model: ChainField) -> list[list[tuple[int, str, int]]]:
    """Spans the field finds in each text."""
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    rows, whose = [], []
    for i, text in enumerate(texts):
        for lo, hi in windows(text):
            row = tokens(text, lo, hi)
            if row:  # a window is decoded whole, however long: no span is cut
                rows.append([s for _, _, s in row])
                whose.append((i, row))
    for (i, part), path in zip(whose, model.decode(rows), strict=True):
        start = None
        for j in range(len(part) + 1):
            label = LABELS[path[j]] if j < len(part) else "O"
            if start is not None and label != f"I-{start[1]}":
                a, b = part[start[0]][0], part[j - 1][1]
                if plausible(start[1], texts[i][a:b]):
                    out[i].append((a, start[1], b))
                start = None
            if label[0] == "B":
                start = (j, label[2:])
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base matches by kind, their digest, and all spans, per row of ``docs``.

    Spans are kind:start:end in code points, end exclusive. Those of the field
    are added where they overlap no base span. Defined cases: null and empty
    texts have no span; null ids and repeated rows are read like any other; an
    empty table gives an empty result; other columns are not read.
    """
    model = ChainField().train(labelled_rows())

    def rows(cols: dict) -> dict:
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        texts = [t or "" for t in cols["text"]]
        for text, more in zip(texts, added_spans(texts, model), strict=True):
            base = base_spans(text)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for _, k, _ in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            taken = sorted((a, b) for a, _, b in base)
            for a, kind, b in sorted(set(more)):
                if not any(x < b and a < y for x, y in taken):
                    base.append((a, kind, b))
                    taken.append((a, b))
            out["spans"].append(joined(base))
        return {"doc_id": cols["doc_id"]} | out

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    return arrow_rows(named, ["doc_id", "text"], OUT, rows, text_col="text")
