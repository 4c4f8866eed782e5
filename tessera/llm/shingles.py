"""Word-shingle sets and their SetSketch registers, in numpy over Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            inverse = pow(MULTIPLIER, -1, 2**64)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, p, np.uint64)])
                                  for p in (np.uint64(MULTIPLIER), np.uint64(inverse)))
        return self.up, self.down


POWERS = Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and where each text starts and ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


ASCII_BLANKS = np.zeros(256, bool)
ASCII_BLANKS[[32, *range(9, 14)]] = True


def word_hashes(raw: np.ndarray, at: np.ndarray,
                blanks: np.ndarray = ASCII_BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lower-cased, split at the bytes in ``blanks``).

    Returns the hashes in order and, like ``at``, where each text's words start
    and end. A word's hash is a polynomial in its bytes, taken from prefix sums.
    """
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    low = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32)).astype(np.uint8)
    blank = blanks[low]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    begins = ~blank
    begins[1:] &= blank[:-1] | edge[1:-1]
    ends = ~blank
    ends[:-1] &= blank[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = POWERS.to(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((low + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    words = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return words, np.searchsorted(first, at)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each text as sorted 64-bit hashes.

    Returns them one text after the other and where each text's set starts and
    ends. A text of fewer words has its whole sequence as its one shingle; one
    without words has the empty set.
    """
    words, at = word_hashes(*text_bytes(column))
    n_words = np.diff(at)
    base = np.uint64(0xD6E8FEB86659FD93)
    runs = max(len(words) - k + 1, 0)
    rolled = np.zeros(runs, np.uint64)
    for j in range(k):
        rolled = rolled * base + words[j:j + runs]
    rolled = mix(rolled)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    out_at = np.r_[0, np.cumsum(counts)]
    out = np.empty(out_at[-1], np.uint64)
    for i in np.flatnonzero(counts):
        lo, hi = at[i], at[i + 1]
        if hi - lo >= k:
            part = np.sort(rolled[lo:hi - k + 1])
        else:
            whole = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for w in words[lo:hi]:
                    whole = whole * base + w
            part = mix(np.array([whole], np.uint64))
        out[out_at[i]:out_at[i + 1]] = part
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[out_at[:-1][counts > 0]] = True
    return out[new], np.r_[0, np.cumsum(new)][out_at]


class SetSketch:
    """Registers ``floor(1 - log_b(x))`` of the least of exponential values x.

    Each register holds a truncated minimum on an exponential scale with base
    ``b``. Registers of a union are the larger of both; the smaller ``b`` is,
    the closer the chance of equal registers is to the Jaccard similarity.
    """

    def __init__(self, registers: int = 128, b: float = 1.02, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.m, self.b, self.shift = registers, b, 200
        self.flip = rng.integers(0, 2**32, registers, dtype=np.uint32)
        self.times = rng.integers(0, 2**31, registers, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def of(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(sets, m) registers of non-empty sets; rows of empty sets are 0."""
        out = np.zeros((len(at) - 1, self.m), np.uint16)
        full = np.flatnonzero(np.diff(at))
        if not len(full):
            return out
        x, starts = (flat >> np.uint64(16)).astype(np.uint32), at[:-1][full]
        least = np.empty((self.m, len(full)), np.uint32)
        value, high = np.empty_like(x), np.empty_like(x)
        for i in range(self.m):
            np.bitwise_xor(x, self.flip[i], out=value)
            np.multiply(value, self.times[i], out=value)
            np.right_shift(value, np.uint32(15), out=high)
            np.bitwise_xor(value, high, out=value)
            np.multiply(value, np.uint32(0x2C1B3C6D), out=value)
            np.minimum.reduceat(value, starts, out=least[i])
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
        level = np.floor(1 - np.log(exponential) / np.log(self.b)) + self.shift
        out[full] = np.clip(level, 0, 65535).astype(np.uint16).T
        return out

    def similarity(self, one: np.ndarray, two: np.ndarray, n_one: np.ndarray,
                   n_two: np.ndarray, steps: int = 200) -> np.ndarray:
        """Jaccard similarity of register rows that is likeliest given both set sizes.

        Joint likelihood of how many registers are larger, smaller and equal.
        """
        above = (one > two).sum(1)[:, None]
        below = (one < two).sum(1)[:, None]
        equal = self.m - above - below
        share = (n_one / (n_one + n_two))[:, None]
        most = np.minimum(n_one, n_two) / np.maximum(n_one, n_two)
        grid = np.linspace(0, 1, steps + 1)[None, :] * most[:, None]
        chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (self.b - 1) / self.b) / np.log(self.b)
        p, q = chance(share - (1 - share) * grid), chance((1 - share) - share * grid)
        tiny = 1e-12
        likely = (above * np.log(p + tiny) + below * np.log(q + tiny)
                  + equal * np.log(np.maximum(1 - p - q, tiny)))
        return grid[np.arange(len(grid)), likely.argmax(1)]
