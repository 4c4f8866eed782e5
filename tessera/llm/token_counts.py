"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie. Where the trie ends, a failure link leads to the
node of what remains after taking off the longest pieces, and the number of
pieces taken off is stored with it; so a word costs one step a character and
no piece is ever built or looked up again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tessera.llm.common import arrow_rows

START = "▁"  # marks the beginning of a word in the vocabulary
COUNTS = "doc_id long, n_chars long, n_words long, n_tokens long"


class LongestMatch:
    """Counts the pieces of words, always taking the longest that fits.

    A character no piece begins with counts as its UTF-8 bytes (byte fallback).
    """

    def __init__(self, pieces: Iterable[str], max_words: int = 200_000) -> None:
        self.max_words, self.seen = max_words, {}
        self.next: list[dict[str, int]] = [{}]
        weight = [0]
        known = {p for p in pieces if p}
        single = {c: len(c.encode()) for p in known for c in p if c not in known}
        for piece in [*known, *single]:
            at = 0
            for c in piece:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    weight.append(0)
                at = self.next[at][c]
            weight[at] = single.get(piece, 1)
        self.fail, self.popped = [0] * len(weight), [0] * len(weight)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for c, v in self.next[u].items():
                queue.append(v)
                if weight[v]:
                    self.popped[v] = weight[v]  # the whole string is a piece: link to the root
                    continue
                z, taken = self.fail[u], self.popped[u]
                # single characters are all in the trie, so the root always goes on
                while c not in self.next[z]:
                    taken += self.popped[z]
                    z = self.fail[z]
                self.fail[v], self.popped[v] = self.next[z][c], taken

    def count(self, word: str) -> int:
        at, total, step, root = 0, 0, self.next, self.next[0]
        for c in word:
            after = step[at].get(c)
            while after is None and at:
                total += self.popped[at]
                at = self.fail[at]
                after = step[at].get(c)
            if after is None:
                total += len(c.encode()) if c not in root else 0
                at = 0
            else:
                at = after
        while at:
            total += self.popped[at]
            at = self.fail[at]
        return total

    def counts(self, text: str) -> tuple[int, int]:
        """(words, pieces) of a whole text split at white space."""
        words = text.split()
        if len(self.seen) > self.max_words:
            self.seen.clear()
        for w in set(words).difference(self.seen):
            self.seen[w] = self.count(START + w)
        return len(words), sum(map(self.seen.__getitem__, words))


def sentence_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece vocabulary file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                    or model.is_unused(i))]


def token_counts(docs: DataFrame, pieces: Callable[[], Iterable[str]], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, n_words and n_tokens of every row of ``docs``.

    ``pieces`` gives the vocabulary where a task runs. Defined cases: null and
    empty texts count 0; null ids and repeated rows are counted like any
    other; an empty table gives an empty result; other columns are not read.
    """
    def rows(cols: dict, automaton: LongestMatch) -> dict:
        texts = [t or "" for t in cols["text"]]
        pairs = [automaton.counts(t) for t in texts]
        return {"doc_id": cols["doc_id"], "n_chars": [len(t) for t in texts],
                "n_words": [p[0] for p in pairs], "n_tokens": [p[1] for p in pairs]}

    named = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    return arrow_rows(named, ["doc_id", "text"], COUNTS, rows, text_col="text",
                      setup=lambda: LongestMatch(pieces()))
