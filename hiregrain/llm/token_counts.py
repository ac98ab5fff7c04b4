"""Token counts by a linear longest-match automaton.

The strings of a vocabulary make a trie. When a word leaves the trie, greedy longest matching
would emit some strings and go on with what is left of the word; a node's failure link leads to
what is left, and the number of strings emitted on the way is kept with it. So a word's pieces
are counted in one pass over its bytes and none is built.

A word is what stands between ASCII white space, led by one space as the mark of its beginning.
A word that the vocabulary cannot spell is one unknown token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hiregrain.llm.byte_bpe import VOCABULARY, read_ranks
from hiregrain.llm.common import per_text, table

MARK = b" "
FIELDS = "n_words long, n_tokens long"


@dataclass
class Trie:
    """Nodes in order of depth: parent, byte from it, whether a string ends there."""

    parent: np.ndarray
    byte: np.ndarray
    ends: np.ndarray
    depth: np.ndarray

    @classmethod
    def of(cls, strings: list[bytes]) -> Trie:
        prefixes = {string[:k] for string in strings for k in range(len(string) + 1)} | {b""}
        ordered = sorted(prefixes, key=lambda x: (len(x), x))
        number = {prefix: k for k, prefix in enumerate(ordered)}
        own = set(strings)
        return cls(
            np.array([number[x[:-1]] for x in ordered], np.int32),
            np.array([x[-1] if x else 0 for x in ordered], np.uint8),
            np.array([bool(x) and x in own for x in ordered]),
            np.array([len(x) for x in ordered], np.int32),
        )

    def automaton(self) -> Automaton:
        """Every move of every node, worked out level by level: a failure link leads to a node
        of less depth, so its moves are known before they are needed."""
        n = len(self.parent)
        lost = n
        moves = np.full((n + 1, 256), lost, np.int32)
        # A move emits fewer strings than its node has bytes.
        few = np.uint8 if self.depth[-1] < 256 else np.int32
        emitted = np.zeros((n + 1, 256), few)
        fail, popped = np.full(n + 1, lost, np.int32), np.zeros(n + 1, np.int64)
        rest = np.zeros(n + 1, np.int64)
        depths = np.searchsorted(self.depth, np.arange(int(self.depth[-1]) + 2))
        for low, high in zip(depths, depths[1:], strict=False):
            level = np.arange(low, high)
            if low:
                # A string is emitted itself; else the parent's failure takes the byte on.
                up, byte = self.parent[level], self.byte[level]
                onward = fail[up]
                fail[level] = np.where(self.ends[level], 0, moves[onward, byte])
                popped[level] = np.where(self.ends[level], 1, popped[up] + emitted[onward, byte])
                moves[level] = moves[fail[level]]
                emitted[level] = emitted[fail[level]] + popped[level][:, None].astype(few)
                rest[level] = rest[fail[level]] + popped[level]
            first, last = np.searchsorted(self.parent[1:], [low, high]) + 1
            own = np.arange(first, last)
            moves[self.parent[own], self.byte[own]] = own
            emitted[self.parent[own], self.byte[own]] = 0
        spelled = np.ones(n + 1, bool)
        spelled[lost] = False
        for low, high in zip(depths[1:], depths[2:], strict=False):
            spelled[low:high] = spelled[fail[low:high]]
        return Automaton(moves, emitted, rest, spelled)


@dataclass
class Automaton:
    """Next node and strings emitted for each node and byte; strings that end a word in a node,
    and whether what is left there can be spelled."""

    moves: np.ndarray
    emitted: np.ndarray
    rest: np.ndarray
    spelled: np.ndarray

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, all words a byte further in each step."""
        sizes = np.array([len(word) for word in words], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        text = np.frombuffer(b"".join(words[k] for k in order.tolist()), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state, total = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for at, k in enumerate(live.tolist()):
            byte = text[starts[:k] + at]
            total[:k] += self.emitted[state[:k], byte]
            state[:k] = self.moves[state[:k], byte]
        found = np.empty(len(words), np.int64)
        found[order] = np.where(self.spelled[state], total + self.rest[state], 1)
        return found


#: The automaton a worker process made last, with the number of its vocabulary.
_LATEST: list[tuple[int, Automaton]] = []


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``row``, n_words and n_tokens for every row of ``docs``, by the strings of the vocabulary
    file at ``path``. A null or empty text has neither."""
    strings = list(read_ranks(path or public_tokenizers.path(VOCABULARY)))
    number, trie = hash(frozenset(strings)), Trie.of(strings)
    sent = docs.sparkSession.sparkContext.broadcast(trie)  # 10 bytes a node

    def worker():
        if not _LATEST or _LATEST[0][0] != number:
            _LATEST[:] = [(number, sent.value.automaton())]
        automaton = _LATEST[0][1]

        def work(texts):
            index: dict[bytes, int] = {}
            take = index.setdefault
            ids = [[take(word, len(index)) for word in (text or b"").split()] for text in texts]
            each = automaton.counts([MARK + word for word in index])
            n_words = [len(own) for own in ids]
            n_tokens = [int(each[own].sum()) if own else 0 for own in ids]
            return [pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())]

        return work

    return per_text(docs, worker, FIELDS)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pieces of every document. A null or empty text has none of either; repeated
    rows are counted each; texts are counted whole; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted(docs).select("row.doc_id", "n_words", "n_tokens")
