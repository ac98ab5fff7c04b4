"""Periodic runs of words by internal pattern matching.

A run of period q and at least four times its length holds, for the power of two from q up, an
aligned dyadic block of words that occurs again q words to its left or right. So every aligned
block of every size asks for its occurrences in the window of its own size on either side: they
are a row range of the suffix array, from which a wavelet tree gives the successors of the
window's start. The occurrences form arithmetic progressions. The block's own one has its
difference as candidate period; of the others, each member's distance is one. A candidate is
extended to both sides by the ranks of dyadic substrings, and the longest-known stretch with the
smallest period is the run.

Before, a task leaves out what can be in no run: each three words in a row of such a run stand at
least three times in the text. Texts share one suffix array a block of texts.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import per_text, table
from hiregrain.llm.fm_index import Bits

#: A run has at least so many words, and its period at least so many times.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Three words in a row of a run occur so often in its text at least.
GRAM, GRAM_TIMES = 3, 3
#: Counters for them, by hash, for each word; two that share one are at most looked at in vain.
COUNTERS = 8
FIELDS = (
    "n_words long, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string,"
    "collapsed_sha256 string"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class RangeSuccessor:
    """A wavelet tree over a permutation: order statistics of any range of its places."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            flags = (values >> bit & 1).astype(bool)
            zeros = int(len(flags) - flags.sum())
            self.levels.append((bit, Bits(flags), zeros))
            values = np.concatenate([values[~flags], values[flags]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of places low up to high are below each bound."""
        found = np.zeros(len(low), np.int64)
        over = bound >= 1 << len(self.levels)
        found[over] = (high - low)[over]
        for bit, flags, zeros in self.levels:
            ones_low, ones_high = flags.rank(low), flags.rank(high)
            one = (bound >> bit & 1).astype(bool)
            found += np.where(one & ~over, (high - ones_high) - (low - ones_low), 0)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return found

    def select(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The value of each number, counted from 0 in order of size, in places low up to high."""
        value = np.zeros(len(low), np.int64)
        for bit, flags, zeros in self.levels:
            ones_low, ones_high = flags.rank(low), flags.rank(high)
            n_zeros = (high - ones_high) - (low - ones_low)
            one = number >= n_zeros
            number = np.where(one, number - n_zeros, number)
            value |= one.astype(np.int64) << bit
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return value


class Dyadic:
    """Ranks of all substrings of a power of two words, and the suffix array; each 0 is a symbol
    of its own. They reach up to the first power that covers the longest stretch without a 0."""

    def __init__(self, symbols: np.ndarray):
        n, gaps = len(symbols), symbols == 0
        places = np.flatnonzero(np.concatenate([[True], gaps, [True]]))
        reach = int(np.diff(places).max())
        rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + int(gaps.sum()))
        order = np.argsort(rank)
        self.ranks: list[np.ndarray] = []
        step = 0
        while True:
            ordered = rank[order]
            dense = np.empty(n, np.int32)
            dense[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            self.ranks.append(dense)
            step = 2 * step or 1
            if step > reach:
                break
            after = np.zeros(n, np.int64)
            after[:-step] = dense[step:] + 1
            rank = dense * np.int64(n + 1) + after
            order = np.argsort(rank)
        self.suffixes = order

    def rows(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array's rows that begin with the block of 2**level words at each place."""
        counts = np.bincount(self.ranks[level])
        first = np.cumsum(counts) - counts
        own = self.ranks[level][at]
        return first[own], first[own] + counts[own]

    def common(self, left: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
        """How many words from each two places on are equal; with ``back``, those before them."""
        done = np.zeros(len(left), np.int64)
        n = len(self.suffixes)
        for level in range(len(self.ranks) - 1, -1, -1):
            size, rank = 1 << level, self.ranks[level]
            a = left - done - size if back else left + done
            b = right - done - size if back else right + done
            inside = np.flatnonzero((a >= 0) & (b >= 0) & (a < n) & (b < n))
            equal = inside[rank[a[inside]] == rank[b[inside]]]
            done[equal] += size
        return done


@dataclass
class Found:
    """Runs as parallel arrays, by start and then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _candidates(words: Dyadic, level: int, successor: RangeSuccessor) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): where a word begins to equal the one a period later, from the blocks of a
    level and their occurrences nearby."""
    size, n = 1 << level, len(words.suffixes)
    blocks = np.arange(0, n - size + 1, size)
    low, high = words.rows(level, blocks)
    blocks, low, high = (x[high - low > 1] for x in (blocks, low, high))
    first = successor.below(low, high, np.maximum(blocks - size, 0))
    times = successor.below(low, high, blocks + size + 1) - first
    owner = np.repeat(np.arange(len(blocks)), times)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times) + first[owner]
    found = successor.select(low[owner], high[owner], number)
    distance = found - blocks[owner]
    # Members of the progression that holds the block differ from it by multiples of one step.
    gap = np.full(len(blocks), n, np.int64)
    apart = np.flatnonzero(distance)
    np.minimum.at(gap, owner[apart], np.abs(distance[apart]))
    own = gap[owner]
    steps = np.abs(distance) // np.maximum(own, 1)
    # A member is needless if the one before it, a step nearer to the block, is there as well.
    key = owner * (2 * n + 1) + distance + n
    nearer = key - np.sign(distance) * own
    at = np.minimum(np.searchsorted(key, nearer), max(len(key) - 1, 0))
    chained = (distance % np.maximum(own, 1) == 0) & (steps > 1) & (key[at] == nearer if len(key) else False)
    keep = (distance != 0) & ~chained
    left = np.minimum(found, blocks[owner])[keep]
    return left, np.abs(distance)[keep]


def runs_of(symbols: np.ndarray) -> Found:
    """All runs in ``symbols``: positive numbers; 0 separates and is in no run."""
    nothing = np.zeros(0, np.int64)
    if len(symbols) < LEAST_WORDS:
        return Found(nothing, nothing, nothing)
    words = Dyadic(symbols)
    successor = RangeSuccessor(words.suffixes)
    starts, lengths, periods = [nothing], [nothing], [nothing]
    for level in range(len(words.ranks)):
        if LEAST_TIMES << level >> 1 > len(symbols):
            break
        left, period = _candidates(words, level, successor)
        back = words.common(left, left + period, back=True)
        length = back + words.common(left, left + period, back=False) + period
        long = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        starts.append((left - back)[long])
        lengths.append(length[long])
        periods.append(period[long])
    start, length, period = map(np.concatenate, (starts, lengths, periods))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # A stretch found with several periods has the smallest.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((length, period, start))
    return Found(start[order], length[order], period[order])


def live(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which words may be in a run: those in three in a row, four times in a row, that stand at
    least three times in the text."""
    found = np.zeros(len(ids), bool)
    starts = len(ids) - GRAM + 1
    if starts < LEAST_WORDS - GRAM + 1:
        return found
    x = (ids + 1).astype(np.uint64)
    mixed = owner[:starts].astype(np.uint64)
    for k in range(GRAM):
        # Fixed value: the odd multiplier of Fibonacci hashing for 64 bits.
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + x[k : starts + k]
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    bits = (COUNTERS * starts).bit_length()
    slot = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    often = np.bincount(slot)[slot] >= GRAM_TIMES
    often &= owner[:starts] == owner[GRAM - 1 :]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], often.astype(np.int8), [0]])))
    for begin, end in edges.reshape(-1, 2)[(edges[1::2] - edges[::2]) >= LEAST_WORDS - GRAM + 1]:
        found[begin : end + GRAM - 1] = True
    return found


def runs_in(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs in each list of words."""
    vocabulary: dict[bytes, int] = {}
    counts = np.array([len(words) for words in texts], np.int64)
    ids = np.fromiter(
        (vocabulary.setdefault(word, len(vocabulary)) for words in texts for word in words),
        np.int64,
        int(counts.sum()),
    )
    owner = np.repeat(np.arange(len(texts)), counts)
    places = np.flatnonzero(live(ids, owner))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(places):
        return found
    # A 0 between stretches that do not touch, or touch across two texts.
    breaks = np.ones(len(places), bool)
    breaks[1:] = (np.diff(places) > 1) | (np.diff(owner[places]) > 0)
    at = np.arange(len(places)) + np.cumsum(breaks)
    symbols = np.zeros(int(at[-1]) + 2, np.int64)
    symbols[at] = np.unique(ids[places], return_inverse=True)[1] + 1
    origin = np.zeros(len(symbols), np.int64)
    origin[at] = places
    runs = runs_of(symbols)
    begins = origin[runs.start]
    offsets = np.cumsum(counts) - counts
    for text, start, length, period in zip(
        owner[begins].tolist(),
        (begins - offsets[owner[begins]]).tolist(),
        runs.length.tolist(),
        runs.period.tolist(),
        strict=True,
    ):
        found[text].append((start, length, period))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(words[k] for k in np.flatnonzero(keep).tolist())


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's words of a document: every tenth id, by hash, repeats a part of its own."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + k % period] for k in range(n - first)]


def periodic_runs(docs: DataFrame, altered: bool = False) -> DataFrame:
    """``docs`` as a struct ``row``, with n_words, the runs of its text by start and period, their
    digest and that of the text without repeated periods.

    Null, empty and blank texts have no words and no runs. A row is judged alone: repeats get
    equal results, no row is dropped, and other columns of any name stay in ``row``. A text is
    handled whole; a task needs some 8 bytes, and 4 for each doubling of its longest stretch, for
    a word that may be in a run. With ``altered``, words are those of ``planted``.
    """

    def worker():
        def work(texts, ids=None):
            split = [text.split() if text else [] for text in texts]
            if ids is not None:
                split = [planted(words, doc_id) for words, doc_id in zip(split, ids, strict=True)]
            found = runs_in(split)
            lines = ["".join("%d,%d,%d\n" % run for run in runs) for runs in found]
            rest = [collapsed(*pair) for pair in zip(split, found, strict=True)]
            return [
                pa.array([len(words) for words in split], pa.int64()),
                pa.array(
                    [[dict(zip(("start", "length", "period"), run, strict=True)) for run in runs] for runs in found],
                    pa.list_(_RUN),
                ),
                pa.array([hashlib.sha256(line.encode()).hexdigest() for line in lines]),
                pa.array([hashlib.sha256(text).hexdigest() for text in rest]),
            ]

        return work

    return per_text(docs, worker, FIELDS, beside="doc_id" if altered else None)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document's words, every tenth document altered as ``planted`` says.

    A null text has no words and no runs, and the digests of nothing; a null doc_id is never
    altered. The run shown is the longest, of equally long ones the first, then that of the
    smallest period; without a run its four columns are null.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.array_max(
        F.transform(
            "runs",
            lambda run: F.struct(
                run["length"].alias("length"),
                (-run["start"]).alias("earlier"),
                (-run["period"]).alias("shorter"),
            ),
        )
    )
    found = periodic_runs(docs, altered=True).select("*", best.alias("best"))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.earlier")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.expr("(1000 * best.length) div (-best.shorter)").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
