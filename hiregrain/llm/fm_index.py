"""An FM-index over a sequence of numbers: backward search by wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many positions one is kept for locating.
SAMPLE = 16


class Bits:
    """A bit vector that counts its ones up to any place."""

    def __init__(self, flags: np.ndarray):
        packed = np.packbits(flags, bitorder="little")
        padded = np.zeros((len(flags) // 64 + 1) * 8, np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class Wavelet:
    """Ranks of symbols: one bit vector for each bit of the symbols, the highest first; below
    each, the symbols with a zero come before those with a one."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(bits - 1, -1, -1):
            flags = (symbols >> bit & 1).astype(bool)
            zeros = int(len(flags) - flags.sum())
            self.levels.append((bit, Bits(flags), zeros))
            symbols = np.concatenate([symbols[~flags], symbols[flags]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros_like(at)
        for bit, flags, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            ones, low_ones = flags.rank(at), flags.rank(low)
            at = np.where(one, zeros + ones, at - ones)
            low = np.where(one, zeros + low_ones, low - low_ones)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for bit, flags, zeros in self.levels:
            one = flags.get(at)
            ones, low_ones = flags.rank(at), flags.rank(low)
            at = np.where(one, zeros + ones, at - ones)
            low = np.where(one, zeros + low_ones, low - low_ones)
            symbol = symbol | one.astype(np.int64) << bit
        return symbol, at - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; each 0 is a symbol of its own, by position."""
    n = len(symbols)
    gaps = symbols == 0
    n_gaps = int(gaps.sum())
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + n_gaps)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_ = rank[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], (sorted_[1:] != sorted_[:-1])]))
        if n == 0 or new[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:-step] = new[step:] + 1
        # What is alone already needs no look further; its rank stands.
        rank = new * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Finds phrases in ``symbols`` (positive numbers; 0 separates and matches nothing)."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = SAMPLE):
        symbols = np.concatenate([symbols.astype(np.int64), [0]])
        order = suffix_array(symbols)
        before = symbols[order - 1]
        self.wavelet = Wavelet(before, max(1, int(alphabet).bit_length()))
        counts = np.bincount(symbols, minlength=alphabet + 1)
        self.first = np.cumsum(counts) - counts
        self.size = len(symbols)
        # Kept are every sample-th position, and those after a separator, where a walk must end.
        kept = (order % sample == 0) | (before == 0)
        self.kept = Bits(kept)
        self.positions = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases (one a row, filled up with zeros), last symbol first."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for at in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((at < lengths) & (low < high))
            symbol = phrases[live, at]
            low[live] = self.first[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the rows' suffixes: walks back to the next kept position."""
        found = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            done = self.kept.get(at)
            found[left[done]] = self.positions[self.kept.rank(at[done])] + steps
            left, at = left[~done], at[~done]
            symbol, rank = self.wavelet.symbol_and_rank(at)
            at = self.first[symbol] + rank
            steps += 1
        return found
