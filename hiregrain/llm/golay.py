"""The binary (23, 12) Golay code as a fuzzy hash: words near each other share a codeword index.

The code is perfect: each 23-bit word lies within 3 bits of exactly one codeword. The keys of a
word are the indices of all codewords within 4 bits: six, or one if the nearest codeword is
within 2 bits. Two words at most 2 bits apart share a key: some word is within one bit of both,
and its nearest codeword lies within 4 bits of both.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH = 23
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
RADIUS = 4
MOST_KEYS = 6


def syndrome(word: int) -> int:
    """Remainder of the word by the generator polynomial."""
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of each byte in each place; for each syndrome the error patterns up to RADIUS
    (unused places repeat the first)."""
    by_byte = np.array(
        [[syndrome(b << shift & ((1 << LENGTH) - 1)) for b in range(256)] for shift in (0, 8, 16)]
    )
    single = [syndrome(1 << bit) for bit in range(LENGTH)]
    patterns: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(RADIUS + 1):
        for bits in combinations(range(LENGTH), weight):
            error = rest = 0
            for bit in bits:
                error |= 1 << bit
                rest ^= single[bit]
            patterns[rest].append(error)
    padded = [own + own[:1] * (MOST_KEYS - len(own)) for own in patterns]
    return by_byte, np.array(padded, np.int64)


def keys(words: np.ndarray, by_byte: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords near each word, MOST_KEYS a row; repeats stand for none."""
    rest = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    return (words[:, None] ^ errors[rest]) >> 11
