"""Wavelet matrix: counts of any symbol in any prefix of a long sequence, from a bit a symbol and level.

Level by level from the highest bit, symbols are stably parted into zeros and ones; a count of one symbol in a
prefix follows its bits down the levels, one rank of bits each.  All queries take arrays of positions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class BitRanks:
    """A bit sequence with the number of ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Over small unsigned symbols of `bits` bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.bits, self.levels = len(symbols), bits, []
        for b in range(bits - 1, -1, -1):
            ones = (symbols >> np.uint8(b)) & np.uint8(1)
            self.levels.append((BitRanks(ones), self.size - int(np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol among the first i."""
        low, high = np.zeros(1, dtype=np.int64), i
        for level, (ranks, zeros) in enumerate(self.levels):
            if symbol >> (self.bits - 1 - level) & 1:
                low, high = zeros + ranks.ones(low), zeros + ranks.ones(high)
            else:
                low, high = low - ranks.ones(low), high - ranks.ones(high)
        return high - low

    def rank_any(self, symbols: Sequence[int], i: np.ndarray) -> np.ndarray:
        """Occurrences of any of the symbols among the first i; the rest is counted where that takes fewer ranks."""
        rest = [s for s in range(1 << self.bits) if s not in symbols]
        if len(rest) < len(symbols):
            return i - self.rank_any(rest, i)
        return sum((self.rank(s, i) for s in symbols), np.zeros(len(i), dtype=np.int64))

    def after(self, symbols: Sequence[int], k: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least position in start..end with k of the symbols between start and it, by bisection on ranks; `end` where there are fewer."""
        low, high, base = start.copy(), end.copy(), self.rank_any(symbols, start)
        while True:
            active = low < high
            if not active.any():
                return low
            middle = (low + high) >> 1
            enough = self.rank_any(symbols, middle) - base >= k
            high = np.where(active & enough, middle, high)
            low = np.where(active & ~enough, middle + 1, low)
