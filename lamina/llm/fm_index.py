"""A compressed FM-index over word numbers, searched for many patterns at once.

The Burrows-Wheeler transform of a text is kept as a wavelet matrix: a bit vector per bit
of the alphabet, packed to 64 bits a word with a running count per word, so that rank is
one look-up and one population count.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels, row = [], symbols
        for bit in range(self.depth - 1, -1, -1):
            ones = (row >> bit) & 1 == 1
            self.levels.append(BitVector(ones))
            row = np.concatenate([row[~ones], row[ones]])
        self.starts = self._down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bit in zip(self.levels, range(self.depth - 1, -1, -1)):
            ones = level.rank1(at)
            at = np.where((symbols >> bit) & 1 == 1, level.zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self.starts[symbols]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; ends soon if no long part of the text repeats."""
    n, width = len(text), 1
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    while True:
        later = np.zeros(n, dtype=np.int64)
        later[: n - width] = rank[width:] + 1
        key = rank * (n + 2) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if new[order[-1]] == n - 1:
            return order
        rank, width = new, 2 * width


class FMIndex:
    """Index of segments of word numbers (from 1); each segment ends in a mark of its own."""

    def __init__(self, segments: list[np.ndarray], sigma: int):
        marks = np.arange(len(segments))
        parts, self.first = [], np.zeros(len(segments), dtype=np.int64)
        at = 0
        for i, s in enumerate(segments):
            self.first[i] = at
            parts += [s + (len(segments) - 1), marks[i : i + 1]]
            at += len(s) + 1
        text = np.concatenate(parts)
        order = suffix_array(text)
        self.text = np.maximum(text - (len(segments) - 1), 0)  # marks are 0
        self.sigma = sigma + 1
        counts = np.bincount(self.text, minlength=self.sigma)
        self.counts, self.below = counts, np.cumsum(counts) - counts
        self.matrix = WaveletMatrix(self.text[order - 1], self.sigma)

    def intervals(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of the patterns of ``length`` words that begin at places of the text.

        Returns the interval of suffixes that begin with each.  A pattern whose interval
        shrinks to one suffix occurs once; its search stops there.
        """
        last = self.text[starts + length - 1]  # all suffixes that begin with the last word: nothing to rank
        low = self.below[last]
        high = low + self.counts[last]
        live = np.flatnonzero(high - low > 1)
        for step in range(length - 2, -1, -1):
            symbols = self.text[starts[live] + step]
            low[live] = self.below[symbols] + self.matrix.rank(symbols, low[live])
            high[live] = self.below[symbols] + self.matrix.rank(symbols, high[live])
            live = live[high[live] - low[live] > 1]
            if not len(live):
                break
        return low, high
