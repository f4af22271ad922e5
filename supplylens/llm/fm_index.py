"""A compressed FM-index over sequences of small integers, in numpy.

The Burrows-Wheeler transform stands in a wavelet matrix of packed bits with a count per 64-bit word. All
operations take arrays of queries, so that a backward step costs two rank operations per level for all of them.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` symbols at least, by prefix doubling."""
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    length, n = 1, len(text)
    while length < depth:
        shifted = np.full(n, -1, dtype=np.int64)
        shifted[: n - length] = rank[length:]
        key = (rank << 32) + (shifted + 1)
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        length *= 2
        if new[-1] == n - 1:
            break
    return order


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)
        self.ones = int(ones.sum())
        self.zeros = n - self.ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over ``text`` (symbols 0 .. size-1), whose positions carry weights.

    Suffixes are told apart up to ``depth`` symbols, so patterns of that length at most are counted right.
    """

    def __init__(self, text: np.ndarray, size: int, depth: int, weight: np.ndarray):
        order = suffix_array(text, depth)
        bwt = text[order - 1].astype(np.int64)  # the text is taken as a ring: its first symbol follows a separator
        self.levels = max(1, int(size - 1).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.int64)
        self.bits = []
        row = bwt
        for level in reversed(range(self.levels)):
            bit = (row >> level) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        symbols = np.arange(size, dtype=np.int64)
        self.base = self._walk(symbols, np.zeros(size, dtype=np.int64))
        self.weights = np.concatenate([[0], np.cumsum(weight[order])])

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(reversed(range(self.levels)), self.bits):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, bits.zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` followed by what the intervals stand for."""
        both = self._walk(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.first[symbol] - self.base[symbol]
        return both[: len(lo)] + shift, both[len(lo) :] + shift

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weights[hi] - self.weights[lo]

    def match_left(self, text: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
        """For each end ``right`` the leftmost start, not below ``left``, from where the text counts ``least`` or more.

        ``right + 1`` where not even the last symbol does. Both ends are inclusive positions in ``text``.
        """
        start = right + 1
        lo, hi = np.zeros(len(right), dtype=np.int64), np.full(len(right), len(self.weights) - 1, dtype=np.int64)
        live = np.flatnonzero(left <= right)
        while len(live):
            at = start[live] - 1
            a, b = self.step(text[at], lo[live], hi[live])
            ok = self.count(a, b) >= least
            live = live[ok]
            lo[live], hi[live], start[live] = a[ok], b[ok], at[ok]
            live = live[start[live] > left[live]]
        return start
