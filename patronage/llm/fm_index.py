"""Compressed FM-index over sequences of symbols, for many searches at once.

The Burrows-Wheeler transform is kept as a wavelet matrix: one packed bit vector for each bit
of the symbols, with a count every 64 bits. The suffix array is thinned to every few places.
All operations take arrays, so that thousands of searches step together.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_EVERY = 4


class Bits:
    """A bit vector with constant-time counts of ones before a place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Counts of a symbol in a prefix, and symbols by place, of one sequence."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        all_symbols = np.arange(symbols)
        self.origin = self._down(all_symbols, np.zeros(symbols, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.ones(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def count(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c is among the first i."""
        return self._down(c, i) - self.origin[c]

    def symbol_and_count(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i, and how often it occurs before."""
        c = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one, ones = bits.get(i), bits.ones(i)
            c = (c << 1) | one
            i = np.where(one, zeros + ones, i - ones)
        return c, i - self.origin[c]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Zeros are separators and differ from each other: the earlier is
    the smaller, so that no comparison goes past one."""
    n = len(text)
    ends = text == 0
    rank = text + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    step = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[:-step] = rank[step:] + 1
        key = rank * np.int64(rank.max() + 2) + follow
        order = np.argsort(key)
        key = key[order]
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Index of sequences of positive symbols, joined with a zero after each."""

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        self.symbols = int(text.max()) + 1
        order = suffix_array(text)
        self.wavelet = WaveletMatrix(text[order - 1], self.symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        # every few places, and each place after a separator, so that no walk crosses one
        after = np.concatenate([[True], text[:-1] == 0])
        sampled = (order % SAMPLE_EVERY == 0) | after[order]
        self.sampled, self.samples = Bits(sampled), order[sampled].astype(np.int32)

    def extend(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with symbol c put in front."""
        both = self.wavelet.count(np.concatenate([c, c]), np.concatenate([low, high]))
        return self.first[c] + both[:len(c)], self.first[c] + both[len(c):]

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes at these places of the order."""
        out, walked = np.zeros(len(i), np.int64), np.arange(len(i))
        steps = 0
        while len(walked):
            known = self.sampled.get(i)
            out[walked[known]] = self.samples[self.sampled.ones(i[known])] + steps
            i, walked = i[~known], walked[~known]
            if len(i):
                c, before = self.wavelet.symbol_and_count(i)
                i = self.first[c] + before
            steps += 1
        return out

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the places `ends` of a text: the length, up to `most`, of the
        longest run of symbols ending there that occurs at least twice in the index, and its
        interval (of runs with the full length)."""
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        lo, hi = self.first[text[ends]], self.first[text[ends] + 1]
        for k in range(most):
            if k:
                lo, hi = self.extend(text[ends[live] - k], lo, hi)
            twice = hi - lo >= 2
            live, lo, hi = live[twice], lo[twice], hi[twice]
            length[live] = k + 1
            if not len(live):
                break
        low[live], high[live] = lo, hi
        return length, low, high


def earlier_windows(text: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n symbols (by their starts, none with a zero) also start earlier."""
    out = np.zeros(len(starts), bool)
    if not len(starts):
        return out
    index = FMIndex(text)
    length, low, high = index.matching(text, starts + n - 1, n)
    full = np.flatnonzero(length == n)
    if not len(full):
        return out
    lows, of = np.unique(low[full], return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[of] = high[full]
    sizes = highs - lows
    at = np.concatenate([[0], np.cumsum(sizes)])
    places = index.locate(np.repeat(lows - at[:-1], sizes) + np.arange(at[-1]))
    least = np.minimum.reduceat(places, at[:-1])
    out[full] = least[of] < starts[full]
    return out
