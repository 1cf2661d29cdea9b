"""A compressed full-text index over word numbers: Burrows-Wheeler transform in a wavelet tree, searched backward, many patterns at a time."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of a text sorted by their first ``depth`` symbols, by prefix doubling."""
    n = len(text)
    rank, reach = text.astype(np.int64), 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - reach] = rank[reach:] + 1 if reach < n else 0
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        reach *= 2
        if reach >= depth or new[-1] == n - 1:
            return order


class WaveletTree:
    """Rank of symbols in a sequence. Level by level, from the high bit, the sequence is split stably by one bit; bits are packed."""

    def __init__(self, sequence: np.ndarray):
        self.levels = max(1, int(sequence.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels):
            bit = (sequence >> (self.levels - 1 - level) & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1].astype(np.int32))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` ends up at the bottom: the place of the symbol's run there, plus its occurrences before ``at``."""
        at = at.astype(np.int64)
        for level in range(self.levels):
            block = at >> 6
            below = self.words[level][block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.before[level][block] + np.bitwise_count(below).astype(np.int64)
            at = np.where(symbols >> (self.levels - 1 - level) & 1, self.zeros[level] + ones, at - ones)
        return at


class FMIndex:
    """Counts occurrences of patterns of up to ``depth`` symbols from 1 on, in a text whose pieces each end in a 0."""

    def __init__(self, text: np.ndarray, depth: int):
        self.size = len(text)
        self.tree = WaveletTree(text[suffix_order(text, depth) - 1])
        counts = np.bincount(text)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.run = self.tree.rank(np.arange(len(counts)), np.zeros(len(counts), np.int64))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step of many searches: the suffix ranges of each pattern with a symbol put before it."""
        both = self.tree.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        shift = self.first[symbols] - self.run[symbols]
        return both[: len(symbols)] + shift, both[len(symbols) :] + shift

    def backward(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
        """For ranges [start, end) of a text, the smallest place from which the text up to ``end`` still occurs ``least`` times, but not below start."""
        place = end.copy()
        low, high = np.zeros(len(end), np.int64), np.full(len(end), self.size, np.int64)
        live = np.flatnonzero(place > start)
        while len(live):
            lo, hi = self.extend(text[place[live] - 1], low[live], high[live])
            ok = hi - lo >= least
            live, lo, hi = live[ok], lo[ok], hi[ok]
            place[live] -= 1
            low[live], high[live] = lo, hi
            live = live[place[live] > start[live]]
        return place


def repeated_ranges(index: FMIndex, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, least: int = 2) -> list[np.ndarray]:
    """(piece, start, end) of the maximal ranges of ``width`` or more symbols, inside given pieces of the text, that occur ``least`` times.

    A search that fails tells from where on a window can occur again, so the window jumps there. A search that
    succeeds is lengthened to the right by bisection; the next window is the first that ends beyond the range.
    """
    piece = np.arange(len(starts))
    s, good, bad = starts.copy(), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    found = []
    live = piece[s + width <= ends]
    while len(live):
        fresh = good[live] == 0
        whole = bad[live] == ends[live] + 1
        probe = np.where(fresh, s[live] + width, np.where(whole, ends[live], (good[live] + bad[live]) // 2))
        reached = index.backward(text, s[live], probe, least)
        hit = reached == s[live]
        s[live[fresh & ~hit]] = reached[fresh & ~hit]
        good[live[hit]] = probe[hit]
        first = live[fresh & hit]
        bad[first] = ends[first] + 1
        miss = live[~fresh & ~hit]
        bad[miss] = probe[~fresh & ~hit]
        # A range is settled when nothing lies between the longest success and the shortest failure.
        settled = live[(good[live] > 0) & ((bad[live] - good[live] == 1) | (good[live] == ends[live]))]
        if len(settled):
            found.append(np.column_stack([settled, s[settled], good[settled]]))
            s[settled] = good[settled] + 1 - width
            good[settled] = bad[settled] = 0
        live = live[s[live] + width <= ends[live]]
    return found
