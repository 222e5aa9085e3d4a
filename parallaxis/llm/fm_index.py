"""A compressed FM-index over integer sequences, in numpy.

The text is a row of segments parted by separators (symbol 0), which are told
apart by their place, so no suffix is compared beyond its segment. Kept are
the transform as a wavelet matrix (one packed bit per symbol and level, with
counts for every 64 bits) and, in place of the suffix array, the segment of
every fourth position and of each segment's first one: from any other row,
steps back through the transform lead to one of these within its segment.
"""

from __future__ import annotations

import numpy as np


class BitRow:
    """A packed row of bits with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bits.dtype)]), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)[:-1]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The bits at ``at``."""
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class FMIndex:
    """Backward search over ``text`` (int array, 0 parts segments, symbols from 1)."""

    #: One position in so many keeps its segment.
    STEP = 4

    def __init__(self, text: np.ndarray):
        n = len(text)
        parts = text == 0
        rank = text.astype(np.int64) + int(parts.sum())
        rank[parts] = np.arange(parts.sum())
        order, width = np.argsort(rank, kind="stable"), 0
        while n:
            sorted_key = rank[order]
            rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            if rank[order[-1]] == n - 1:
                break
            width = width * 2 or 1
            shifted = np.zeros(n, np.int64)
            shifted[: max(n - width, 0)] = rank[width:] + 1
            rank = rank * (n + 2) + shifted
            order = np.argsort(rank, kind="stable")
        starts = np.concatenate([[True], parts[:-1]]) if n else parts
        kept = starts | (np.arange(n) % self.STEP == 0)
        self.marks = BitRow(kept[order].astype(np.uint8))
        self.segments = (np.cumsum(starts) - 1).astype(np.int32)[order[kept[order]]]
        self.size = n
        self.top = int(text.max()) + 1 if n else 1
        counts = np.bincount(text, minlength=self.top)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        row = text[order - 1] if n else text
        self.levels, self.zeros = [], []
        symbols = np.arange(self.top)
        begin = np.zeros(self.top, np.int64)
        for shift in range(max(1, int(self.top - 1).bit_length()) - 1, -1, -1):
            bits = ((row >> shift) & 1).astype(np.uint8)
            level, zeros = BitRow(bits), int(n - bits.sum())
            self.levels.append((shift, level))
            self.zeros.append(zeros)
            ones = level.rank(begin)
            begin = np.where((symbols >> shift) & 1, zeros + ones, begin - ones)
            row = np.concatenate([row[bits == 0], row[bits == 1]])
        self.begin = begin  # where each symbol starts in the last level

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Intervals of the pattern with ``symbol`` put in front."""
        at = np.concatenate([lo, hi])
        both = np.concatenate([symbol, symbol])
        for (shift, level), zeros in zip(self.levels, self.zeros, strict=True):
            ones = level.rank(at)
            at = np.where((both >> shift) & 1, zeros + ones, at - ones)
        base = self.first[symbol] - self.begin[symbol]
        half = len(lo)
        return at[:half] + base, at[half:] + base

    def back(self, at: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one symbol longer than those of rows ``at``."""
        symbol = np.zeros(len(at), np.int64)
        for (shift, level), zeros in zip(self.levels, self.zeros, strict=True):
            bit, ones = level.get(at), level.rank(at)
            symbol |= bit.astype(np.int64) << shift
            at = np.where(bit, zeros + ones, at - ones)
        return at + self.first[symbol] - self.begin[symbol]

    def segment(self, rows: np.ndarray) -> np.ndarray:
        """The segment (counted from 0) that each row's suffix begins in; rows of separators excepted."""
        out, left, at = np.empty(len(rows), np.int32), np.arange(len(rows)), rows
        while len(left):
            hit = self.marks.get(at)
            out[left[hit]] = self.segments[self.marks.rank(at[hit])]
            left, at = left[~hit], at[~hit]
            if len(left):
                at = self.back(at)
        return out

    def matching(self, text: np.ndarray, ends: np.ndarray, threshold: int, single: int = 1):
        """Matching statistics against the index, cut at ``threshold``.

        For each streamed position ``end`` (exclusive) in ``text``, extends
        backwards while the interval holds more than ``single`` suffixes:
        returns which ends reach ``threshold`` symbols and their intervals.
        """
        alive = np.arange(len(ends))
        symbol = text[ends - 1]
        lo, hi = self.first[symbol], self.first[symbol + 1]
        for k in range(2, threshold + 1):
            keep = hi - lo > single
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
            if not len(alive):
                break
            lo, hi = self.step(text[ends[alive] - k], lo, hi)
        keep = hi - lo > single
        return alive[keep], lo[keep], hi[keep]
