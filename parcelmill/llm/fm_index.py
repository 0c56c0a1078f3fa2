"""FM-index over word sequences, and matching statistics above a threshold."""

from __future__ import annotations

import numpy as np

from parcelmill.llm.words import ragged


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols, by prefix doubling.

    Equal beginnings stay in any order: the intervals of patterns of up to ``depth`` symbols do not
    depend on it.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    packed = max(1, min(depth, 62 // bits, n))
    rank = np.zeros(n, np.int64)
    for i in range(packed):
        rank <<= bits
        rank[: n - i] += symbols[i:]
    have, order = packed, np.argsort(rank)
    while True:
        ordered = rank[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if have >= depth or dense[order[-1]] == n - 1:
            return order
        follow = np.zeros(n, np.int64)
        follow[: n - have] = dense[have:] + 1
        rank = dense * (n + 1) + follow
        order = np.argsort(rank)
        have *= 2


class WaveletTree:
    """Symbols by bit levels, most significant first, each level packed to one bit a symbol plus counts.

    ``place(c, i)`` leads a position down the levels along the bits of ``c``; the difference of two places
    is how often ``c`` stands between them.
    """

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        n, now = len(symbols), symbols.astype(np.int64)
        self.packed, self.before, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (now >> level) & 1 == 1
            words = np.zeros((n >> 6) + 1, np.uint64)
            words.view(np.uint8)[: (n + 7) // 8] = np.packbits(bit, bitorder="little")
            self.packed.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(n - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))

    def place(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (words, before, zeros) in enumerate(zip(self.packed, self.before, self.zeros)):
            block = i >> 6
            part = words[block] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[block] + np.bitwise_count(part).astype(np.int64)
            i = np.where((c >> (self.levels - 1 - k)) & 1 == 1, zeros + ones, i - ones)
        return i


class FMIndex:
    """Index of a run of symbols that answers for patterns of up to ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, depth: int):
        order = suffix_order(symbols, depth)
        self.tree = WaveletTree(symbols[order - 1])  # the symbol before each suffix; the first one's is the last
        self.n, size = len(symbols), int(symbols.max(initial=0)) + 1
        smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=size))))[:-1]
        every = np.arange(size)
        self.shift = smaller - self.tree.place(every, np.zeros(size, np.int64))

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``c`` put before them: one step of backward search."""
        both = self.tree.place(np.concatenate((c, c)), np.concatenate((lo, hi)))
        shift = self.shift[c]
        return shift + both[: len(c)], shift + both[len(c) :]


def match_back(index: FMIndex, symbols: np.ndarray, least: np.ndarray, end: np.ndarray, times: int) -> np.ndarray:
    """How far left each span ending at ``end`` reaches before it occurs fewer than ``times`` times.

    Returns the first place of the longest such span, no less than ``least``: the matching statistic
    at ``end``.
    """
    place = end.copy()
    lanes = np.flatnonzero(place > least)
    lo, hi = np.zeros(len(lanes), np.int64), np.full(len(lanes), index.n, np.int64)
    while len(lanes):
        lo, hi = index.extend(symbols[place[lanes] - 1], lo, hi)
        on = hi - lo >= times
        lanes, lo, hi = lanes[on], lo[on], hi[on]
        place[lanes] -= 1
        on = place[lanes] > least[lanes]
        lanes, lo, hi = lanes[on], lo[on], hi[on]
    return place


def repeated_windows(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For each span's windows of ``length`` symbols (``counts`` of them from ``starts`` on): does it occur twice?

    Ranges of undecided windows are matched from the end of their last one. A long match decides all
    windows in it; after a short one, those to the left of the mismatch are matched as a range of their
    own, and those over it are tried from the left, where a mismatch rules out every window up to it.
    """
    offset = np.concatenate(([0], np.cumsum(counts)))
    found = np.zeros(offset[-1], bool)
    span = np.arange(len(starts))
    first, last, single = starts.copy(), starts + counts - 1, np.zeros(len(starts), bool)
    while len(span):
        stop = np.where(single, first, last) + length
        place = match_back(index, symbols, first, stop, 2)
        # windows inside the match
        begin, end = np.maximum(place, first), stop - length
        inside = np.maximum(end - begin + 1, 0)
        found[ragged(offset[span] + begin - starts[span], inside)] = True
        miss = place - 1  # where the match broke off; below first if it did not
        left = np.where(single, np.where(inside > 0, first + 1, miss + 1), first)
        right = np.where(single, last, np.minimum(miss, end - 1))
        again = np.where(single, inside == 0, False)
        short = ~single & (miss >= end)
        cut = np.clip(miss - length, left - 1, right)  # last window left of the mismatch
        spans = [(span, left, np.where(short, cut, right), again), (span[short], cut[short] + 1, right[short], np.ones(short.sum(), bool))]
        span, first, last, single = (np.concatenate(x) for x in zip(*spans))
        todo = first <= last
        span, first, last, single = span[todo], first[todo], last[todo], single[todo]
    return found
