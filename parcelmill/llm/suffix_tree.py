"""Suffix trees of short integer sequences: Ukkonen's construction, and common prefixes by lowest common ancestors."""

from __future__ import annotations

import numpy as np

BLOCK = 16  # entries of the tour whose minimum is kept in the table


def ukkonen(symbols: list[int]) -> tuple[list[int], list[int], list[int], dict[tuple[int, int], int]]:
    """The suffix tree of ``symbols``, the last of which must stand nowhere else.

    Of each node: where its edge's label begins and ends in ``symbols``, and its parent; and the children by
    (node, first symbol). Node 0 is the root; a leaf's label ends at the end of the sequence. Online, one symbol after
    the other, with suffix links; the active point is (node, label begin, length).
    """
    n = len(symbols)
    begin, end, parent, link = [0], [0], [0], [0]
    child: dict[tuple[int, int], int] = {}
    node = at = length = waiting = 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        last = 0  # inner node made in this round that still wants its suffix link
        while waiting:
            if not length:
                at = i
            edge = child.get((node, symbols[at]))
            if edge is None:
                child[node, symbols[at]] = len(begin)
                begin.append(i), end.append(n), parent.append(node), link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                label = end[edge] - begin[edge]
                if length >= label:  # walk down
                    at += label
                    length -= label
                    node = edge
                    continue
                if symbols[begin[edge] + length] == symbol:  # already there
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(begin)
                begin.append(begin[edge]), end.append(begin[edge] + length), parent.append(node), link.append(0)
                child[node, symbols[at]] = split
                child[split, symbol] = split + 1
                begin.append(i), end.append(n), parent.append(split), link.append(0)
                begin[edge] += length
                parent[edge] = split
                child[split, symbols[begin[edge]]] = edge
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - waiting + 1
    return begin, end, parent, child


class LongestCommon:
    """Lengths of the common prefixes of suffixes of a sequence, in constant time each, and the order of the suffixes."""

    def __init__(self, symbols: list[int]):
        """Symbols are positive; the end counts as smaller than all of them."""
        text = [*symbols, 0]
        begin, end, parent, child = ukkonen(text)
        nodes, n = len(begin), len(text)
        label = np.array(end) - np.array(begin)
        keys = np.array(list(child), np.int64).reshape(-1, 2)
        order = np.lexsort((-keys[:, 1], keys[:, 0]))  # the largest first, as a stack takes the last
        targets = np.array(list(child.values()))[order].tolist()
        bounds = np.searchsorted(keys[order, 0], np.arange(nodes + 1)).tolist()
        depth, length = [0] * nodes, label.tolist()
        tour, first, leaves = [], [0] * nodes, []  # string depths along the Euler tour; first visits
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at a parent
                tour.append(depth[~v])
                continue
            a, b = bounds[v], bounds[v + 1]
            if v:
                depth[v] = depth[parent[v]] + length[v]
            first[v] = len(tour)
            tour.append(depth[v])
            if a == b:
                leaves.append(v)
            for w in targets[a:b]:
                stack.append(~v)
                stack.append(w)
        suffix = n - np.array(depth)[leaves]  # in lexicographic order
        self.rank = np.empty(n, np.int64)
        self.rank[suffix] = np.arange(n)
        self.first = np.empty(n, np.int64)
        self.first[suffix] = np.array(first)[leaves]
        self._table(np.array(tour, np.int32))

    def _table(self, tour: np.ndarray) -> None:
        """Least depths: to the left and right within each block of the tour, and over powers of two of blocks."""
        blocks = -(-len(tour) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(tour)] = tour
        self.tour = padded
        square = padded.reshape(blocks, BLOCK)
        self.ahead = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()  # from here to the block's end
        self.behind = np.minimum.accumulate(square, axis=1).ravel()  # from the block's start to here
        self.levels = [square.min(axis=1)]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            below, step = self.levels[-1], 1 << (len(self.levels) - 1)
            above = below.copy()
            above[: len(below) - step] = np.minimum(below[: len(below) - step], below[step:])
            self.levels.append(above)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b`` (places up to the end, unequal)."""
        x, y = self.first[a], self.first[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        p, q = x // BLOCK, y // BLOCK
        out = np.minimum(self.ahead[x], self.behind[y])
        between = q - p - 1
        for k, level in enumerate(self.levels):
            some = np.flatnonzero((between >= 1 << k) & (between < 2 << k))
            if len(some):
                ends = np.minimum(level[p[some] + 1], level[q[some] - (1 << k)])
                out[some] = np.minimum(out[some], ends)
        inside = np.flatnonzero(p == q)
        if len(inside):
            low, high = x[inside], y[inside]
            least = self.tour[low].copy()
            for k in range(1, BLOCK):
                np.minimum(least, self.tour[np.minimum(low + k, high)], out=least)
            out[inside] = least
        return out
