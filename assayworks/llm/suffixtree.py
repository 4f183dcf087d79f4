"""Suffix trees of integer sequences, with longest common extensions answered in constant time."""

from __future__ import annotations

import numpy as np

END = 0


def ukkonen(symbols: list[int], sigma: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix tree of a sequence that ends with a symbol of its own, built left to right in linear time.

    Returns parent, first symbol and length of the edge into every node; node 0 is the root.
    """
    n = len(symbols)
    start, stop, link, child = [0], [0], [0], {}
    node = edge = length = waiting = 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        fresh = 0  # the inner node that still lacks its suffix link
        while waiting:
            if not length:
                edge = i
            key = node * sigma + symbols[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                width = stop[below] - start[below]
                if length >= width:
                    edge += width
                    length -= width
                    node = below
                    continue
                cut = start[below] + length
                if symbols[cut] == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                start += (start[below], i)
                stop += (cut, n)
                link += (0, 0)
                start[below] = cut
                child[key] = inner
                child[inner * sigma + symbol] = inner + 1
                child[inner * sigma + symbols[cut]] = below
                if fresh:
                    link[fresh] = inner
                fresh = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    parent, symbol = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    parent[nodes], symbol[nodes] = keys // sigma, keys % sigma
    return parent, symbol, np.array(stop, np.int64) - np.array(start, np.int64)


def tour(parent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Nodes in the order of a walk from the root that takes the children of a node by rank."""
    order = np.lexsort((-rank[1:], parent[1:])) + 1
    first = np.searchsorted(parent[order], np.arange(len(parent) + 1)).tolist()
    kids = order.tolist()
    stack, seen = [0], []
    while stack:
        v = stack.pop()
        seen.append(v)
        stack += kids[first[v]:first[v + 1]]
    return np.array(seen, np.int64)


class SuffixTree:
    """The tree of ``symbols`` (positive integers below ``sigma``) and an end symbol.

    The lowest common ancestor of two leaves lies where the walk between them is nearest to the root, so the extension of
    two suffixes is the least parent depth between their leaves; a table over the walk answers that for any stretch.
    """

    def __init__(self, symbols: np.ndarray, sigma: int):
        n = len(symbols)
        self.parent, self.symbol, width = ukkonen([*symbols.tolist(), END], sigma)
        self.sigma = sigma
        walk = tour(self.parent, self.symbol)
        parents, widths = self.parent[walk].tolist(), width[walk].tolist()
        depth = [0] * len(walk)
        for v, p, w in zip(walk.tolist()[1:], parents[1:], widths[1:], strict=True):
            depth[v] = depth[p] + w
        depth = np.array(depth, np.int64)
        inner = np.zeros(len(walk), bool)
        inner[self.parent] = True
        self.suffix = np.where(inner, -1, n + 1 - depth)  # where the suffix of a leaf begins
        self.walk = walk
        leaf = np.flatnonzero(~inner[walk])
        self.place = np.zeros(n + 1, np.int64)
        self.place[self.suffix[walk[leaf]]] = leaf
        self.least = [depth[self.parent[walk]].astype(np.int32)]
        step = 1
        while 2 * step <= len(walk):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def ranks(self, backward: bool = False) -> np.ndarray:
        """The rank of every suffix, the empty one included; ``backward`` turns the order of all symbols but the end."""
        if backward:
            symbol = np.where(self.symbol == END, END, self.sigma - self.symbol)
            walk = tour(self.parent, symbol)
        else:
            walk = self.walk
        starts = self.suffix[walk]
        starts = starts[starts >= 0]
        rank = np.empty(len(starts), np.int64)
        rank[starts] = np.arange(len(starts))
        return rank

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, which differ pairwise."""
        x, y = self.place[a], self.place[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.least[k][low[at]], self.least[k][high[at] - (1 << int(k))])
        return out
