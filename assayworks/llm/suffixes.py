"""Burrows-Wheeler transform and common prefixes of many short strings, built column by column through files."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

import numpy as np

END = 0


class Column:
    """An array in a file that is read from front to back and written anew from front to back. It never shrinks."""

    def __init__(self, folder: str, name: str, kind: type):
        self.kind = kind
        self.file = open(os.path.join(folder, name), "w+b")  # noqa: SIM115

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, self.kind)

    def write(self, values: np.ndarray) -> None:
        self.file.seek(0)
        values.astype(self.kind, copy=False).tofile(self.file)
        self.file.flush()

    def close(self) -> None:
        self.file.close()


def _merge(old: np.ndarray, stay: np.ndarray, places: np.ndarray, new: np.ndarray) -> np.ndarray:
    out = np.empty(len(stay), old.dtype)
    out[stay] = old
    out[places] = new
    return out


def _bucket_ranks(transform: np.ndarray, order: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where places come in the stable order of all symbols."""
    starts = np.concatenate([[0], np.cumsum(np.bincount(transform, minlength=256))])
    symbols = transform[places]
    ranks = np.empty(len(places), np.int64)
    for c in np.unique(symbols):
        own = np.flatnonzero(symbols == c)
        ranks[own] = starts[c] + np.searchsorted(order[starts[c]:starts[c + 1]], places[own])
    return ranks


def _lowest(prefixes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least common prefix in (low, high], for descending high."""
    if not len(low):
        return np.zeros(0, prefixes.dtype)
    pairs = np.column_stack([low + 1, high + 1]).ravel()
    return np.minimum.reduceat(np.append(prefixes, prefixes.dtype.type(0)), pairs)[::2]


def suffix_order(data: np.ndarray, first: np.ndarray,
                 folder: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of strings data[first[i]:first[i + 1]] (bytes below 255): string, offset, common prefix with the one before.

    In each round every string that is not used up hands in the symbol before its last inserted suffix, and
    with it a new suffix. Its place follows from counting symbols in the transform so far; its common prefixes with
    both neighbours are one more than the least between them in the round before. Transform and
    prefixes are read and rewritten in order. Equal suffixes come in order of their strings. Prefixes
    of over 65,535 symbols are given as that.
    """
    strings = len(first) - 1
    sizes = np.diff(first)
    kind = np.uint8 if sizes.max(initial=0) < 255 else np.uint16
    with tempfile.TemporaryDirectory(dir=folder) as place:
        transform, prefixes = Column(place, "transform", np.uint8), Column(place, "prefixes", kind)

        def before(which: np.ndarray, done: int) -> np.ndarray:
            """The symbol before the suffix of length ``done`` of some strings."""
            more = sizes[which] > done
            at = np.where(more, first[which + 1] - 1 - done, 0)
            return np.where(more, data[at].astype(np.int64) + 1, END).astype(np.uint8) if len(data) else np.zeros(len(which), np.uint8)

        active, at = np.arange(strings), np.arange(strings)
        transform.write(before(active, 0))
        prefixes.write(np.zeros(strings, kind))
        for done in range(int(sizes.max(initial=0))):
            b, lcp = transform.read(), prefixes.read()
            more = sizes[active] > done
            active, at = active[more], at[more]
            down = np.argsort(-at, kind="stable")
            active, at = active[down], at[down]
            order = np.argsort(b, kind="stable")
            rank = _bucket_ranks(b, order, at)
            ended = int(np.count_nonzero(b == END))
            new = strings + rank - ended
            has = (rank > 0) & (b[order[np.maximum(rank - 1, 0)]] == b[at])
            up = np.zeros(len(at), np.int64)
            up[has] = np.minimum(_lowest(lcp, order[rank[has] - 1], at[has]).astype(np.int64) + 1, 65_535)
            last = len(order) - 1
            follows = (rank < last) & (b[order[np.minimum(rank + 1, last)]] == b[at])
            behind = order[rank[follows] + 1]
            turn = np.argsort(-behind, kind="stable")
            under = np.minimum(_lowest(lcp, at[follows][turn], behind[turn]).astype(np.int64) + 1, 65_535)
            sorted_new = np.argsort(new, kind="stable")
            stay = np.ones(len(b) + len(new), bool)
            stay[new] = False
            b = _merge(b, stay, new[sorted_new], before(active[sorted_new], done + 1))
            lcp = _merge(lcp, stay, new[sorted_new], up[sorted_new].astype(kind))
            lcp[new[follows][turn] + 1] = under
            transform.write(b)
            prefixes.write(lcp)
            at = new
        b, lcp = transform.read(), prefixes.read()
        transform.close()
        prefixes.close()
    return (*_located(b, sizes), lcp)


def _located(transform: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """String and offset of every suffix, by walking all strings back from their ends at once."""
    strings = len(sizes)
    owner, offset = np.empty(len(transform), np.int64), np.empty(len(transform), np.int64)
    order = np.argsort(transform, kind="stable")
    step = np.empty(len(transform), np.int64)
    step[order] = np.arange(len(transform)) + strings - np.count_nonzero(transform == END)
    active, at = np.arange(strings), np.arange(strings)
    for done in range(int(sizes.max(initial=0)) + 1):
        owner[at], offset[at] = active, sizes[active] - done
        more = sizes[active] > done
        active, at = active[more], step[at[more]]
    return owner, offset


def repeated_windows(data: np.ndarray, first: np.ndarray, size: int,
                     place: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """String and offset of windows of ``size`` bytes that also start at an earlier place.

    ``place`` gives an orderable number for strings and offsets; equal numbers are the same place.
    """
    owner, offset, lcp = suffix_order(data, first)
    equal = lcp >= size
    near = equal | np.r_[equal[1:], False]
    ranks = np.flatnonzero(near)
    if not len(ranks):
        return ranks, ranks
    group = np.cumsum(~equal)[ranks]
    where = place(owner[ranks], offset[ranks])
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.minimum.reduceat(where, begin)
    later = where > np.repeat(least, np.diff(np.r_[begin, len(group)]))
    return owner[ranks[later]], offset[ranks[later]]
