"""Texts of Arrow batches as byte arrays: words, word hashes and features without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

U = np.uint64
BASE, SECOND = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)
# Word boundaries: the space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least ``size`` of them; kept for the next call."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < size:
        longer = -(-size // 65_536) * 65_536
        ups, downs = np.full(longer, base), np.full(longer, U(pow(int(base), -1, 1 << 64)))
        ups[0] = downs[0] = 1
        _POWERS[int(base)] = known = (np.multiply.accumulate(ups), np.multiply.accumulate(downs))
    return known


def spans_hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hashes of values[start:end] that depend on the content only."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * base)


def grams_hashed(values: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """What spans_hashed gives for all runs of ``size`` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    out = sums[size:] - sums[:-size]
    out *= down[:n]
    out += U(size * int(base) % (1 << 64))
    return mixed(out)


class Texts:
    """Some texts of a batch. ``data`` holds a space before each text and one at the end.

    ``rows`` are their places in the batch, ``begin`` and ``end`` their places in ``data``.
    """

    def __init__(self, rows: np.ndarray, raw: np.ndarray, offsets: np.ndarray):
        n = len(rows)
        relative = offsets - offsets[0]
        self.rows = rows
        self.data = np.insert(raw[offsets[0]:offsets[-1]], relative, np.uint8(0x20))
        self.begin = relative[:-1] + np.arange(1, n + 1)
        self.end = relative[1:] + np.arange(1, n + 1)

    def words(self, lower: bool = False) -> Words:
        return Words(self, LOWER[self.data] if lower else self.data)


class Words:
    """Words of some texts in order: byte ranges [start, end) and the text each lies in."""

    def __init__(self, texts: Texts, data: np.ndarray):
        space = SPACE[data]
        self.data = data
        self.start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        self.text = np.searchsorted(texts.begin, self.start, "right") - 1
        # Words of text i are first[i] to first[i + 1].
        self.first = np.searchsorted(self.text, np.arange(len(texts.rows) + 1))

    def hashes(self, base: np.uint64 = BASE) -> np.ndarray:
        return spans_hashed(BYTE_VALUES[self.data], self.start, self.end, base)


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), places


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, in parts of about ``limit`` bytes; a longer text is a part of its own."""
    raw, offsets = text_arrays(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield Texts(np.arange(low, high), raw, offsets[low:high + 1])
        low = high
