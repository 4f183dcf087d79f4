"""Removal of byte strings that occur earlier in the collection, by suffix order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assayworks.llm import repeats
from assayworks.llm.arrowtext import BYTE_VALUES, mixed, spans_hashed, text_arrays
from assayworks.llm.repeats import Block, Unit
from assayworks.llm.suffixes import repeated_windows

SIZE, GRAM = 100, 24
RUNS_PER_TASK = 8_000
STEP = 4


def likely_parts(data: np.ndarray, first: np.ndarray, at: np.ndarray, anchor: np.ndarray, size: int,
                 gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that can share a window with another run of their anchor, and the part [low, high) of each that can.

    A shared window reaches some way before the anchor and the rest behind it. For each reach in steps
    of STEP, runs are compared by the bytes that all windows of that step hold.
    """
    extra = size - gram
    length = np.diff(first)
    least, most = np.full(len(at), size, np.int64), np.full(len(at), -1, np.int64)
    values = BYTE_VALUES[data]
    for before in range(0, extra + 1, STEP):
        behind = max(0, extra - before - STEP + 1)
        able = np.flatnonzero((at >= before) & (at + gram + behind <= length))
        begin = first[able] + at[able] - before
        key = spans_hashed(values, begin, begin + before + gram + behind) ^ mixed(anchor[able].view(np.uint64))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        shared = able[count[which] > 1]
        least[shared] = np.minimum(least[shared], before)
        most[shared] = np.maximum(most[shared], before + STEP - 1)
    keep = np.flatnonzero(most >= 0)
    low = np.maximum(0, at[keep] - most[keep])
    high = np.minimum(length[keep], at[keep] + gram + extra - least[keep])
    return keep, low, high


def resolved(runs: DataFrame, size: int, gram: int) -> DataFrame:
    """Windows of the given runs that occur earlier, as ranges: a suffix order of the runs of each bucket of anchors."""
    def run(table: pa.Table) -> pa.Table:
        data, first = text_arrays(table.column("body"))
        data, first = data[first[0]:first[-1]], first - first[0]
        keep, low, high = likely_parts(data, first, table.column("at").to_numpy().astype(np.int64),
                                       table.column("anchor").to_numpy(), size, gram)
        _, document = np.unique(table.column("ord").to_numpy()[keep], return_inverse=True)
        start = table.column("start").to_numpy()[keep] + low
        parts = np.concatenate([data[:0], *(data[a:b] for a, b in zip(first[keep] + low, first[keep] + high, strict=True))])

        def place(owner: np.ndarray, offset: np.ndarray) -> np.ndarray:
            return document[owner].astype(np.int64) * (1 << 40) + start[owner] + offset

        owner, offset = repeated_windows(parts, np.concatenate([[0], np.cumsum(high - low)]), size, place)
        return repeats.merged_windows(keep[owner], low[owner] + offset, table, size)

    dealt, bucket = repeats.bucketed(runs, Unit(False, size, gram), RUNS_PER_TASK)
    return dealt.groupBy(bucket).applyInArrow(run, "block int, row int, low long, high long")


def without_repeated_bytes(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """Removes each byte covered by a ``size``-byte string that also starts earlier.

    Earlier means a smaller doc_id, or the same document and a smaller start. Strings are judged on the input.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary: a cut may split a
    character); one row per row. NULL and empty texts have no bytes. Texts of NULL ids come after all
    others, and are not compared with each other's as earlier or later, nor are rows that repeat a doc_id unless
    by their starts. Texts shorter than ``size`` are never cut. Other columns are ignored.

    Strings can only be equal where an anchor is; runs of windows with the same anchor and content are settled by
    aggregation. Where contents under an anchor differ (the edges of copied passages), a column-wise transform of the
    parts that they may share, with common prefixes, finds the equal strings. A transform of the whole collection would take a pass over all text
    for every byte of the longest document; a run has less than 2 * size bytes.
    """
    unit = Unit(False, size, gram)
    blocks = repeats.block_count(docs)
    common = repeats.common_anchors(docs, unit)
    anchors = repeats.repeated_anchors(docs, unit, blocks, common)
    found = repeats.occurrences(docs, unit, blocks, anchors, common, repeats.by_hash)
    spans = repeats.judged(found, unit, lambda runs: resolved(runs, size, gram))

    def finish(block: Block, table: pa.Table) -> pa.Table:
        gone = repeats.covered(block.offsets, table)
        removed, spans, kept = [], [], []
        for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True):
            own = gone[a:b]
            removed.append(int(np.count_nonzero(own)))
            spans.append(int(np.count_nonzero(own[1:] & ~own[:-1])) + int(b > a and own[0]))
            kept.append(block.data[a:b][~own].tobytes())
        return pa.table({
            "doc_id": pa.array(block.orders, pa.int64(), mask=~block.known), "n_bytes": block.sizes,
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return repeats.cut_out(docs, blocks, spans, finish,
                           "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
