"""Removal of word passages that occur in an earlier document, located by automata of repeated phrases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assayworks.llm import repeats
from assayworks.llm.arrowtext import SECOND, SPACE, Texts, spans_hashed, text_chunks
from assayworks.llm.repeats import Block, Runs, Symbols, Unit

SIZE, GRAM = 50, 10
RUNS_PER_TASK = 20_000


def plain_words(words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space after each: bytes, and where each kept word begins and ends there."""
    data = np.where(SPACE[words.data], np.uint8(0x20), words.data)
    marks = np.zeros(len(data) + 1, np.int8)
    begin, end = (words.start, words.end) if keep is None else (words.start[keep], words.end[keep])
    marks[begin] = 1
    marks[end + 1] -= 1
    inside = np.cumsum(marks, dtype=np.int8, out=marks)[:-1] > 0
    size = end - begin
    place = np.cumsum(size + 1) - size - 1
    return data[inside], place, place + size


def automaton_locator(gram: int) -> repeats.Locate:
    """Tells which runs have a repeated phrase for their anchor.

    The repeated phrases of a part of the block become one automaton, its shard of all of them, and the part's documents stream
    through it; a run counts if the automaton finds a phrase at its anchor's place, word for word.
    """
    def locate(texts: Texts, symbols: Symbols, runs: Runs, wanted: np.ndarray) -> np.ndarray:
        import ahocorasick

        data, begin, end = plain_words(symbols.table)
        likely = np.flatnonzero(np.isin(runs.anchor, wanted))
        if not len(likely):
            return np.zeros(len(runs.low), bool)
        _, one = np.unique(runs.anchor[likely], return_index=True)
        stream = data.tobytes().decode("latin-1")  # a character for each byte
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for place in runs.place[likely[one]].tolist():
            phrase = stream[begin[place]:end[place + gram - 1] + 1]
            automaton.add_word(phrase, len(phrase))
        automaton.make_automaton()
        starts = np.array([e + 1 - n for e, n in automaton.iter(stream)], np.int64)
        near = np.searchsorted(begin, starts)
        whole = begin[np.minimum(near, len(begin) - 1)] == starts
        hit = np.zeros(len(begin) + 1, bool)
        hit[near[whole]] = True
        return hit[runs.place]

    return locate


def resolved(runs: DataFrame, size: int, gram: int) -> DataFrame:
    """Windows of the given runs whose words start in a smaller document, as ranges; compared by 128 bits."""
    def run(table: pa.Table) -> pa.Table:
        owners, offsets, keys, others = [], [], [], []
        for part in text_chunks(table.column("body")):
            words = part.words()
            at = np.flatnonzero(words.text[: max(0, len(words.text) - size + 1)] == words.text[size - 1:]) \
                if len(words.text) >= size else np.zeros(0, np.int64)
            owners.append(part.rows[words.text[at]])
            offsets.append(at - words.first[words.text[at]])
            keys.append(spans_hashed(words.hashes(), at, at + size))
            others.append(spans_hashed(words.hashes(SECOND), at, at + size, SECOND))
        owner, offset, key, other = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (owners, offsets, keys, others))
        order = table.column("ord").to_numpy()[owner]
        by = np.lexsort((order, other, key))
        fresh = np.r_[True, (key[by][1:] != key[by][:-1]) | (other[by][1:] != other[by][:-1])][: len(by)]
        first = order[by][np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
        later = by[order[by] > first]
        return repeats.merged_windows(owner[later], offset[later], table, size)

    dealt, bucket = repeats.bucketed(runs, Unit(True, size, gram), RUNS_PER_TASK)
    return dealt.groupBy(bucket).applyInArrow(run, "block int, row int, low long, high long")


def without_repeated_passages(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """Removes each word covered by a window of ``size`` words that also starts in a document with a smaller doc_id.

    Words are runs of anything but space and the control characters from tab to carriage return, unchanged.
    Windows are judged on the input. Returns doc_id, n_words, n_removed and kept (the words that stay, joined
    by one space); one row per row. NULL and empty texts have no words. A NULL doc_id comes after all numbers;
    rows of NULL ids, like rows that repeat a doc_id, are not smaller than each other. Other columns are ignored.

    Phrases of ``gram`` words are confirmed to recur by a count over all documents. Each block of documents compiles
    its phrases into an automaton and streams its documents through it; what the automata find decides which
    windows are compared across blocks.
    """
    unit = Unit(True, size, gram)
    blocks = repeats.block_count(docs)
    common = repeats.common_anchors(docs, unit)
    anchors = repeats.repeated_anchors(docs, unit, blocks, common)
    found = repeats.occurrences(docs, unit, blocks, anchors, common, automaton_locator(gram))
    spans = repeats.judged(found, unit, lambda runs: resolved(runs, size, gram))

    def finish(block: Block, table: pa.Table) -> pa.Table:
        words = block.texts().words()
        gone = repeats.covered(words.first, table)
        data, begin, end = plain_words(words, ~gone)
        first = np.searchsorted(words.text[~gone], np.arange(len(block.orders) + 1))
        some = first[1:] > first[:-1]
        low = np.where(some, np.append(begin, 0)[first[:-1]], 0)
        high = np.where(some, np.append(end, 0)[first[1:] - 1], 0)
        removed = np.concatenate([[0], np.cumsum(gone)])
        kept = [data[a:b].tobytes() for a, b in zip(low, high, strict=True)]
        return pa.table({
            "doc_id": pa.array(block.orders, pa.int64(), mask=~block.known), "n_words": np.diff(words.first),
            "n_removed": removed[words.first[1:]] - removed[words.first[:-1]],
            "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return repeats.cut_out(docs, blocks, spans, finish, "doc_id long, n_words long, n_removed long, kept string")
