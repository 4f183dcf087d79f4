"""Benchmark passages in training documents: n-gram seeds counted in windows, then local alignment of words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.arrowtext import SECOND, Texts, Words, spans_hashed, text_chunks
from assayworks.llm.shared import free_name, mapped_rows, written

GRAM = 3
SEEDS_PER_BLOCK = 200_000
MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.6


@dataclass(frozen=True)
class Items:
    """Benchmark items of a block: ids, word hashes, and the seeds: hash, item, word place, all sorted by hash.

    ``sizes`` are the seeds' lengths in words. An alignment of the score hits ``need[item]`` of the item's seeds
    within ``width[item]`` words; before and after the place of a seed it goes on for ``slack[item]`` words more than the item.
    """

    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sizes: list[int]
    need: np.ndarray
    width: np.ndarray
    slack: np.ndarray


def seed_size(length: int, n: int, least: float) -> tuple[int, int]:
    """The most words, up to ``n``, of which every alignment of the score has an intact gram, and how many it has at least.

    Of m matched words and e mismatches and gaps the score is 2m - e, so e <= 2m - 2 * least * length. Errors cut the matches
    into e + 1 runs at most, and a run lacks k - 1 grams of k words: m - (k - 1)(e + 1) are intact. For k > 1 that is least at
    m = length, for single words at m = least * length.
    """
    for k in range(min(n, length), 1, -1):
        intact = math.ceil(length - (k - 1) * (2 * length * (1 - least) + 1) - 1e-9)
        if intact > 0:
            return k, intact
    return 1, max(1, math.ceil(least * length - 1e-9))


def plain(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words and their hashes, A to Z lower-cased, without ASCII punctuation at either end."""
    words = texts.words(lower=True)
    start, end = words.start.copy(), words.end.copy()
    for _ in range(int((end - start).max(initial=0))):
        front = (end - start > 1) & PUNCTUATION[words.data[start]]
        start += front
        back = (end - start > 1) & PUNCTUATION[words.data[end - 1]]
        end -= back
        if not front.any() and not back.any():
            break
    words.start, words.end = start, end
    return words, words.hashes()


PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def grams_of(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside texts, and the places of their first words."""
    at = np.flatnonzero(words.text[: max(0, len(hashes) - n + 1)] == words.text[n - 1:]) if len(hashes) >= n \
        else np.zeros(0, np.int64)
    return spans_hashed(hashes, at, at + n, SECOND), at


def _plain(benchmark: DataFrame) -> DataFrame:
    return benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").selectExpr(
        "cast(item_id AS long) AS item_id", "cast(text AS string) AS text")


def _document_frequency(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """In how many documents each wanted gram occurs, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for part in text_chunks(batch.column(0)):
                words, hashes = plain(part)
                for n in sizes:
                    grams, at = grams_of(words, hashes, n)
                    near = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
                    hit = wanted[near] == grams
                    pairs = np.unique(words.text[at[hit]] * len(wanted) + near[hit])
                    counts += np.bincount(pairs % len(wanted), minlength=len(wanted))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(counts[some])], ["gram", "n"])

    found = docs.selectExpr("cast(text AS string) AS text").mapInArrow(run, "gram long, n long")
    return {r[0]: r[1] for r in found.groupBy("gram").agg(F.sum("n")).collect()}


def _blocks(benchmark: DataFrame, docs: DataFrame, n: int, least: float) -> Iterator[Items]:
    """The benchmark in blocks of about SEEDS_PER_BLOCK words, each with the seeds of its items.

    All grams of an item are seeds but some of those in the most documents: of ``intact`` grams that every alignment has, less
    than half can be among them, and as many hits fewer are needed.
    """
    table = written(_plain(benchmark).distinct(), "items")
    total = table.agg(F.sum(F.size(F.split("text", "[ \\t-\\r]+")))).first()[0] or 0
    parts = max(1, -(-total // SEEDS_PER_BLOCK))
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part
        texts = sorted(tuple(r) for r in table.filter(mine).collect())
        if not texts:
            continue
        words, hashes = plain(next(text_chunks(pa.array([t for _, t in texts]), 1 << 40)))
        lengths = np.diff(words.first)
        size, intact = np.array([seed_size(int(x), n, least) for x in lengths]).T
        sizes = sorted({int(k) for k in size[lengths > 0]})
        if not sizes:
            continue
        grams, at = map(np.concatenate, zip(*[(g[own], a[own]) for k in sizes for g, a in [grams_of(words, hashes, k)]
                                              for own in [size[words.text[a]] == k]], strict=True))
        item = words.text[at]
        found = _document_frequency(docs, np.unique(grams), sizes)
        often = np.array([found.get(int(g), 0) for g in grams.view(np.int64)])
        left_out = (intact - 1) // 2
        by = np.lexsort((at, -often, item))
        rank = np.arange(len(by)) - np.searchsorted(item[by], item[by])
        seed = by[rank >= left_out[item[by]]]
        seed = seed[np.argsort(grams[seed], kind="stable")]
        slack = np.maximum(lengths, np.ceil(2 * (1 - least) * lengths).astype(np.int64))
        yield Items([i for i, _ in texts], [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)],
                    grams[seed], item[seed], (at - words.first[item])[seed], sizes, intact - left_out, lengths + slack, slack)


def aligned(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman over words: best local score as a share of the item's own, and the span in the passage."""
    n = len(passage)
    steps = np.arange(n + 1) * GAP
    above, begin_above = np.zeros(n + 1), np.arange(n + 1)
    best, span = 0.0, (0, 0)
    for word in item:
        score = np.where(passage == word, MATCH, MISMATCH)
        cell = np.zeros(n + 1)
        begin = np.arange(n + 1)
        diagonal, up = above[:-1] + score, above[1:] + GAP
        cell[1:] = np.maximum(np.maximum(diagonal, up), 0)
        begin[1:] = np.where(cell[1:] <= 0, begin[1:], np.where(diagonal >= up, begin_above[:-1], begin_above[1:]))
        # Gaps in the item: a running maximum along the passage.
        lifted = cell - steps
        ahead = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= ahead, np.arange(n + 1), 0))
        cell, begin = ahead + steps, begin[source]
        k = int(cell.argmax())
        if cell[k] > best:
            best, span = float(cell[k]), (int(begin[k]), k)
        above, begin_above = cell, begin
    return best / (MATCH * max(1, len(item))), *span


def _passages(places: np.ndarray, length: int, slack: int) -> Iterator[tuple[int, int]]:
    """Ranges of words around seeds; near seeds share one."""
    low = high = -1
    for p in np.sort(places):
        if high >= 0 and p <= high:
            high = max(high, int(p) + length + slack)
            continue
        if high >= 0:
            yield low, high
        low, high = int(p) - slack, int(p) + length + slack
    if high >= 0:
        yield low, high


def _best(hashes: np.ndarray, places: np.ndarray, item: np.ndarray, slack: int, least: float) -> tuple[float, int, int]:
    best = (0.0, 0, 0)
    size = len(item)
    for low, high in _passages(places, size, slack):
        low, high = max(0, low), min(len(hashes), high)
        for at in range(low, high, 8 * size):  # long passages in overlapping parts
            upto = min(high, at + 9 * size + slack)
            if np.isin(item, hashes[at:upto]).sum() >= least * size - 1e-9:  # else the score is out of reach
                score, a, b = aligned(item, hashes[at:upto])
                if score > best[0]:
                    best = (score, at + a, at + b)
            if upto == high:
                break
    return best


def _hits(words: Words, hashes: np.ndarray, items: Items) -> Iterator[tuple[int, int, np.ndarray]]:
    """Text, item and where in the text the item would begin, by all seed hits that have as many others near as an
    alignment of the score needs."""
    found = []
    for n in items.sizes:
        grams, at = grams_of(words, hashes, n)
        low = np.searchsorted(items.seeds, grams, "left")
        some = np.flatnonzero(items.seeds[np.minimum(low, len(items.seeds) - 1)] == grams)
        low = low[some]
        times = np.searchsorted(items.seeds, grams[some], "right") - low
        seed = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        found.append((np.repeat(at[some], times), seed))
    at, seed = map(np.concatenate, zip(*found, strict=True))
    if not len(at):
        return
    key = words.text[at] * len(items.ids) + items.item[seed]
    by = np.argsort(key, kind="stable")  # places ascend within a text and item
    key, at, seed = key[by], at[by], seed[by]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])]
    one, place = key[fresh], at[fresh]
    item = one % len(items.ids)
    last = np.arange(len(one)) + items.need[item] - 1
    inside = np.minimum(last, len(one) - 1)
    full = (last < len(one)) & (one[inside] == one) & (place[inside] - place <= items.width[item])
    edges = np.zeros(len(one) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(full), 1)
    np.add.at(edges, last[full] + 1, -1)
    near = (np.cumsum(edges[:-1]) > 0)[np.cumsum(fresh) - 1]
    key, at, seed = key[near], at[near], seed[near]
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(key) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        text, own = divmod(int(key[a]), len(items.ids))
        yield text, own, at[a:b] - words.first[text] - items.place[seed[a:b]]


def _rows_found(column: pa.Array, items: Items, least: float) -> list[tuple]:
    """Place in the column, item id, score and span of every match."""
    rows: list[tuple] = []
    for part in text_chunks(column):
        words, hashes = plain(part)
        for text, item, starts in _hits(words, hashes, items):
            own = hashes[words.first[text]:words.first[text + 1]]
            score, a, b = _best(own, np.maximum(starts, 0), items.words[item], int(items.slack[item]), least)
            if score >= least:
                rows.append((part.rows[text], items.ids[item], score, a, b))
    return rows


def _matches(docs: DataFrame, items: Items, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*_rows_found(batch.column(1), items, least), strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                ["doc_id", "item_id", "score", "start_word", "end_word"])

    plain_docs = docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text")
    return plain_docs.mapInArrow(run, "doc_id long, item_id long, score double, start_word long, end_word long")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = GRAM, least: float = SCORE) -> DataFrame:
    """Documents that hold an item, whole or edited: doc_id, item_id, score, start_word, end_word (exclusive).

    The score is the best local alignment (match 2, mismatch and gap -1) over the item's words, as a share of the item
    aligned with itself; rows have ``least`` and more, and nothing else decides. One row per row of ``docs`` and item, for its best passage.
    Words are compared with A to Z lower-cased and without punctuation at their ends.

    Seeds are the grams of an item, of as many words (up to ``n``) as every alignment of the score leaves intact
    (``seed_size``): two from 6 words on at a score of 0.6, single words below. Counts over all documents order them; of the
    most frequent only so many are left out that every such alignment still hits the rest, and a passage is aligned when it has as
    many hits as such an alignment must have. Nothing that reaches the score is lost. The benchmark is taken in
    blocks of a bounded number of seeds, and each block is compared with all documents in one pass without a shuffle.
    Items with a NULL id or text, or without words, match nothing, nor do NULL and empty texts. Repeated items count
    once. Rows with a NULL doc_id are compared and reported with it. Empty tables give no rows.
    """
    found = None
    for items in _blocks(benchmark, docs, n, least):
        rows = _matches(docs, items, least)
        found = rows if found is None else found.union(rows)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, score double, start_word long, end_word long")
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, n: int = GRAM, least: float = SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    Each row is judged by its own text, whatever its doc_id; repeated rows stay as often as they occur. One pass without a shuffle
    for each block of the benchmark.
    """
    text = free_name(docs, "text")
    clean = docs.withColumn(text, F.col("text").cast("string"))
    for items in _blocks(benchmark, docs, n, least):
        clean = mapped_rows(clean, _clean_rows(items, least))
    return clean.drop(text)


def _clean_rows(items: Items, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[r[0] for r in _rows_found(batch.column(batch.num_columns - 1), items, least)]] = False
            yield batch.filter(pa.array(clean))

    return run
