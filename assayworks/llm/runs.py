"""Periodic runs of words: Lyndon-root candidates extended both ways over suffix trees of a text and of its reversal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.arrowtext import SECOND, SPACE, U, Words, grams_hashed, text_chunks
from assayworks.llm.suffixtree import SuffixTree

REPEATS, LEAST = 4, 6
#: Word grams by which places are sifted: (words of a gram, smallest period they serve).
GRAMS = ((3, 1), (8, 8))
STEP = 1.5


def word_numbers(words: Words) -> np.ndarray:
    """Equal numbers for equal words of some texts, from 1."""
    offsets = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(words.end - words.start, out=offsets[1:])
    body = np.ascontiguousarray(words.data[~SPACE[words.data]])
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1


def least_length(period: int, repeats: int = REPEATS, least: int = LEAST) -> int:
    return max(least, repeats * period)


def _distance(numbers: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """How far on the word gram at each place comes again in its text; a large number if never."""
    n = len(numbers)
    far = np.full(n, n + 1, np.int64)
    count = n - size + 1
    if count <= 0:
        return far
    grams = grams_hashed(numbers.astype(U), size) ^ (text[:count].astype(U) * SECOND)
    at = np.flatnonzero(text[:count] == text[size - 1:])
    at = at[np.argsort(grams[at], kind="stable")]
    same = (grams[at[1:]] == grams[at[:-1]]) & (text[at[1:]] == text[at[:-1]])
    far[at[:-1][same]] = (at[1:] - at[:-1])[same]
    return far


def possible(numbers: np.ndarray, text: np.ndarray, end: np.ndarray, repeats: int, least: int) -> np.ndarray:
    """Which words can lie in a run. Every word of a run is among them, and each run lies within one stretch of them.

    In a run of period q, each word gram comes again within q words, but for the last q words. So for every range of periods
    there must be enough neighbouring places whose grams come again that soon. ``end`` is where the text of a word ends.
    """
    n = len(numbers)
    change = np.zeros(n + 1, np.int64)
    longest = int(np.bincount(text).max(initial=0)) // repeats if n else 0
    for k, (size, since) in enumerate(GRAMS):
        until = min(longest, GRAMS[k + 1][1] - 1) if k + 1 < len(GRAMS) else longest
        if since > until:
            continue
        distance = _distance(numbers, text, size)
        low = since
        while low <= until:
            high = min(until, max(low, int(low * STEP)))
            places = min(least_length(q, repeats, least) - q for q in range(low, min(high, least) + 1)) \
                if low <= least else (repeats - 1) * low
            near = np.zeros(n + 2, np.int8)
            near[1:-1] = distance <= high
            turn = np.diff(near)
            a, b = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
            long = b - a >= max(1, places - size + 1)
            a, b = a[long], b[long]
            np.add.at(change, a, 1)
            np.add.at(change, np.minimum(b + high + size - 1, end[b - 1]) if len(b) else b, -1)
            low = high + 1
    return np.cumsum(change[:-1]) > 0


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix but the empty one, where the next smaller suffix begins: the longest Lyndon word ends there."""
    out, stack = [0] * (len(rank) - 1), []
    for i, r in enumerate(rank.tolist()):
        while stack and stack[-1][1] > r:
            out[stack.pop()[0]] = i
        stack.append((i, r))
    return np.array(out, np.int64)


def maximal_runs(symbols: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """Rows of start, length and smallest period of all runs of a sequence of positive integers, by start, then period.

    The root of a run is the longest Lyndon word at its place in one of the two orders of symbols, so these words,
    at most two a place, are all candidates; each is extended both ways by longest common extensions.
    """
    n = len(symbols)
    if n < least:
        return np.zeros((0, 3), np.int64)
    sigma = int(symbols.max()) + 1
    forward, backward = SuffixTree(symbols, sigma), SuffixTree(symbols[::-1], sigma)
    at = np.arange(n)
    found = []
    for turned in (False, True):
        beyond = next_smaller(forward.ranks(turned))
        period = beyond - at
        stop = beyond + forward.extension(at, beyond)
        before = np.zeros(n, np.int64)
        before[1:] = backward.extension(n - at[1:], n - beyond[1:])
        length = stop - at + before
        run = length >= np.maximum(least, repeats * period)
        found.append(np.stack([at - before, length, period], 1)[run])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_text(numbers: np.ndarray, maybe: np.ndarray, repeats: int, least: int) -> np.ndarray:
    """The runs of one text, from the trees of its possible stretches, told apart by symbols that occur once."""
    turn = np.diff(np.concatenate([[0], maybe.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if not len(begin):
        return np.zeros((0, 3), np.int64)
    marks = int(numbers.max()) + 1
    parts, places, offset = [], [], 0
    for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        parts += [numbers[a:b], [marks + k]]
        places.append(offset)
        offset += b - a + 1
    _, dense = np.unique(np.concatenate(parts), return_inverse=True)
    runs = maximal_runs(dense.reshape(-1) + 1, repeats, least)
    part = np.searchsorted(places, runs[:, 0], "right") - 1
    runs[:, 0] += (begin - np.array(places))[part]
    return runs


def joined(words: Words, picked: np.ndarray) -> bytes:
    """The picked words joined by one space."""
    if not len(picked):
        return b""
    start = words.start[picked]
    size = words.end[picked] - start + 1
    stop = np.cumsum(size)
    out = words.data[np.repeat(start - (stop - size), size) + np.arange(stop[-1])]
    out[stop - 1] = 0x20
    return out[:-1].tobytes()


PIECE = 1 << 16


def periodic_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """Maximal periodic runs of the words of every text, and the text with each run cut to its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch with smallest period q and at least max(least, repeats * q) words that no
    neighbouring word extends. Returns doc_id, n_words, runs (array of start, length, period, by start, then period) and
    collapsed (binary UTF-8: kept words joined by one space); one row per input row, repeated rows and NULL ids included.
    NULL, empty and blank texts have no words, no runs and an empty collapsed text. Other columns are ignored; an empty table gives
    no rows. Overlapping runs are all reported, and a word goes when any run has it beyond its first period.

    A text is one row's work: suffix trees take about half a kilobyte a word, and only for stretches that can hold
    a run (see possible). Nothing is shuffled.
    """
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for part in text_chunks(texts):
                words = part.words()
                numbers = word_numbers(words)
                maybe = possible(numbers, words.text, words.first[words.text + 1], repeats, least)
                count = np.diff(words.first)
                found, collapsed = [], []
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    runs = runs_of_text(numbers[a:b], maybe[a:b], repeats, least)
                    found.append(runs)
                    change = np.zeros(b - a + 1, np.int64)
                    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
                    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0) + a
                    collapsed.append(b" ".join(joined(words, kept[i:i + PIECE]) for i in range(0, len(kept), PIECE)))
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(flat[:, i]) for i in range(3)], fields=list(struct)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(int(part.rows[0]), len(part.rows)), pa.array(count.astype(np.int64)), lists,
                     pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return docs.selectExpr("cast(`doc_id` AS long) AS doc_id", "cast(`text` AS string) AS text").mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of about every tenth text repeat from some place on, as the contract of op12 lays down."""
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = own.withColumn("words", F.when(h % 10 == 0, words)).withColumn("n", F.size("words")).withColumn(
        "g", F.floor(h / 10).cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0L, n - 1L), i -> words[cast(if(i < a, i, a + (i - a) % p) AS int)]), ' ')")
    return chosen.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
