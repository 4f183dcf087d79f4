"""Repeated windows of symbols across documents: anchors, blocks of documents, and runs of windows.

A window is ``size`` consecutive symbols (bytes or words) of one document. Its anchor is the k-gram inside it with
the smallest hash, the first of equals; equal windows have equal anchors. Consecutive windows with the same
anchor are a run. Only windows whose anchor occurs more than once can be repeated, so all else is dropped early. Documents
are dealt into blocks of a few megabytes; a block meets the anchors that matter to it, never the whole list.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from assayworks.llm.arrowtext import BASE, BYTE_VALUES, SECOND, Texts, grams_hashed, spans_hashed, text_arrays
from assayworks.llm.shared import free_name, mapped_rows, written

BLOCK_BYTES, PART_BYTES = 1 << 20, 1 << 17
SAMPLED_DOCUMENTS = 20_000
COMMON_SHARE, COMMON_LEAST = 0.005, 40
PLACE_BITS = 24
HOT = np.uint64(1 << 63)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Unit:
    """What a symbol is, the window's size and the anchor's."""

    words: bool
    size: int
    gram: int

    @property
    def grams(self) -> int:
        return self.size - self.gram + 1


class Symbols:
    """The symbols of some texts in one row: their hashes under two bases, and where each text begins."""

    def __init__(self, texts: Texts, unit: Unit):
        if unit.words:
            self.table = texts.words()
            self.first = self.table.first
            self.values, self.other = self.table.hashes(), self.table.hashes(SECOND)
        else:
            self.table = None
            inside = np.ones(len(texts.data), bool)
            inside[texts.begin - 1] = inside[-1] = False
            self.bytes = texts.data[inside]
            self.first = np.concatenate([[0], np.cumsum(texts.end - texts.begin)])
            self.values = self.other = BYTE_VALUES[self.bytes]
        self.text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


@dataclass
class Runs:
    """Runs of windows: first and last window start, place of the anchor, text."""

    low: np.ndarray
    high: np.ndarray
    place: np.ndarray
    text: np.ndarray
    anchor: np.ndarray


def runs_of(symbols: Symbols, unit: Unit, common: np.ndarray) -> Runs:
    """All runs of some texts. A common gram is an anchor only where a window has no other."""
    n = len(symbols.values) - unit.size + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none)
    hashes = grams_hashed(symbols.values, unit.gram, SECOND)
    bits = np.uint64(max(PLACE_BITS, len(hashes).bit_length()))
    key = hashes >> (bits + np.uint64(1))
    key <<= bits
    key |= np.arange(len(hashes), dtype=np.uint64)
    if len(common):
        signed = hashes.view(np.int64)
        near = np.minimum(np.searchsorted(common, signed), len(common) - 1)
        key[common[near] == signed] |= HOT
    low, span = key, 1
    while span * 2 <= unit.grams:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = unit.grams - span
    low = np.minimum(low[:-rest], low[rest:]) if rest else low
    place = (low[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    starts = np.flatnonzero(symbols.text[:n] == symbols.text[unit.size - 1:])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none)
    own, text = place[starts], symbols.text[starts]
    fresh = np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1])]
    begin = np.flatnonzero(fresh)
    end = np.r_[begin[1:], len(starts)] - 1
    return Runs(starts[begin], starts[end], own[begin], text[begin], hashes.view(np.int64)[own[begin]])


def digests(symbols: Symbols, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (spans_hashed(symbols.values, low, high, BASE).view(np.int64),
            spans_hashed(symbols.other, low, high, np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64))


# --- texts in parts ---------------------------------------------------------------------------


@dataclass
class Part:
    """Some whole texts, or the part of one long text in which ``skipped`` and later symbols begin. ``base`` is its first byte."""

    texts: Texts
    skipped: int
    base: int


def parts_of(raw: np.ndarray, offsets: np.ndarray, unit: Unit) -> Iterator[Part]:
    """Texts in parts of about PART_BYTES. A longer text is cut into parts that overlap by a window less one symbol.

    So each window of a text begins in exactly one part and lies within it, and a part costs the same however long its text is.
    """
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PART_BYTES, "right")) - 1)
        begin, end = int(offsets[low]), int(offsets[high])
        if end - begin <= PART_BYTES:
            yield Part(Texts(np.arange(low, high), raw, offsets[low:high + 1]), 0, begin)
        else:
            for skipped, a, b in _cuts(raw, begin, end, unit):
                yield Part(Texts(np.array([low]), raw, np.array([a, b])), skipped, a)
        low = high


def _cuts(raw: np.ndarray, begin: int, end: int, unit: Unit) -> Iterator[tuple[int, int, int]]:
    """Symbols before each part of a text, and where the part begins and ends in ``raw``."""
    if not unit.words:
        for a in range(begin, end, PART_BYTES):
            yield a - begin, a, min(end, a + PART_BYTES + unit.size - 1)
        return
    words = Texts(np.zeros(1, np.int64), raw, np.array([begin, end])).words()
    first = np.unique(np.searchsorted(words.start, np.arange(1, end - begin + 1, PART_BYTES)))
    first = first[first < len(words.start)]
    for k, a in enumerate(first.tolist()):
        last = min(len(words.start), (first[k + 1] if k + 1 < len(first) else len(words.start)) + unit.size - 1) - 1
        yield a, begin + int(words.start[a]) - 1, begin + int(words.end[last]) - 1


# --- documents in blocks ---------------------------------------------------------------------


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, its place in the order ``ord`` (NULL after all numbers) and text, NULL as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("ord"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def block_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    return max(1, size // BLOCK_BYTES)


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("ord"), F.lit(blocks)).cast("int")


def parcels(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, orders, known, sizes, data): compressed texts of one block from one batch, for a cheaper shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw, places = text_arrays(batch.column(2))
            block = batch.column(3).to_numpy(zero_copy_only=False)
            ids = pa.compute.is_valid(batch.column(0)).to_numpy(zero_copy_only=False)
            orders = batch.column(1).to_numpy()
            by = np.argsort(block, kind="stable")
            cut = np.flatnonzero(np.r_[True, block[by][1:] != block[by][:-1], True])
            rows = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                own = by[a:b]
                data = b"".join(raw[places[i]:places[i + 1]].tobytes() for i in own)
                sizes = np.diff(places)[own]
                rows.append((int(block[own[0]]), orders[own].tobytes(), ids[own].astype(np.int8).tobytes(),
                             sizes.astype(np.int64).tobytes(), press.compress(data)))
                if sum(len(r[4]) for r in rows[-8:]) > 4 << 20 or len(rows) >= 512:
                    yield _parcel_batch(rows)
                    rows = []
            yield _parcel_batch(rows)

    return ordered(docs).withColumn("block", block_of(blocks)).mapInArrow(
        run, "block int, orders binary, known binary, sizes binary, data binary")


def _parcel_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["block", "orders", "known", "sizes", "data"])


class Block:
    """The documents of a block, opened: orders, whether the id is known, texts in order of the id.

    A row is a place in this order. Rows that repeat a doc_id are told apart by their texts.
    """

    def __init__(self, table: pa.Table):
        open_ = zstandard.ZstdDecompressor()
        rows = table.select(["orders", "known", "sizes", "data"]).to_pylist()
        read = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows] or [np.zeros(0, kind)])
        orders, known, sizes = read("orders", np.int64), read("known", np.int8), read("sizes", np.int64)
        raw = np.frombuffer(b"".join(open_.decompress(r["data"]) for r in rows), np.uint8)
        ends = np.cumsum(sizes)
        checks = [zlib.crc32(raw[b - n:b]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        by = np.lexsort((checks, sizes, orders))  # the same order whenever the block is opened
        self.orders, self.known, self.sizes = orders[by], known[by].astype(bool), sizes[by]
        self.data = np.concatenate([raw[ends[i] - sizes[i]:ends[i]] for i in by] or [raw[:0]])
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def texts(self) -> Texts:
        return Texts(np.arange(len(self.orders)), self.data, self.offsets)


# --- anchors ----------------------------------------------------------------------------------


def anchor_rows(docs: DataFrame, unit: Unit, blocks: int, common: np.ndarray) -> DataFrame:
    """(block, anchor, low, high, n) of each part: smallest and largest document with the anchor, and how often it occurs.

    An anchor where two parts of a text overlap counts in both; it may then be a candidate in vain.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(*text_arrays(batch.column(2)), unit):
                runs = runs_of(Symbols(part.texts, unit), unit, common)
                order = batch.column(1).to_numpy()[part.texts.rows][runs.text]
                block = batch.column(3).to_numpy()[part.texts.rows][runs.text]
                # The same place can be the anchor of two runs when a common gram lies between.
                by = np.lexsort((runs.place, order, runs.anchor, block))
                b, a, o, p = block[by], runs.anchor[by], order[by], runs.place[by]
                fresh = np.r_[True, (b[1:] != b[:-1]) | (a[1:] != a[:-1])][: len(by)]
                begin = np.flatnonzero(fresh)
                other = np.r_[True, p[1:] != p[:-1]][: len(by)] | fresh
                n = np.add.reduceat(other.astype(np.int64), begin) if len(begin) else begin
                end = np.r_[begin[1:], len(by)][: len(begin)] - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b[begin].astype(np.int32)), pa.array(a[begin]), pa.array(o[begin]), pa.array(o[end]),
                     pa.array(n.astype(np.int32))], ["block", "anchor", "low", "high", "n"])

    return ordered(docs).withColumn("block", block_of(blocks)).mapInArrow(
        run, "block int, anchor long, low long, high long, n int")


def common_anchors(docs: DataFrame, unit: Unit) -> np.ndarray:
    """Anchors in many documents of a sample of about SAMPLED_DOCUMENTS. It settles the plan, not the result.

    At most the anchors of the sample divided by COMMON_LEAST, so a list of bounded size.
    """
    rows = docs.count()
    every = max(1, rows // SAMPLED_DOCUMENTS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    least = max(COMMON_LEAST, int(COMMON_SHARE * rows / every))
    counted = anchor_rows(sample, unit, 1 << 30, np.zeros(0, np.int64)).groupBy("anchor").agg(
        F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= least)
    return np.array(sorted(r[0] for r in counted.select("anchor").collect()), np.int64)


def repeated_anchors(docs: DataFrame, unit: Unit, blocks: int, common: np.ndarray) -> DataFrame:
    """(block, anchor) of anchors that occur twice, for words in two documents; common anchors are left out."""
    rows = anchor_rows(docs, unit, blocks, common)
    if len(common):
        known = docs.sparkSession.createDataFrame([(int(x),) for x in common], "anchor long")
        rows = rows.join(F.broadcast(known), "anchor", "left_anti")  # a list of bounded size
    over = Window.partitionBy("anchor")
    if unit.words:
        rows = rows.drop("n").withColumn("again", F.min("low").over(over) < F.max("high").over(over))
    else:
        rows = rows.drop("low", "high").withColumn("again", F.sum("n").over(over) > 1)
    return written(rows.filter("again").select("block", "anchor"), "anchors")


# --- runs of a block, and what is decided about them -------------------------------------------------

Locate = Callable[[Texts, Symbols, Runs, np.ndarray], np.ndarray]


def by_hash(texts: Texts, symbols: Symbols, runs: Runs, wanted: np.ndarray) -> np.ndarray:
    """Which runs have one of the wanted anchors."""
    return np.isin(runs.anchor, wanted)


def occurrences(docs: DataFrame, unit: Unit, blocks: int, anchors: DataFrame, common: np.ndarray,
                locate: Locate) -> DataFrame:
    """(block, row, ord, start, windows, at, anchor, d1, d2, body) of runs that may be repeated.

    ``at`` is the anchor's place in the run. ``body`` holds the run's symbols, NULL where an equal run of an earlier place was seen in the block:
    such a run is repeated as a whole whatever other blocks hold.
    """
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left)
        wanted = np.union1d(right.column("anchor").to_numpy(), common)
        found = [_runs_found(part, unit, common, wanted, locate) for part in parts_of(block.data, block.offsets, unit)]
        columns = {n: np.concatenate([f[n] for f in found]) for n in found[0]} if found else _NO_RUNS
        order, start = block.orders[columns["row"]], columns["start"]
        d1, d2 = columns["d1"], columns["d2"]
        by = np.lexsort((start, order, d2, d1, columns["anchor"]))
        anchor = columns["anchor"][by]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (d1[by][1:] != d1[by][:-1]) | (d2[by][1:] != d2[by][:-1])][: len(by)]
        leader = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
        after = order[by] > order[by][leader]
        if not unit.words:
            after |= (order[by] == order[by][leader]) & (start[by] > start[by][leader])
        back = np.empty(len(by), bool)
        back[by] = after
        body = [None if done else block.data[a:b].tobytes() for a, b, done in
                zip(columns["from"].tolist(), columns["to"].tolist(), back.tolist(), strict=True)]
        return pa.table({
            "block": pa.array(np.full(len(by), key[0].as_py(), np.int32)),
            "row": columns["row"].astype(np.int32), "ord": order, "start": start,
            "windows": columns["windows"].astype(np.int32), "at": columns["at"].astype(np.int32), "anchor": columns["anchor"],
            "d1": d1, "d2": d2, "body": pa.array(body, pa.binary())})

    found = parcels(docs, blocks).groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(
        run, "block int, row int, ord long, start long, windows int, at int, anchor long, d1 long, d2 long, body binary")
    return written(found, "runs")


_NO_RUNS = {n: np.zeros(0, np.int64) for n in ("row", "start", "windows", "at", "anchor", "d1", "d2", "from", "to")}


def _runs_found(part: Part, unit: Unit, common: np.ndarray, wanted: np.ndarray, locate: Locate) -> dict:
    """The runs of a part that ``locate`` picks, with their bytes' range in the block."""
    symbols = Symbols(part.texts, unit)
    runs = runs_of(symbols, unit, common)
    which = np.flatnonzero(locate(part.texts, symbols, runs, wanted)) if len(runs.low) else np.zeros(0, np.int64)
    if not len(which):
        return _NO_RUNS
    low, high, place, text = runs.low[which], runs.high[which] + unit.size, runs.place[which], runs.text[which]
    d1, d2 = digests(symbols, low, high)
    if unit.words:  # a text's bytes come after as many spaces put in as there are texts up to it
        begin, end = symbols.table.start[low] - text - 1, symbols.table.end[high - 1] - text - 1
    else:
        begin, end = low, high
    return {"row": part.texts.rows[text], "start": low - symbols.first[text] + part.skipped, "windows": high - low - unit.size + 1,
            "at": place - low, "anchor": runs.anchor[which], "d1": d1, "d2": d2, "from": begin + part.base, "to": end + part.base}


def judged(found: DataFrame, unit: Unit, resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(block, row, low, high): ranges of symbols covered by windows that occur earlier.

    Equal runs are settled by the first of them. Where an anchor has runs of several contents, the
    first run of each goes on to ``resolve``, which compares single windows.
    """
    local = found.filter("body IS NULL")
    rest = found.filter("body IS NOT NULL")
    same, near = Window.partitionBy("anchor", "d1", "d2"), Window.partitionBy("anchor")
    place = F.col("ord") if unit.words else F.struct("ord", "start")
    ranked = rest.withColumn("leader", F.min(place).over(same)).withColumn(
        "several", F.struct(F.min("d1").over(near), F.min("d2").over(near)) !=
        F.struct(F.max("d1").over(near), F.max("d2").over(near)))
    ranked = ranked.withColumn("later", place > F.col("leader")).filter("later OR several").drop("leader", "several")
    ranked = written(ranked.withColumn("body", F.when(~F.col("later"), F.col("body"))), "ranked")
    whole = [F.col("start").alias("low"), (F.col("start") + F.col("windows") + (unit.size - 1)).alias("high")]
    settled = local.select("block", "row", *whole).union(ranked.filter("later").select("block", "row", *whole))
    return settled.union(resolve(ranked.filter("NOT later")))


def cut_out(docs: DataFrame, blocks: int, spans: DataFrame, finish: Callable[[Block, pa.Table], pa.Table],
            schema: str) -> DataFrame:
    """Every document of every block with the spans found in it."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(Block(left), right)

    return parcels(docs, blocks).groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, schema)


def covered(first: np.ndarray, spans: pa.Table) -> np.ndarray:
    """A flag per symbol: is it inside a span? ``first`` are the places where the block's rows begin."""
    marks = np.zeros(int(first[-1]) + 1, np.int32)
    begin = first[spans.column("row").to_numpy()]
    np.add.at(marks, begin + spans.column("low").to_numpy(), 1)
    np.add.at(marks, begin + spans.column("high").to_numpy(), -1)
    return np.cumsum(marks, dtype=np.int32, out=marks)[:-1] > 0


def merged_windows(owner: np.ndarray, offset: np.ndarray, rows: pa.Table, size: int) -> pa.Table:
    """Ranges of symbols from windows given by run and offset in the run; neighbours become one range."""
    by = np.lexsort((offset, owner))
    owner, offset = owner[by], offset[by]
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)][: len(by)]
    begin = np.flatnonzero(fresh)
    end = np.r_[begin[1:], len(by)][: len(begin)] - 1
    run = owner[begin]
    start = rows.column("start").to_numpy()[run]
    return pa.table({
        "block": rows.column("block").to_numpy()[run], "row": rows.column("row").to_numpy()[run],
        "low": start + offset[begin], "high": start + offset[end] + size})


def _beside(unit: Unit) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds hashes of the symbols left and right of a run's anchor, half of what a window has besides it, NULL where there are fewer."""
    half = (unit.size - unit.gram + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides: tuple[list, list] = ([], [])
            for at, body in zip(batch.column(5).to_pylist(), batch.column(9).to_pylist(), strict=True):
                own = _WORD.findall(body) if unit.words else body
                behind = at + unit.gram
                for side, some, enough in ((sides[0], own[max(0, at - half):at], at >= half),
                                           (sides[1], own[behind:behind + half], behind + half <= len(own))):
                    side.append(xxhash.xxh64_intdigest(b" ".join(some) if unit.words else some) >> 1 if enough else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(s, pa.int64()) for s in sides)],
                                             [*batch.schema.names, "left", "right"])

    return run


def bucketed(frame: DataFrame, unit: Unit, rows_each: int) -> tuple[DataFrame, str]:
    """Adds a column that deals runs into buckets of about ``rows_each`` rows, those that can share a window together.

    Runs of one anchor go together. Runs of an anchor with more than ``rows_each`` are dealt twice, by what is left and what is right of the
    anchor: any window they share reaches half of its rest to one side, and so all runs that have the window meet there.
    """
    name = free_name(frame, "bucket")
    buckets = max(1, frame.count() // rows_each)
    large = written(frame.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_each).select("anchor"), "large")
    key = F.xxhash64("anchor")
    if large.isEmpty():
        return frame.withColumn(name, F.pmod(key, F.lit(buckets))), name
    sides = F.filter(F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("by")) for side in ("left", "right")]),
                     lambda x: x["by"].isNotNull())
    added = [StructField(side, LongType()) for side in ("left", "right")]
    halves = mapped_rows(frame.join(large, "anchor", "left_semi").select(*frame.columns), _beside(unit), added).withColumn(
        "side", F.explode(sides)).withColumn(
        name, F.pmod(F.xxhash64("anchor", "side.side", "side.by"), F.lit(buckets))).drop("side", "left", "right")
    rest = frame.join(large, "anchor", "left_anti").withColumn(name, F.pmod(key, F.lit(buckets)))
    return rest.unionByName(halves), name
