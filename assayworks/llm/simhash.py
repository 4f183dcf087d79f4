"""Near-duplicate documents by SimHash fingerprints, looked up under Golay codewords of their segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.arrowtext import text_chunks
from assayworks.llm.components import components
from assayworks.llm.golay import nearby, nearest
from assayworks.llm.shared import written

SEED, WIDTH, DISTANCE = 42, 3, 3
PIECE = 1 << 16
#: Segments of a fingerprint: first bit and number of bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Sides of a key. A key links rows of LEFT and RIGHT, and any two rows of BOTH.
LEFT, RIGHT, BOTH = 0, 1, 2
#: Keys with more rows than this are linked over hubs instead of pairs.
BUCKET = 64


# --- fingerprints ------------------------------------------------------------------------------


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes, lowest first, one row a hash."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprints(part, width: int, seed: int) -> np.ndarray:
    words = part.words(lower=True)
    n = len(part.rows)
    ones, total = np.zeros((n, 64), np.int64), np.zeros(n, np.int64)
    if len(words.start):
        size = words.end - words.start + 1
        stop = np.cumsum(size)
        body = words.data[np.repeat(words.start - (stop - size), size) + np.arange(stop[-1])]
        body[stop - 1] = 0x20
        body = body.tobytes()
        count = np.diff(words.first)
        few = np.flatnonzero((count > 0) & (count < width))
        at = np.flatnonzero(words.text[: max(0, len(size) - width + 1)] == words.text[width - 1:])
        # Shingles as first and last word; those of short texts are their whole sequence.
        first = np.concatenate([at, words.first[few]])
        last = np.concatenate([at + width - 1, words.first[few] + count[few] - 1])
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]
        begin, end, text = (stop - size)[first], stop[last] - 1, words.text[first]
        for low in range(0, len(first), PIECE):
            piece = slice(low, low + PIECE)
            hashes = np.fromiter(
                (xxhash.xxh64_intdigest(body[a:b], seed) for a, b in zip(begin[piece].tolist(), end[piece].tolist(), strict=True)),
                np.uint64, len(first[piece]))
            own, starts, counts = np.unique(text[piece], return_index=True, return_counts=True)
            ones[own] += np.add.reduceat(_set_bits(hashes), starts, axis=0, dtype=np.int64)
            total[own] += counts
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint (long) of every row; a text without words, or a NULL one, has fingerprint zero.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A to Z. A bit is set when it is set in over half the XXH64 hashes of the
    shingles, repeats included; a text of fewer than ``width`` words is one shingle. Texts of any length are hashed in pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for part in text_chunks(texts):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(int(part.rows[0]), len(part.rows)),
                     pa.array(_fingerprints(part, width, seed).view(np.int64))], ["doc_id", "fingerprint"])

    return docs.selectExpr("cast(`doc_id` AS long) AS doc_id", "cast(`text` AS string) AS text").mapInArrow(
        run, "doc_id long, fingerprint long")


# --- keys --------------------------------------------------------------------------------------


def keys_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, sides and fingerprints such that any two fingerprints 1 to 3 bits apart share a key on fitting sides.

    Three errors over three segments leave one of three cases, tried in all orders of segments:
    two segments agree (one key, BOTH sides); one agrees and one differs in a single bit; or all three do. A segment that
    differs in one bit is found under codewords: one side gives the codeword nearest to its segment, the other those nearest to the
    words around its own. Such segments differ in parity, so each parity takes one side and no
    fingerprint meets itself.
    """
    marks = marks.astype(np.uint64)
    segment = [(marks >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64) for low, bits in SEGMENTS]
    odd = [np.bitwise_count(s.view(np.uint64)).astype(np.int64) & 1 for s in segment]
    one = [nearest(s) for s in segment]
    around = [nearby(s, bits) for s, (_, bits) in zip(segment, SEGMENTS, strict=True)]
    everywhere = np.arange(len(marks))
    keys, sides, places = [], [], []

    def put(family: int, key: np.ndarray, side: int, place: np.ndarray) -> None:
        keys.append(key | family << 58)
        sides.append(np.full(len(key), side, np.int8))
        places.append(place)

    for family, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        put(family, segment[a] << 23 | segment[b], BOTH, everywhere)
    for family, (a, b) in enumerate(permutations(range(3), 2), start=3):
        left = np.flatnonzero(odd[b] == 0)
        put(family, segment[a][left] << 12 | one[b][left], LEFT, left)
        message, place = around[b]
        right = odd[b][place] == 1
        put(family, segment[a][place[right]] << 12 | message[right], RIGHT, place[right])
    # All three differ in one bit. The sides share the work: codewords around the last segment left, around the others right.
    parity = odd[1] << 1 | odd[2]
    message, place = around[2]
    left = odd[0][place] == 0
    message, place = message[left], place[left]
    put(9, ((one[0][place] << 12 | one[1][place]) << 12 | message) << 2 | parity[place], LEFT, place)
    (first, at), (second, of) = around[0], around[1]
    right = odd[0][at] == 1
    first, at = first[right], at[right]
    begin, count = np.searchsorted(of, at), np.searchsorted(of, at, "right")
    count = count - begin
    crossed = np.repeat(np.arange(len(at)), count)
    inner = np.arange(len(crossed)) - np.repeat(np.cumsum(count) - count, count) + begin[crossed]
    place = at[crossed]
    put(9, ((first[crossed] << 12 | second[inner]) << 12 | one[2][place]) << 2 | (parity[place] ^ 3), RIGHT, place)
    return np.concatenate(keys), np.concatenate(sides), marks.view(np.int64)[np.concatenate(places)]


def _keyed(marks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for low in range(0, len(column), PIECE):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in keys_of(column[low:low + PIECE])],
                                                 ["key", "side", "mark"])

    return marks.select("mark").mapInArrow(run, "key long, side byte, mark long")


# --- links -------------------------------------------------------------------------------------

# Joins name "merge": Spark sizes what mapInArrow makes of a row as one row (here some forty keys, or 2,081 hubs) and a compressed
# table by its files, so it would take a large side for a small one and broadcast it through the driver.


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _pairs(members: DataFrame) -> DataFrame:
    left = members.filter(F.col("side") != RIGHT).select("key", F.col("mark").alias("a"))
    right = members.filter(F.col("side") != LEFT).select("key", F.col("side"), F.col("mark").alias("b"))
    met = left.join(right.hint("merge"), "key").filter((F.col("side") == RIGHT) | (F.col("a") < F.col("b")))
    return met.filter(_distance("a", "b").between(1, DISTANCE)).select("a", "b")


def _around(marks: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint with all hubs at most ``radius`` (1 or 2) bits away, itself included."""
    flips = [0, *(1 << b for b in range(64))]
    if radius == 2:
        flips += [1 << b | 1 << c for b in range(64) for c in range(b)]
    flips = np.array(flips, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for low in range(0, len(own), 1024):
                some = own[low:low + 1024]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some[:, None] ^ flips).reshape(-1).view(np.int64)),
                     pa.array(np.repeat(some, len(flips)).view(np.int64))], ["hub", "mark"])

    return marks.select("mark").mapInArrow(run, "hub long, mark long")


def _hub_links(members: DataFrame) -> DataFrame:
    """Links that connect the members of large keys as all their pairs would, with work in proportion to the members.

    Two fingerprints one bit from the same hub are two bits apart: all of a hub, at most 65, hang on its least one. Two
    fingerprints three bits apart have a hub one bit from the first and two bits from the second, and whatever is that near to
    such a hub is within three bits: so every fingerprint two bits from a hub hangs on the hub's least one too. The second step
    is only for members of keys that the first one leaves in several parts.
    """
    hubs = written(_around(members.select("mark").distinct(), 1).groupBy("hub").agg(F.sort_array(F.collect_set("mark")).alias("marks")),
                   "simhash-hubs")
    near = written(hubs.select(F.col("marks")[0].alias("a"), F.explode(F.expr("slice(marks, 2, 64)")).alias("b")).distinct(),
                   "simhash-near")
    part = written(components(near), "simhash-parts").select(F.col("node").alias("mark"), F.col("component").alias("part"))
    placed = members.join(part.hint("merge"), "mark", "left").withColumn("part", F.coalesce("part", "mark"))
    open_keys = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    rest = written(placed.join(open_keys.hint("merge"), "key", "left_semi").select("mark", "part").distinct(), "simhash-rest")
    # A hub's fingerprints are of one part; a fingerprint of another part that reaches the hub joins the two.
    roots = _around(rest, 1).groupBy("hub").agg(F.min("mark").alias("root")).join(
        part.select(F.col("mark").alias("root"), F.col("part").alias("own")).hint("merge"), "root", "left")
    reached = _around(rest, 2).join(roots.hint("merge"), "hub").join(rest.hint("merge"), "mark")
    far = reached.filter(F.coalesce("own", "root") != F.col("part")).groupBy("part", F.coalesce("own", "root").alias("own")).agg(
        F.min(F.struct("root", "mark")).alias("link"))
    return near.union(far.select("link.root", "link.mark"))


def linked(marks: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links a, b that connect distinct fingerprints (column mark) as all pairs of 1 to 3 different bits would."""
    keys = _keyed(marks)
    sides = [F.count_if(F.col("side") == s) for s in (LEFT, RIGHT, BOTH)]
    shared = keys.groupBy("key").agg(*[s.alias(n) for s, n in zip(sides, ("l", "r", "b"), strict=True)]).filter(
        "(l > 0 AND r > 0) OR b > 1").selectExpr("key", "l + r + b AS rows")
    members = written(keys.join(shared.hint("merge"), "key"), "simhash-members")
    links = written(_pairs(members.filter(F.col("rows") <= bucket)).distinct(), "simhash-links")
    large = members.filter(F.col("rows") > bucket)
    return links if large.isEmpty() else links.union(_hub_links(large)).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Fingerprints that differ in at most 3 bits are linked; component_id is the smallest doc_id reachable over links, the
    row's own included. NULL, empty and blank texts have fingerprint zero and are linked like others. Rows with a NULL doc_id
    take part, but never name a component; one of only such rows has a NULL component_id. Repeated rows each give a row, ties
    cannot arise. Other columns are ignored; an empty table gives no rows.

    Links are sought between distinct fingerprints, so copies cost nothing. Keys of more than ``bucket`` rows are linked over hubs
    (see _hub_links): no group's pairs are made, and nothing is left out.
    """
    own = written(fingerprints(docs, width, seed), "simhash-fingerprints")
    classes = written(own.groupBy(F.col("fingerprint").alias("mark")).agg(F.min("doc_id").alias("least")), "simhash-classes")
    parts = components(linked(classes, bucket)).select(F.col("node").alias("mark"), F.col("component").alias("part"))
    placed = classes.join(parts.hint("merge"), "mark", "left").withColumn("part", F.coalesce("part", "mark"))
    named = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    led = placed.join(named.hint("merge"), "part").select(F.col("mark").alias("fingerprint"), "component_id")
    return own.join(led.hint("merge"), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
