"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.arrowtext import SECOND, Texts, mixed, spans_hashed, text_chunks
from assayworks.llm.components import components
from assayworks.llm.shared import free_name, one_of_each, text_or_empty, written

SIZE = 128
BANDS = 32
CHUNK = 1 << 19
RARE, PARTS = 16, 64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text, one after the other, and where each text begins.

    A to Z are lower-cased. A text with fewer than n words has its whole word sequence as only shingle.
    """
    words = texts.words(lower=True)
    own = words.hashes()
    count = np.diff(words.first)
    starts = np.flatnonzero(words.text[: max(0, len(own) - n + 1)] == words.text[n - 1:]) if len(own) else words.first[:0]
    few = np.flatnonzero((count > 0) & (count < n))
    grams = np.concatenate([
        spans_hashed(own, starts, starts + n, SECOND),
        spans_hashed(own, words.first[few], words.first[few] + count[few], SECOND)])
    text = np.concatenate([words.text[starts], few])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[fresh], text[fresh]
    return grams, np.searchsorted(text, np.arange(len(texts.rows) + 1))


def superminhash(elements: np.ndarray, first: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Signatures of sets given as runs of one array; equal in a place with probability near their similarity.

    Every element draws a random permutation of the places, step by step, and offers rank + fraction to each.
    The ranks of an element differ, which lowers the variance. A set is done as soon as all its
    places hold less than the next rank; large sets need two or three steps.
    """
    n = len(first) - 1
    signature = np.full((n, size), np.iinfo(np.int64).max)
    flat = signature.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(first))
    places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (len(elements), 1))
    for rank in range(size):
        if not len(elements):
            break
        random = mixed(elements + np.uint64(int(GOLDEN) * (rank + 1) % (1 << 64)))
        other = rank + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(size - rank) >> np.uint64(32)).astype(np.int64)
        row = np.arange(len(elements))
        chosen = places[row, other]
        places[row, other] = places[:, rank]
        value = (random >> np.uint64(32)).astype(np.int64) + (rank << 32)
        np.minimum.at(flat, owner * size + chosen, value)
        waiting = (signature.max(axis=1) >= (rank + 1) << 32)[owner]
        if not waiting.all():
            elements, owner, places = elements[waiting], owner[waiting], places[waiting]
    return signature


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per band: equal when the band's places are equal."""
    n, size = signature.shape
    rows = size // bands
    parts = signature[:, : rows * bands].astype(np.uint64).reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (n, bands)).copy()
    for r in range(rows):
        key = mixed(key ^ mixed(parts[:, :, r] + np.uint64(r + 1)))
    return key.view(np.int64)


def _lists(values: np.ndarray, places: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values))


def signed(docs: DataFrame, n: int, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, a digest of the set (d1, d2) and its band keys; one row per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch.column(1), CHUNK):
                sets, first = shingle_sets(part, n)
                keys = band_keys(superminhash(sets, first), bands)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets + x))]) for x in (GOLDEN, SECOND)]
                digests = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(int(part.rows[0]), len(part.rows)), pa.array(np.diff(first)),
                     *map(pa.array, digests), _lists(keys.ravel(), np.arange(0, keys.size + 1, bands))],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"])

    schema = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    return _plain(docs).mapInArrow(run, schema)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS string) AS text")


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id and its shingles as an array of longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch.column(1), CHUNK):
                sets, first = shingle_sets(part, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(int(part.rows[0]), len(part.rows)), _lists(sets.view(np.int64), first)],
                    ["doc_id", "shingles"])

    return _plain(docs).mapInArrow(run, "doc_id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of doc_ids whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    common = F.size(F.array_intersect("left", "right")).cast("long")
    union = F.size("left").cast("long") + F.size("right") - common
    return both.filter(common * 100 >= union * percent).select("a", "b")


def able_pairs(open_rows: DataFrame, classes: DataFrame, clusters: DataFrame, sets: DataFrame,
               percent: int) -> DataFrame:
    """The pairs a, b of heads in different components and a common bucket, or with a rare shingle in common, that may be linked.

    In a cluster, a shingle is rare in up to RARE documents and core in more; one in a single document is neither. What two documents
    share is core alone, and then bounded by the core shingles of either in each of PARTS parts (by a hash), or holds a
    rare shingle, and then they meet by it. Either way they share no more than the rare and core shingles of either.
    """
    own = written(sets.join(clusters, "doc_id").select(
        "cluster", F.col("doc_id").alias("head"), F.explode("shingles").alias("shingle")), "shingles")
    counted = own.groupBy("cluster", "shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    marked = written(own.join(counted, ["cluster", "shingle"]), "shared-shingles")
    in_part = marked.groupBy("head", F.pmod("shingle", F.lit(PARTS)).cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("common"), F.count(F.when(F.col("n") > RARE, 1)).alias("core"))
    by_part = F.map_from_entries(F.collect_list(F.struct("part", F.col("core").cast("int"))))
    bounds = in_part.groupBy("head").agg(F.sum("common").alias("common"), F.sum("core").alias("core"), by_part.alias("of"))
    bounds = bounds.withColumn("parts", F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda g: F.coalesce(
        F.try_element_at("of", g), F.lit(0)))).drop("of")
    placed = open_rows.select("head", "component").distinct()
    facts = written(classes.select("head", "n_shingles", "bands").join(placed, "head").join(bounds, "head").filter(
        F.col("common") * 100 >= F.col("n_shingles") * percent), "facts")

    def enough(bound: str) -> Column:
        least = F.least(F.col(f"x.{bound}"), F.col(f"y.{bound}"))
        return least * (100 + percent) >= (F.col("x.n_shingles") + F.col("y.n_shingles")) * percent

    apart = F.expr("x.head < y.head AND x.component <> y.component")
    facing = F.struct("head", "component", "n_shingles", "core", "common", "parts")
    able = open_rows.select("key", "head").join(facts.filter(
        F.col("core") * 100 >= F.col("n_shingles") * percent), "head").select("key", facing.alias("one"), "bands")
    left, right = able.toDF("key", "x", "xs"), able.toDF("other", "y", "ys")
    first = F.array_min(F.array_intersect("xs", "ys")) == F.col("key")  # a pair is made in one bucket only
    shared = F.aggregate(F.zip_with("x.parts", "y.parts", lambda a, b: F.least(a, b)), F.lit(0), lambda total, n: total + n)
    fitting = shared * (100 + percent) >= (F.col("x.n_shingles") + F.col("y.n_shingles")) * percent
    by_core = left.join(right, (F.col("key") == F.col("other")) & apart & enough("core") & fitting & first)
    thin = marked.filter(F.col("n") <= RARE).select("cluster", "shingle", "head").join(
        facts.select("head", F.struct("head", "component", "n_shingles", "common").alias("one")), "head").drop("head")
    one, two = thin.toDF("cluster", "shingle", "x"), thin.toDF("c", "s", "y")
    by_rare = one.join(two, F.expr("cluster = c AND shingle = s") & apart & enough("common"))
    return by_core.select(F.col("x.head").alias("a"), F.col("y.head").alias("b")).union(
        by_rare.select("x.head", "y.head")).distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """Every document with its component: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Documents are linked when 100 * shared shingles >= percent * all shingles of both, checked on full sets.
    ``component_id`` is the smallest doc_id reachable by links. One row per row of ``docs``.

    NULL and empty texts, and texts of spaces only, have no shingles and are linked with nothing. Rows with a NULL doc_id
    are linked with nothing, have a NULL component and are kept. Rows that repeat a doc_id are one document
    with the links of all of them. Other columns are ignored; an empty table gives no rows.

    Equal sets are one class from the start, so copies never become pairs. In each band's bucket all
    classes are compared with the bucket's smallest; then only classes of a bucket that are not
    yet in one component are compared with each other, and of these only the pairs that can be similar enough by
    what they have in common with others (able_pairs). A group of near copies thus
    costs a pair per member and bucket, and no link between different components is left out. With 32 bands of 4 places
    a pair at a similarity of 0.8 shares no bucket with a probability of 5e-8.
    """
    rows = written(signed(docs, n, bands), "signatures")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(usable.groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("head"), F.min_by("bands", "doc_id").alias("bands")), "classes")
    members = classes.select(F.explode("bands").alias("key"), F.struct("head", "n_shingles").alias("one"))
    shared = members.groupBy("key").agg(F.min("one").alias("first"), F.max("one").alias("last")).filter("first <> last")
    buckets = written(members.join(shared.select("key", "first"), "key").select(
        "key", "first", "one", F.col("one.head").alias("head")), "buckets")
    alike = (F.least("x.n_shingles", "y.n_shingles") * 100 >= F.greatest("x.n_shingles", "y.n_shingles") * percent)
    stars = buckets.select(F.col("first").alias("x"), F.col("one").alias("y")).filter("x <> y").select(
        F.col("x.head").alias("a"), F.col("y.head").alias("b"), alike.alias("alike"))
    stars = written(stars.distinct(), "stars")
    pairs = stars.filter("alike").select("a", "b")
    heads = stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # Sorted on both sides at any size: the list of heads grows with the documents.
    sets = written(full_sets(docs.select("doc_id", "text").join(heads.hint("merge"), "doc_id", "left_semi"), n), "sets")
    links = written(verified(pairs, sets, percent), "links")
    found = components(links)

    placed = buckets.join(found, F.col("head") == F.col("node"), "left").select(
        "key", "one", "head", F.coalesce("component", "head").alias("component"))

    def several(frame: DataFrame) -> DataFrame:
        """Rows of buckets with more than one component."""
        ends = frame.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return frame.join(ends.filter("low <> high").select("key"), "key", "left_semi")

    open_rows = written(several(placed), "open")
    if not open_rows.isEmpty():
        clusters = components(stars).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
        clusters = clusters.join(open_rows.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi")
        more = able_pairs(open_rows, classes, clusters, sets, percent)
        more = written(more.join(pairs, ["a", "b"], "left_anti"), "crossed")
        found = components(links.union(verified(more, sets, percent)))

    named = classes.select("d1", "d2", "n_shingles", "head").join(
        found, F.col("head") == F.col("node"), "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "head").alias("component"))
    joined = rows.drop("bands").join(named, ["d1", "d2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(
        F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns, whatever their names and types.

    Of rows with the same doc_id and text one stays.
    """
    name = free_name(docs, "kept")
    kept = near_duplicates(docs, n, percent).filter("kept").select(F.col("doc_id").alias(name)).distinct()
    return one_of_each(docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi"), text_or_empty())
