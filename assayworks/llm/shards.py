"""Assignment of documents to shards of even size by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayworks.llm.shared import running, written

PRIORITIES = 1_024
LARGE = 64
STEPS = (4, 16, 64, 256, 1_024, 4_096)


def equal_text_links(nodes: DataFrame, shards: int, total: int) -> DataFrame:
    """Links (a, b) from each document to the hub of its group of equal texts, and between hubs.

    ``nodes`` has node, grp, size. A group larger than a quarter of a shard has a hub for each such part, so that a text
    of a third of all bytes does not pull all its copies into one shard. There are at most 4 * shards such
    groups: their list is of bounded size.
    """
    part = max(1, total // (4 * shards))
    groups = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).filter("n > 1")
    linked = nodes.join(groups, "grp").withColumn("piece", F.when(
        F.col("bytes") > part, F.pmod(F.xxhash64("node"), F.ceil(F.col("bytes") / part))).otherwise(F.lit(0)))
    hubs = linked.groupBy("grp", "piece").agg(F.min("node").alias("b"))
    heads = hubs.groupBy("grp").agg(F.min("b").alias("head"))
    spokes = linked.join(hubs, ["grp", "piece"]).select(F.col("node").alias("a"), "b")
    rim = hubs.join(heads, "grp").select(F.col("b").alias("a"), F.col("head").alias("b"))
    return spokes.union(rim).filter("a <> b").distinct()


def _accepted(moves: DataFrame, rooms: list[int]) -> DataFrame:
    """The moves (node, target, size, pull) for which their target has room, whole neighbourhoods before parts of others.

    Moves are ordered by a hash of the neighbour they follow; a target takes them from the front until its room is used up.
    """
    room = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in rooms]), F.col("target") + 1)
    ranked = moves.withColumn("turn", F.pmod(F.xxhash64("pull"), F.lit(PRIORITIES)))
    turns = ranked.groupBy("target", "turn").agg(F.sum("size").alias("bytes"))
    front = Window.partitionBy("target").orderBy("turn")
    open_turns = turns.withColumn("upto", F.sum("bytes").over(front)).filter(F.col("upto") <= room)
    return ranked.join(open_turns.select("target", "turn"), ["target", "turn"]).select("node", "target")


def _by_shard(labels: DataFrame, shards: int) -> list[int]:
    sums = {r[0]: r[1] for r in labels.groupBy("shard").agg(F.sum("size")).collect()}
    return [int(sums.get(s) or 0) for s in range(shards)]


def _cut(links: DataFrame, labels: DataFrame) -> int:
    """How many links lead from one shard to another."""
    ends = [labels.select(F.col("node").alias(end), F.col("shard").alias(f"{end}_shard")) for end in ("a", "b")]
    return links.join(ends[0], "a").join(ends[1], "b").filter("a_shard <> b_shard").count()


def propagated(nodes: DataFrame, links: DataFrame, rooms: list[int]) -> DataFrame:
    """node, size, shard of every linked node when label propagation cuts no fewer links any more.

    Nodes start anywhere. In each round every node looks up the shards of its neighbours (a join by node) and
    asks to move to the one most of them are in, if those are more than in its own; members move in odd rounds, their
    hubs in even ones, lest they pass each other. A shard takes no more than fills up its room, counting what asks to leave it.
    It ends when neither a round of members nor one of hubs has cut fewer links than the best state so far, which is returned.
    """
    shards = len(rooms)
    both = links.union(links.select("b", "a")).toDF("node", "other")
    linked = nodes.join(both.select("node").distinct(), "node").select("node", "size")
    hubs = links.select(F.col("b").alias("node")).distinct().withColumn("hub", F.lit(1))
    labels = written(linked.join(hubs, "node", "left").select(
        "node", "size", F.coalesce("hub", F.lit(0)).alias("hub"),
        F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")), "labels")
    best, fewest, turn, since = labels, _cut(links, labels), 0, 0
    while fewest and since < 2:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("shard").alias("target")), "other")
        votes = near.groupBy("node", "target").agg(F.count(F.lit(1)).alias("votes"), F.min("other").alias("pull"))
        asked = votes.groupBy("node").agg(
            F.max(F.struct("votes", "target", "pull")).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("target", "votes"))).alias("votes"))  # as many as shards at most
        own = F.coalesce(F.try_element_at("votes", F.col("shard")), F.lit(0))
        moves = labels.filter(F.col("hub") == turn % 2).join(asked, "node").filter(F.col("best.votes") > own).select(
            "node", "size", "shard", F.col("best.target").alias("target"), F.col("best.pull").alias("pull"))
        moves = written(moves, "moves")
        leaving, held = _by_shard(moves, shards), _by_shard(labels, shards)
        taken = _accepted(moves, [max(0, r - h + x) for r, h, x in zip(rooms, held, leaving, strict=True)])
        labels = written(labels.join(taken, "node", "left").select(
            "node", "size", "hub", F.coalesce("target", "shard").alias("shard")), "labels")
        cut, turn = _cut(links, labels), turn + 1
        best, fewest, since = (labels, cut, 0) if cut < fewest else (best, fewest, since + 1)
    labels = best
    return labels.select("node", "size", "shard")


def _filled(pool: DataFrame, rooms: list[int], amount: int, count: int) -> DataFrame:
    """Deals the pool's rows along a line on which each shard has a share in proportion to its room."""
    room = [max(0, r) for r in rooms]
    whole = max(1, sum(room))
    edges, seen = [], 0
    for r in room[:-1]:
        seen += r
        edges.append(seen * amount // whole)
    placed = running(pool, [], "node", F.col("size"), "before", count)
    middle = F.col("before") + F.floor(F.col("size") / 2)
    shard: Column = F.lit(0)
    for edge in edges:
        shard = shard + (middle >= F.lit(int(edge))).cast("int")
    return placed.select("node", "size", shard.alias("shard"))


def _dealt(pool: DataFrame, held: list[int], quota: int) -> tuple[list[DataFrame], list[int]]:
    """Deals the pool in classes, large rows first, each class in proportion to the room that is left."""
    step: Column = F.lit(0)
    for s in STEPS:
        step = step + (F.col("size") * s <= quota).cast("int")
    pool = written(pool.select("node", "size", step.alias("step")), "pool")
    classes = sorted(tuple(r) for r in pool.groupBy("step").agg(F.sum("size"), F.count(F.lit(1))).collect())
    parts = []
    for step, amount, rows in classes:
        rooms = [quota - h for h in held]
        dealt = written(_filled(pool.filter(F.col("step") == step), rooms, amount, rows), "dealt")
        held = [a + b for a, b in zip(held, _by_shard(dealt, len(held)), strict=True)]
        parts.append(dealt)
    return parts, held


def assigned(nodes: DataFrame, links: DataFrame, shards: int, total: int, count: int) -> DataFrame:
    """node, size, shard of all nodes.

    Large nodes without links are dealt first, then linked nodes propagate within the room that is left and stay where it
    suffices, then the rest fills up the shards. The last rows dealt are small, so sizes end within about one small document.
    """
    quota = -(-total // shards)
    alone = nodes.select("node", "size").join(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(),
                                              "node", "left_anti")
    large = F.col("size") * LARGE > quota
    parts, held = _dealt(alone.filter(large), [0] * shards, quota)
    rooms = [max(0, quota - h) for h in held]
    labels = propagated(nodes, links, rooms)
    room = F.element_at(F.array(*[F.lit(int(r)).cast("long") for r in rooms]), F.col("shard") + 1)
    placed = written(running(labels, ["shard"], "node", F.col("size"), "before", count).withColumn(
        "stays", F.col("before") + F.col("size") <= room), "placed")
    kept = placed.filter("stays").select("node", "size", "shard")
    held = [a + b for a, b in zip(held, _by_shard(kept, shards), strict=True)]
    rest = alone.filter(~large).union(placed.filter("NOT stays").select("node", "size"))
    more, _ = _dealt(rest, held, quota)
    whole = kept
    for part in [*parts, *more]:
        whole = whole.union(part)
    return whole


def balanced_shards(nodes: DataFrame, links: DataFrame | None, shards: int) -> DataFrame:
    """``nodes`` with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    ``nodes`` has a unique ``node`` (long) and ``size`` (long, positive); other columns are kept. ``links`` has a
    and b, each pair once; None stands for the links of equal ``grp``. Sizes of shards are near equal; linked nodes
    share a shard as far as that allows. An empty table gives no rows.
    """
    total, count = nodes.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    found = written(equal_text_links(nodes, shards, total) if links is None else links, "links")
    placed = written(assigned(nodes, found, shards, total, count), "placed")
    slots = running(placed, ["shard"], "node", F.lit(1), "slot", count)
    return nodes.join(slots.select("node", "shard", "slot"), "node")


def document_nodes(docs: DataFrame) -> DataFrame:
    """One node per row: node, doc_id, size (UTF-8 bytes plus 8), text_crc32, grp (equal for equal texts).

    A NULL text has no bytes; it is in a group with the empty ones. Repeated rows and NULL ids are nodes of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select("doc_id", text.alias("text")).select(
        F.monotonically_increasing_id().alias("node"), "doc_id",
        (F.octet_length("text").cast("long") + 8).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.unhex(F.sha2("text", 256)).alias("grp"))
    return written(read, "nodes")
