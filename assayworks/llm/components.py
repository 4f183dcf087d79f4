"""Connected components of a link table: union-find within tasks, then alternating stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import written

LINKS_PER_TASK = 200_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one task; every node but the roots with its root, the smallest of its set."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    pairs = [(x, root(x)) for x in list(parent) if root(x) != x]
    yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _thinned(links: DataFrame, count: int) -> tuple[DataFrame, bool]:
    """A forest of the links of each task, in passes over ever fewer tasks as forests shrink, and whether one task was left."""
    while True:
        tasks = -(-count // LINKS_PER_TASK)
        forest = written(links.repartition(max(1, tasks)).mapInPandas(_forest, "a long, b long"), "forest")
        left = forest.count()
        if tasks <= 1 or left > count // 2:
            return forest, tasks <= 1
        links, count = forest, left


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of the links ``a``, ``b`` (long).

    NULL ends and loops are ignored; a table without links gives no rows. Each round halves
    distances, joins by node only and writes its links, so no component meets in one task or the driver. Joins name "merge", as
    the files of links are far smaller than what a broadcast of them takes on the driver.
    Links are first spread over as few tasks as LINKS_PER_TASK asks for, so that union-find does most of the work there.
    """
    proper = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    proper = written(proper, "proper")
    now, whole = _thinned(proper, proper.count())
    last, mark = None, None if whole else _signature(now)
    while mark != last:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        under = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(under.hint("merge"), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = written(small.union(under.select("a", F.col("m").alias("b"))).distinct(), "stars")
        last, mark = mark, _signature(stars)
        now = stars
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())
