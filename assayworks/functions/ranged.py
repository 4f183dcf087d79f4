"""Ordered windows over ranges of the whole order, for histories where one key or one moment has most rows.

Rows are dealt by ranges of keys and order together, so a range ends wherever its share of the
rows does: within a key, a minute, or among rows of one instant. Each range gets a
copy of the first row of the next one, which is all a "next row" window needs from beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayworks.sources.scratch import materialised


def next_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, ranges: int | None = None) -> DataFrame:
    """``lead(order[0]) over (partition by keys order by order)``, ascending, NULLs first.

    Range bounds are sampled, and another sample would cut elsewhere, so the dealt rows are written once and read back: a lost
    executor cannot move a bound. Costs a second shuffle and one write of the rows against functions.sliced. Rows equal in all keys and order
    columns cannot be told apart by a bound and stay together. ``ranges`` defaults to the session's shuffle partitions.
    """
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *keys, *order)
    rows = materialised(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    place = F.struct(*keys, *order)
    # One row per range, as many as shuffle partitions.
    heads = rows.groupBy("_range").agg(F.min(place).alias("_head"))
    together = F.pmod(F.hash("_range"), F.lit(1))  # always 0, but no literal
    before = F.lag("_range").over(Window.partitionBy(together).orderBy("_range"))
    markers = heads.select("_head.*", before.alias("_range")).filter(F.col("_range").isNotNull()).withColumn("_marker", F.lit(True))
    whole = rows.withColumn("_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    # Among rows equal in the whole order the marker comes last: it is the next range's.
    follow = Window.partitionBy("_range").orderBy(*keys, *order, "_marker")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.lead(key).over(follow))
    return (
        whole.withColumn(out, F.when(same, F.lead(order[0]).over(follow)))
        .filter(~F.col("_marker"))
        .select(*df.columns, out)
    )
