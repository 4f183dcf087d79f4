"""Ordered windows over histories of any length.

A window needs one whole group in one task, so a key that holds a large part of
the table would stall. Both functions here cut the order into slices (for
example minutes), run the window per slice, and hand one marker row per slice to
its neighbour, where it stands for everything beyond the slice. The result
equals the plain window's; the largest task holds one slice of one key. There
is no join, and the rows themselves are shuffled once. A slice that holds most rows is cut by functions.ranged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def default_slice(df: DataFrame, order: str) -> Column:
    """The minute of a time column: fine enough that a year of one key is half a million slices."""
    if _is_time(df.select(order)):
        return F.date_trunc("minute", order).cast("timestamp_ntz")
    raise ValueError(f"{order} is no time column: pass a slice, a non-decreasing expression of {order}")


def _is_time(one: DataFrame) -> bool:
    return isinstance(one.schema[0].dataType, (DateType, TimestampType, TimestampNTZType))


def _sliced(df: DataFrame, order: str, slice_of: Column | None) -> DataFrame:
    return df.withColumn("_slice", default_slice(df, order) if slice_of is None else slice_of)


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                  slice_of: Column | None = None) -> DataFrame:
    """``lead(order[0]) over (partition by keys order by order)``, ascending, NULLs first.

    ``slice_of`` must be a non-decreasing expression of ``order[0]``. The first
    row of a slice is copied to the end of the key's slice before it, where it
    is the successor of the last row.
    """
    lead_column = order[0]
    sliced = _sliced(df, lead_column, slice_of).withColumn("_marker", F.lit(False))
    heads = sliced.groupBy(*keys, "_slice").agg(F.min(lead_column).alias(lead_column))
    across = Window.partitionBy(*keys).orderBy("_slice")
    markers = (
        heads.withColumn("_place", F.row_number().over(across))
        .withColumn("_before", F.lag("_slice").over(across))
        .filter(F.col("_place") > 1)
        .select(*keys, lead_column, F.col("_before").alias("_slice"), F.lit(True).alias("_marker"))
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        sliced.unionByName(markers, allowMissingColumns=True)
        .withColumn(out, F.lead(lead_column).over(inside))
        .filter(~F.col("_marker"))
        .select(*df.columns, out)
    )


def last_marked(df: DataFrame, order: str, marked: Column, out: str, slice_of: Column | None = None,
                outer_of: Callable[[Column], Column] | None = None) -> DataFrame:
    """The greatest ``order`` of a marked row at or before each row; equal orders see each other.

    A prefix scan over a tree: rows in slices, slices in outer slices, outer slices in all. Each level sums its marks up for
    the level above and gets back, as one marker row, what lies before it. ``slice_of`` must be a non-decreasing
    expression of ``order``, ``outer_of`` one of the slice; by default they are the hour and the day of a time. The largest task holds the
    rows of one slice, the slices of one outer slice, or one row per outer slice (a hundred years have 36,525 days).
    """
    if slice_of is None and outer_of is None:
        default_slice(df, order)  # refuses what is no time
        slice_of = F.date_trunc("hour", order).cast("timestamp_ntz")
    if outer_of is None:
        outer_of = (lambda c: F.date_trunc("day", c).cast("timestamp_ntz")) if _is_time(df.select(slice_of)) else (lambda c: c)
    sliced = _sliced(df, order, slice_of).select(
        "*", F.when(marked, F.col(order)).alias("_mark"), F.lit(False).alias("_marker")
    )
    tails = sliced.groupBy("_slice").agg(F.max("_mark").alias("_mark")).withColumn("_outer", outer_of(F.col("_slice")))
    outer_tails = tails.groupBy("_outer").agg(F.max("_mark").alias("_mark"))
    together = F.pmod(F.hash("_outer"), F.lit(1))  # always 0, but no literal: the outer slices of all time are hashed to one place
    outer_before = _before(outer_tails, [together], "_outer").select("_outer", "_mark").filter(F.col("_mark").isNotNull())
    # A marker has a NULL slice or order and so comes first.
    levels = tails.unionByName(outer_before, allowMissingColumns=True)
    before = _before(levels, ["_outer"], "_slice").filter(F.col("_slice").isNotNull() & F.col("_mark").isNotNull())
    markers = before.select("_slice", "_mark", F.lit(True).alias("_marker"))
    upto = Window.partitionBy("_slice").orderBy(order)
    return (
        sliced.unionByName(markers, allowMissingColumns=True)
        .withColumn(out, F.max("_mark").over(upto))
        .filter(~F.col("_marker"))
        .select(*df.columns, out)
    )


def _before(tails: DataFrame, within: Sequence[Column | str], order: str) -> DataFrame:
    """Replaces each mark by the greatest one of the rows before it."""
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return tails.withColumn("_mark", F.max("_mark").over(earlier))
