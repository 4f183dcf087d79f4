"""One summary row per row of a keyed table, from pre-aggregated facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many ways rows with a NULL key are spread in the join.
NULL_LANES = 1024


def aggregate(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Group-by with partial aggregation: a hot key leaves each map task as one row."""
    return fact.groupBy(*keys).agg(*[agg.alias(name) for name, agg in measures.items()])


def summarise(dim: DataFrame, fact: DataFrame, keys: Sequence[str] | str,
              measures: Mapping[str, Column], carry: Sequence[str],
              zero: Sequence[str] = ()) -> DataFrame:
    """Left-joins ``dim`` with ``fact`` aggregated to ``keys``.

    Rows of ``dim`` are never merged or lost: duplicates stay, and a row without
    facts gets 0 for the measures named in ``zero`` and NULL for the others.

    Facts are aggregated before they meet the join, so they shuffle as at most one
    row per key and map task. The join also compares a lane: 0 where all keys are
    set, a hash of the carried columns where a key is NULL. NULL keys never match
    anyway; the lane keeps them from piling up in one task. Because the lane is not part of
    the grouping, both join inputs come straight from an exchange, which is what
    lets AQE split a partition made heavy by many copies of one ``dim`` key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return with_measures(dim, aggregate(fact, keys, measures), keys, list(measures), carry, zero)


def with_measures(dim: DataFrame, totals: DataFrame, keys: Sequence[str], measures: Sequence[str],
                  carry: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """summarise() from ``totals`` that have one row per key already; they are joined as they are."""
    key_missing = F.lit(False)
    for key in keys:
        key_missing = key_missing | F.col(key).isNull()
    lane_zero = F.pmod(F.hash(*keys), F.lit(1))  # always 0, but no literal that Catalyst would fold away
    spread = F.pmod(F.xxhash64(*carry), F.lit(NULL_LANES)).cast("int") if carry else lane_zero
    left = dim.select(
        *keys, *[name for name in carry if name not in keys],
        F.when(key_missing, spread).otherwise(lane_zero).alias("_lane"),
    )
    right = totals.select(*keys, *measures, lane_zero.alias("_lane"))
    return left.join(right, [*keys, "_lane"], "left").select(
        *keys,
        *[name for name in carry if name not in keys],
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) if name in zero else F.col(name)
          for name in measures],
    )


def fold(state: DataFrame, batch: DataFrame, keys: Sequence[str],
         merge: Mapping[str, Column]) -> DataFrame:
    """Adds an aggregated batch to an aggregated state.

    For append-only facts and mergeable measures (sum of counts, sum of sums, max
    of maxima) a refresh then reads the new facts and the state, not the history.
    """
    return aggregate(state.unionByName(batch), keys, merge)
