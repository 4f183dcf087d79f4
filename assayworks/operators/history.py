"""Change data: latest record, full history, snapshot difference, schema changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayworks.functions.ranged import next_in_ranges
from assayworks.functions.sliced import next_in_order

# Names of the validity columns of a full history.
START, END = "__START_AT", "__END_AT"


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, whatever the arrival order.

    Spark limits each key to one row per map task before the shuffle, so a key
    with many versions or copies does not travel whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
    return log.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def deduplicated(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key. With ``order`` the greatest row is kept, else any one of them."""
    return latest(df, keys, order) if order else df.dropDuplicates(list(keys))


def scd1(log: DataFrame, keys: Sequence[str], order: Sequence[str],
         delete_when: str | None = None) -> DataFrame:
    """Last write wins. A key whose last change satisfies ``delete_when`` is absent."""
    return live(latest(log, keys, order), delete_when)


def scd1_state(state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The next state from the last one and a batch in any order.

    Deletes stay in the state as ordinary rows, so a late update older than a
    delete cannot bring the key back. Read the state through live().
    """
    return latest(state.unionByName(batch), keys, order)


def live(state: DataFrame, delete_when: str | None = None) -> DataFrame:
    if delete_when is None:
        return state
    return state.filter(~F.coalesce(F.expr(delete_when), F.lit(False)))


def scd2_state(log: DataFrame, keys: Sequence[str], order: Sequence[str], slice_of: Column | None = None,
               drop_copies: bool = True, ranged: bool = False) -> DataFrame:
    """Every change with its validity: [__START_AT, __END_AT), open-ended when current, both from ``order[0]``.

    Deletes are rows too, so later batches can be spliced in (scd2_spliced); live() of it is the history. Histories are cut into slices
    (see functions.sliced), so no key has to fit in one task; with ``ranged``, rows are dealt by ranges of keys and
    order (see functions.ranged), so no moment of a key has to either. Rows equal in every column
    are one change that was delivered more than once; they are merged first, map-side, unless ``drop_copies`` is off
    because the log is known to have none.
    """
    changes = log.distinct() if drop_copies else log
    ended = next_in_ranges(changes, keys, order, END) if ranged else next_in_order(changes, keys, order, END, slice_of)
    return ended.withColumn(START, F.col(order[0]))


def scd2(log: DataFrame, keys: Sequence[str], order: Sequence[str], delete_when: str | None = None,
         slice_of: Column | None = None, drop_copies: bool = True, ranged: bool = False) -> DataFrame:
    """Every version with its validity (see scd2_state). A delete ends the version before it and is no version itself."""
    return live(scd2_state(log, keys, order, slice_of, drop_copies, ranged), delete_when)


def scd2_spliced(state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                 slice_of: Column | None = None) -> DataFrame:
    """The next state of the keys that a batch touches, from their last state (scd2_state) and the batch in any order.

    A late change cuts the interval it falls into: the version before it ends where it starts, and it ends where the
    next one starts. A change that fills the time after a delete opens the key again. Intervals the batch does not fall into keep their bounds.
    Changes the state already has change nothing, so a batch can be applied again after a failure. NULL keys are keys.

    Only rows of touched keys go on, and meet the changes in slices of time. Keys the batch does not touch are not returned; see
    sources.buckets for where they stay.
    """
    columns = [c for c in state.columns if c not in (START, END)]
    touched = batch.select(*[F.col(k).alias(f"_touched_{k}") for k in keys]).distinct()
    met = F.lit(True)
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"_touched_{k}"))
    known = state.join(touched, met, "left_semi")
    return scd2_state(known.select(*columns).unionByName(batch.select(*columns)), keys, order, slice_of)


def active(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: Sequence[str],
                  compare: Sequence[str] | None = None) -> DataFrame:
    """Keys with I (only current), D (only previous), U (content differs) or N (same).

    The snapshots are stacked and aggregated by key rather than joined: partial
    aggregation absorbs repeated keys, which a join would pair up. Content is
    compared by 128 bits of hash; NULL keys and values equal themselves. A key that occurs more
    than once on a side is N only when all its rows agree.
    """
    compared = list(compare) if compare is not None else [c for c in current.columns if c not in keys]
    flags = [F.col(c).isNull().cast("byte") for c in compared]  # hashes skip NULLs, positions would blur
    first = F.xxhash64(*compared, *flags) if compared else F.lit(0).cast("long")
    second = F.xxhash64(F.lit("second"), *flags, *reversed([F.col(c) for c in compared]))

    def side(df: DataFrame, is_current: bool) -> DataFrame:
        return df.select(*keys, F.lit(is_current).alias("_cur"), first.alias("_h1"), second.alias("_h2"))

    grouped = side(previous, False).unionByName(side(current, True)).groupBy(*keys).agg(
        F.count_if(~F.col("_cur")).alias("_before"), F.count_if(F.col("_cur")).alias("_after"),
        F.min("_h1").alias("_lo1"), F.max("_h1").alias("_hi1"),
        F.min("_h2").alias("_lo2"), F.max("_h2").alias("_hi2"),
    )
    same = (F.col("_lo1") == F.col("_hi1")) & (F.col("_lo2") == F.col("_hi2"))
    change = (
        F.when(F.col("_before") == 0, F.lit("I")).when(F.col("_after") == 0, F.lit("D"))
        .when(same, F.lit("N")).otherwise(F.lit("U"))
    )
    return grouped.select(*keys, change.alias("change"))


def _on(keys: Sequence[str], prefix: str) -> Column:
    met = F.lit(True)
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return met


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def snapshot_delta(previous: DataFrame, current: DataFrame, keys: Sequence[str],
                   compare: Sequence[str] | None = None) -> DataFrame:
    """What turns one snapshot into the next: the rows of ``current`` that are new (I) or differ (U), and removed keys (D).

    Columns are those of ``current`` and ``change``; a D row has its keys only. NULL keys are keys. Unchanged rows are
    not in it, so its size is that of the change. A key that occurs more than once is replaced with all its rows.
    """
    changes = snapshot_diff(previous, current, keys, compare).filter(F.col("change") != "N")
    told = _prefixed(changes, keys, "_k_")
    written = current.join(told, _on(keys, "_k_")).select(*current.columns, "change")
    gone = changes.filter(F.col("change") == "D")
    return written.unionByName(gone, allowMissingColumns=True)


def merged(base: DataFrame, deltas: DataFrame, keys: Sequence[str], version: str, upto: int | None = None) -> DataFrame:
    """A snapshot read from an older one and the deltas since (snapshot_delta with a growing ``version`` number).

    Of each key the newest delta counts, up to version ``upto`` if given; keys without one come from the base. Deltas are
    reduced to one row per key, map-side, before they meet the base, which is only filtered.
    """
    known = deltas if upto is None else deltas.filter(F.col(version) <= upto)
    newest = _prefixed(known.groupBy(*keys).agg(F.max(version).alias("_newest")), keys, "_k_")
    untouched = base.join(newest, _on(keys, "_k_"), "left_anti")
    put = known.join(newest, _on(keys, "_k_") & (F.col(version) == F.col("_newest"))).filter(F.col("change") != "D")
    return untouched.unionByName(put.select(*base.columns))


def stacked(frames: Sequence[DataFrame], evolution: Literal["none", "addNewColumns"] = "none") -> DataFrame:
    """Unions batches by name under a schema policy.

    "none" keeps the first frame's columns and ignores others; "addNewColumns"
    keeps all, NULL where a batch lacks one. Columns are never dropped or renamed.
    """
    if evolution == "addNewColumns":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if evolution != "none":
        raise ValueError(f"unknown evolution {evolution!r}")
    base = frames[0]
    fitted = [base] + [
        f.select(*[F.col(c.name) if c.name in f.columns else F.lit(None).cast(c.dataType).alias(c.name)
                   for c in base.schema.fields])
        for f in frames[1:]
    ]
    return reduce(DataFrame.unionByName, fitted)


def with_new_names(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Publishes columns under old and new names during a migration window."""
    return df.select("*", *[F.col(old).alias(new) for old, new in renames.items()])
