from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from assayworks.functions.ranged import next_in_ranges
from assayworks.functions.sliced import last_marked, next_in_order
from assayworks.operators import history as H
from tests.shapes import NOON

LOG = "k string, ts timestamp, n int, op string, v int"
RELAXED = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
minutes = st.one_of(st.none(), st.integers(0, 200))


def log(spark, rows):
    return spark.createDataFrame([(k, NOON + timedelta(minutes=m), n, op, v) for k, m, n, op, v in rows], LOG)


def plain(rows):
    return sorted(map(str, rows))


CHANGES = [("a", 5, 1, "set", 10), ("a", 1, 2, "set", 20), ("a", 9, 3, "del", 0), ("b", 4, 4, "set", 1),
           ("b", 4, 5, "set", 2), ("c", 1, 6, "del", 0), ("c", 2, 7, "set", 5)]


def test_scd1_takes_the_last_change_in_any_order(spark):
    for rows in (CHANGES, CHANGES[::-1]):
        found = H.scd1(log(spark, rows), ["k"], ["ts", "n"], "op = 'del'")
        assert sorted((r.k, r.v) for r in found.collect()) == [("b", 2), ("c", 5)]


def test_scd1_state_survives_late_updates_to_deleted_keys(spark):
    state = H.latest(log(spark, CHANGES), ["k"], ["ts", "n"])
    late = log(spark, [("a", 8, 9, "set", 99), ("d", 1, 10, "set", 7)])
    after = H.scd1_state(state, late, ["k"], ["ts", "n"])
    assert sorted((r.k, r.v) for r in H.live(after, "op = 'del'").collect()) == [("b", 2), ("c", 5), ("d", 7)]
    assert plain(H.scd1_state(after, late, ["k"], ["ts", "n"]).collect()) == plain(after.collect())


def test_scd2_validity(spark):
    at = lambda m: NOON + timedelta(minutes=m)
    for rows in (CHANGES, CHANGES[::-1], CHANGES + CHANGES):
        found = H.scd2(log(spark, rows), ["k"], ["ts", "n"], "op = 'del'")
        assert sorted((r.k, r.v, r[H.START], r[H.END] or datetime.max) for r in found.collect()) == [
            ("a", 10, at(5), at(9)), ("a", 20, at(1), at(5)), ("b", 1, at(4), at(4)), ("b", 2, at(4), datetime.max),
            ("c", 5, at(2), datetime.max)]
        assert sorted(r.v for r in H.active(found).collect()) == [2, 5]


@RELAXED
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), minutes, st.integers(0, 3)), max_size=40),
       st.sampled_from(["minute", "hour", "day"]))
def test_sliced_lead_equals_the_plain_window(spark, rows, unit):
    df = spark.createDataFrame(
        [(k, None if m is None else NOON + timedelta(seconds=30 * m), n) for k, m, n in rows], "k string, t timestamp, n int")
    sliced = next_in_order(df, ["k"], ["t", "n"], "nxt", F.date_trunc(unit, "t"))
    window = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "n")))
    assert plain(sliced.collect()) == plain(window.collect())


@RELAXED
@given(st.lists(st.tuples(minutes, st.booleans()), max_size=40), st.sampled_from(["minute", "hour"]))
def test_last_marked_equals_brute_force(spark, rows, unit):
    times = [(i, None if m is None else NOON + timedelta(seconds=40 * m), b) for i, (m, b) in enumerate(rows)]
    df = spark.createDataFrame(times, "i int, t timestamp, b boolean")
    found = {r.i: r.seen for r in last_marked(df, "t", F.col("b"), "seen", F.date_trunc(unit, "t")).collect()}
    marked = [t for _, t, b in times if b and t is not None]
    assert found == {i: max((m for m in marked if t is not None and m <= t), default=None) for i, t, _ in times}


def test_slices_need_a_time_or_an_expression(spark):
    df = spark.range(5).select(F.lit("a").alias("k"), "id")
    with pytest.raises(ValueError):
        next_in_order(df, ["k"], ["id"], "nxt")
    found = next_in_order(df, ["k"], ["id"], "nxt", F.floor(F.col("id") / 2))
    assert {r.id: r.nxt for r in found.collect()} == {0: 1, 1: 2, 2: 3, 3: 4, 4: None}


cells = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 1)),
                  st.one_of(st.none(), st.sampled_from(["x", "y"])))


@RELAXED
@given(st.lists(cells, max_size=12), st.lists(cells, max_size=12))
def test_snapshot_diff_against_brute_force(spark, before, after):
    schema = "k int, a int, b string"
    found = {r.k: r.change for r in H.snapshot_diff(
        spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), ["k"]).collect()}
    expected = {}
    for key in {r[0] for r in before + after}:
        old, new = ({r[1:] for r in rows if r[0] == key} for rows in (before, after))
        expected[key] = "I" if not old else "D" if not new else "N" if old == new and len(old) == 1 else "U"
    assert found == expected


def test_snapshot_diff_on_chosen_columns(spark):
    old = spark.createDataFrame([(1, "x", "p"), (2, "x", "p")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "x", "q"), (2, "y", "p")], "k int, a string, b string")
    assert {r.k: r.change for r in H.snapshot_diff(old, new, ["k"], ["a"]).collect()} == {1: "N", 2: "U"}


def test_dedup(spark):
    df = log(spark, [("a", 1, 1, "x", 1), ("a", 1, 1, "x", 2), ("b", 1, 1, "x", 3)])
    assert sorted(r.v for r in H.deduplicated(df, ["k"], ["v"]).collect()) == [2, 3]
    assert H.deduplicated(df, ["k", "ts"]).count() == 2
    assert "WindowGroupLimit" in H.latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()


def test_schema_policies(spark):
    old = spark.createDataFrame([(1, "x")], "id int, a string")
    new = spark.createDataFrame([("z", "y", 2)], "extra string, a string, id int")
    less = spark.createDataFrame([(3,)], "id int")
    assert plain(H.stacked([old, new, less]).collect()) == plain(
        spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, a string").collect())
    assert plain(H.stacked([old, new, less], "addNewColumns").collect()) == plain(
        spark.createDataFrame([(1, "x", None), (2, "y", "z"), (3, None, None)], "id int, a string, extra string").collect())
    with pytest.raises(ValueError):
        H.stacked([old], "rename")


def test_rename_window(spark):
    row = H.with_new_names(spark.createDataFrame([(1,)], "old int"), {"old": "new"}).first()
    assert (row.old, row.new) == (1, 1)


@RELAXED
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), minutes, st.integers(0, 3)), max_size=40), st.integers(1, 5))
def test_ranged_lead_equals_the_plain_window(spark, rows, ranges):
    df = spark.createDataFrame(
        [(k, None if m is None else NOON + timedelta(seconds=30 * m), n) for k, m, n in rows], "k string, t timestamp, n int")
    found = next_in_ranges(df, ["k"], ["t", "n"], "nxt", ranges)
    window = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "n")))
    assert plain(found.collect()) == plain(window.collect())


def test_a_hot_instant_is_cut(spark):
    """Nine tenths of all rows are of one key and one instant; no range takes much more than its share."""
    df = spark.range(20_000).select(
        F.lit("k").alias("k"), F.when(F.col("id") % 10 > 0, F.lit(NOON)).otherwise(F.timestamp_seconds("id")).alias("t"), "id")
    found = next_in_ranges(df, ["k"], ["t", "id"], "nxt", 8)
    window = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert plain(found.collect()) == plain(window.collect())
    dealt = df.repartitionByRange(8, "k", "t", "id").groupBy(F.spark_partition_id()).count()
    assert max(r[1] for r in dealt.collect()) < 2.5 * 20_000 / 8


def test_outer_slices_carry_marks_over_days(spark):
    times = [(i, NOON + timedelta(hours=i), i in (3, 100)) for i in range(0, 200)]
    df = spark.createDataFrame(times, "i int, t timestamp, b boolean")
    found = {r.i: r.seen for r in last_marked(df, "t", F.col("b"), "seen").collect()}
    assert found == {i: None if i < 3 else NOON + timedelta(hours=3 if i < 100 else 100) for i in range(200)}
    whole = last_marked(spark.range(50).select("id"), "id", F.col("id") % 20 == 7, "seen", F.floor(F.col("id") / 3), lambda c: F.floor(c / 4))
    assert {r.id: r.seen for r in whole.collect()} == {i: None if i < 7 else 7 + 20 * ((i - 7) // 20) for i in range(50)}


@RELAXED
@given(st.lists(cells, max_size=12), st.lists(cells, max_size=12), st.lists(cells, max_size=12))
def test_deltas_lead_from_one_snapshot_to_the_next(spark, first, second, third):
    schema = "k int, a int, b string"
    a, b, c = (spark.createDataFrame(x, schema) for x in (first, second, third))
    deltas = H.snapshot_delta(a, b, ["k"]).withColumn("v", F.lit(1)).unionByName(
        H.snapshot_delta(b, c, ["k"]).withColumn("v", F.lit(2)))

    def read(base, upto=None):
        return {tuple(r) for r in H.merged(base, deltas, ["k"], "v", upto).collect()}  # copies of a row are one content

    assert read(a) == set(third) and read(a, 1) == set(second)
