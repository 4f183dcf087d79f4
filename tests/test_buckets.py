"""Keyed state in hash buckets: what a batch touches is replaced, what it does not touch keeps its files."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from assayworks.operators import history as H
from assayworks.sources.buckets import BUCKET, MARK, Buckets
from tests.shapes import NOON

LOG = "k string, ts timestamp, n int, op string"


def log(spark, rows):
    return spark.createDataFrame([(k, NOON + timedelta(minutes=m), n, op) for k, m, n, op in rows], LOG)


def files(path):
    found = {}
    for top, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found[f"{top}/{name}"] = os.stat(f"{top}/{name}").st_mtime_ns
    return found


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def spliced(state, batch):
    return H.scd2_spliced(state, batch, ["k"], ["ts", "n"])


@pytest.fixture
def changes(spark):
    return [(f"k{i % 40}" if i % 13 else None, (i * 37) % 101, i, "del" if i % 11 == 0 else "set") for i in range(400)]


def test_spliced_batches_equal_the_whole_history(spark, folder, changes):
    whole = H.scd2_state(log(spark, changes), ["k"], ["ts", "n"])
    kept = Buckets(f"{folder}/history", ("k",), 8, whole.schema)
    kept.create(H.scd2_state(log(spark, changes[::3]), ["k"], ["ts", "n"]))
    for part in (changes[1::3], changes[2::3], changes[2::3]):  # the last one comes twice
        kept.apply(log(spark, part), spliced)
    assert rows_of(kept.state(spark)) == rows_of(whole)
    assert rows_of(H.live(kept.state(spark), "op = 'del'")) == rows_of(H.scd2(log(spark, changes), ["k"], ["ts", "n"], "op = 'del'"))


def test_late_rows_cut_and_reopen(spark):
    at = lambda m: NOON + timedelta(minutes=m)
    state = H.scd2_state(log(spark, [("a", 0, 1, "set"), ("a", 10, 2, "del"), ("b", 0, 3, "set")]), ["k"], ["ts", "n"])
    after = spliced(state, log(spark, [("a", 5, 4, "set"), ("a", 20, 5, "set")]))
    assert sorted((r.n, r[H.START], r[H.END]) for r in H.live(after, "op = 'del'").collect()) == [
        (1, at(0), at(5)), (4, at(5), at(10)), (5, at(20), None)]  # b is not touched, so not there
    assert spliced(state, log(spark, [])).count() == 0


def test_untouched_buckets_keep_their_files(spark, folder):
    rows = [(f"k{i}", i, i, "set") for i in range(200)]
    kept = Buckets(f"{folder}/latest", ("k",), 16, log(spark, []).schema)
    kept.create(log(spark, rows))
    before = files(kept.path)
    touched = kept.apply(log(spark, [("k3", 999, 1, "new")]), lambda s, b: H.scd1_state(s, b, ["k"], ["ts", "n"]))
    after = files(kept.path)
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert len(touched) == 1 and changed and all(f"{BUCKET}={touched[0]}/" in f for f in changed)
    assert kept.state(spark).filter("k = 'k3'").first().op == "new" and kept.state(spark).count() == 200


def test_only_touched_buckets_are_read(spark, folder):
    kept = Buckets(f"{folder}/latest", ("k",), 16, log(spark, []).schema)
    kept.create(log(spark, [(f"k{i}", i, i, "set") for i in range(200)]))
    some = kept.read(spark, [3, 5])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET}" in plan and len(some.inputFiles()) <= len(files(kept.path))
    assert {r[0] for r in some.select(BUCKET).distinct().collect()} <= {3, 5}


def test_marks_keep_sums_from_counting_twice(spark, folder):
    kinds = spark.createDataFrame([], "k string, total bigint").schema
    kept = Buckets(f"{folder}/sums", ("k",), 4, kinds)
    kept.create(spark.createDataFrame([], kinds))
    add = lambda s, b: s.unionByName(b).groupBy("k").agg(F.sum("total").alias("total"))
    batch = spark.createDataFrame([(f"k{i}", 1) for i in range(50)], kinds)
    assert sorted(kept.apply(batch, add, mark=1)) == [0, 1, 2, 3]
    assert kept.apply(batch, add, mark=1) == [] and kept.state(spark).agg(F.sum("total")).first()[0] == 50
    kept.apply(batch, add, mark=2)
    assert kept.state(spark).agg(F.sum("total")).first()[0] == 100
    assert kept.read(spark).agg(F.min(MARK)).first()[0] == 2
    assert kept.apply(batch.limit(0), add, mark=3) == []
