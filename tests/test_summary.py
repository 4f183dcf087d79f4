import random
from collections import defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayworks.functions.lookup import joined, mapped
from assayworks.operators.eventlog import expectation_totals
from assayworks.operators.summary import summarise
from assayworks.plans import customer_orders as P
from tests.shapes import NOON, customer, customers, orders

DAYS = [datetime(2026, month, 1) for month in (1, 3, 2)]


def test_counts_sums_and_last_dates(spark):
    silver = P.customers_silver(customers(spark, [("k1", "a", "a@b.c", "NO", "1"), ("k2", "b", "b@b.c", "US", "1")]))
    bought = P.orders_silver(orders(spark, [
        (f"n{i}", "k1", Decimal(10 * (i + 1)), day, "paid") for i, day in enumerate(DAYS)]
        + [("n9", "stranger", Decimal(5), NOON, "paid")]))
    rows = {r.customer_id: r for r in P.customer_order_summary(silver, bought).collect()}
    assert set(rows) == {"k1", "k2"}
    assert (rows["k1"].order_count, rows["k1"].total_amount, rows["k1"].last_order_date) == (3, Decimal("60.00"), DAYS[1])
    assert (rows["k2"].order_count, rows["k2"].total_amount, rows["k2"].last_order_date) == (0, None, None)


def test_columns_without_orders(spark):
    none = P.orders_silver(orders(spark, [("n", "k", Decimal(1), NOON, "x")]).filter("false"))
    summary = P.customer_order_summary(P.customers_silver(customer(spark)), none)
    assert tuple(summary.columns) == P.SUMMARY_COLUMNS
    assert dict(summary.dtypes)["total_amount"] == "decimal(20,2)"
    assert summary.count() == 1


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_nulls_and_copies_against_brute_force(spark, broadcast):
    """A third of the rows share one key, a third have none."""
    rng = random.Random(7)
    keys = lambda: rng.choice(["hot", None, f"k{rng.randrange(50)}"])
    dims = [(keys(), f"name{i % 5}") for i in range(600)]
    facts = [(keys(), rng.randrange(100)) for _ in range(3000)]
    totals = defaultdict(lambda: [0, None])
    for key, amount in facts:
        if key is not None:
            totals[key][0] += 1
            totals[key][1] = (totals[key][1] or 0) + amount
    expected = sorted((str(k), n, *(totals[k] if k in totals else (0, None))) for k, n in dims)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = summarise(
            spark.createDataFrame(dims, "id string, name string"), spark.createDataFrame(facts, "id string, v long"),
            "id", {"n": F.count(F.lit(1)), "total": F.sum("v")}, ["name"], zero=["n"]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((str(r.id), r.name, r.n, r.total) for r in found) == expected


@pytest.fixture
def small_skew(spark):
    """No broadcasts, and partitions of a few kilobytes already count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(share, key):
    """Every ``share``-th id becomes ``key``."""
    return F.when(F.col("id") % share == 0, F.lit(key)).otherwise(F.col("id"))


def test_hot_dimension_key_is_split_by_aqe(spark, small_skew):
    dims = spark.range(0, 60000, numPartitions=8).select(hot(3, 1).alias("k"), F.md5(F.col("id").cast("string")).alias("name"))
    facts = spark.range(0, 60000, numPartitions=8).select((F.col("id") % 7000).alias("k"), F.lit(1).alias("v"))
    summary = summarise(dims, facts, "k", {"n": F.count("v")}, ["name"], zero=["n"])
    assert len(summary.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in executed(summary)


def test_null_dimension_keys_are_spread(spark, small_skew):
    dims = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("name"))
    facts = spark.range(0, 60000).select((F.col("id") % 7000).alias("k"))
    summary = summarise(dims, facts, "k", {"n": F.count(F.lit(1))}, ["name"], zero=["n"])
    sizes = [r[0] for r in summary.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 60000 and max(sizes) < 60000 / 3
    assert summary.filter("k IS NULL AND n = 0").count() == 20000


def test_hot_code_in_a_lookup_is_split_by_aqe(spark, small_skew):
    codes = spark.range(0, 60000, numPartitions=8).select(hot(3, 7).alias("code"), F.md5(F.col("id").cast("string")).alias("x"))
    table = spark.range(0, 60000, numPartitions=8).select(F.col("id").alias("code"), F.lit("label").alias("label"))
    found = joined(codes, "code", table, "code", "label", "none", "label")
    assert len(found.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in executed(found)


def test_busy_pipeline_in_the_event_log_leaves_each_task_as_one_row(spark, small_skew):
    ids = spark.range(0, 30000, numPartitions=8)
    events = ids.select(
        F.concat(F.lit("p"), hot(3, 0) % 100).alias("pipeline_name"),
        F.timestamp_seconds("id").alias("timestamp"),
        F.when(F.col("id") < 200, F.lit("create_update")).otherwise(F.lit("flow_progress")).alias("event_type"),
        F.struct(F.concat(F.lit("u"), F.col("id") % 1).alias("update_id"), F.lit("f").alias("flow_name")).alias("origin"),
        F.when(F.col("id") < 200, F.lit('{"create_update":{"update_id":"u0"}}')).otherwise(F.concat(
            F.lit('{"flow_progress":{"data_quality":{"expectations":[{"name":"r","passed_records":1,"failed_records":0,"x":"'),
            F.md5(F.col("id").cast("string")), F.lit('"}]}}}'))).alias("details"))
    totals = expectation_totals(events)
    assert sum(r.total_passed for r in totals.collect()) == 29800
    plan = executed(totals)
    assert "Join" not in plan and "partial_sum" in plan  # sums are made before the shuffle; nothing is paired


def test_scan_reads_only_needed_columns(spark):
    from assayworks.plans import adapters as A
    plan = P.customer_order_summary(
        P.customers_silver(A.customers_bronze(spark, "/root/testdata/sf0.001")),
        P.orders_silver(A.orders_bronze(spark, "/root/testdata/sf0.001")),
    )._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "o_orderpriority" not in plan and "o_orderstatus" not in plan


def test_lookups(spark):
    codes = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    table = spark.createDataFrame([("a", "first"), ("c", "third")], "code string, label string")
    by_table = joined(codes, "code", table, "code", "label", "none", "label").collect()
    by_map = codes.select("code", mapped("code", {"a": "first", "c": "third"}, "none").alias("label")).collect()
    order = lambda rows: sorted(map(str, rows))
    assert order(by_table) == order(by_map) == order(
        spark.createDataFrame([("a", "first"), ("b", "none"), (None, "none")], "code string, label string").collect())
    many = {"a": "first", **{str(i): "x" for i in range(500)}}
    assert sorted(r.v for r in codes.select(mapped("code", many, "none").alias("v")).collect()) == ["first", "none", "none"]
    assert codes.select(mapped("code", {}, "none").alias("v")).distinct().count() == 1
