"""Compares plan shapes: one pass against one action per check, one write against two scans.

BENCH_COPIES multiplies the rows of the driver's tables (new keys per copy), so that work rather than
start-up is measured. Inputs are written once to a new scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assayworks.operators import history as H  # noqa: E402
from assayworks.operators import routing as R  # noqa: E402
from assayworks.operators.summary import summarise  # noqa: E402
from assayworks.plans import adapters as A  # noqa: E402
from assayworks.plans import customer_orders as P  # noqa: E402
from assayworks.plans import daily  # noqa: E402
from assayworks.session import local_session  # noqa: E402
from assayworks.sources.scratch import scratch_path  # noqa: E402


def copies(df: DataFrame, key: str, step: int, times: int) -> DataFrame:
    numbered = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_copy"))
    return numbered.withColumn(key, F.col(key) + F.col("_copy") * step).drop("_copy")


def timed(work) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        work()
        best = min(best, time.perf_counter() - start)
    return round(best, 2)


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def audits(spark: SparkSession, bronze: DataFrame) -> dict[str, float]:
    silver, bad = R.split(P.orders_silver(bronze), P.ORDER_RULES)
    data = f"{scratch_path(spark, 'audit')}"
    silver.write.parquet(f"{data}/silver")
    bad.write.parquet(f"{data}/rejected")
    silver, bad = spark.read.parquet(f"{data}/silver"), spark.read.parquet(f"{data}/rejected")
    summary = P.customer_order_summary(P.customers_silver(A.customers_bronze(spark, SF)), silver)
    summary.write.parquet(f"{data}/summary")
    summary = spark.read.parquet(f"{data}/summary")

    def separate() -> None:
        silver.count()
        silver.agg(F.max("_ingested_at")).collect()
        bronze.count()
        bad.count()
        summary.count()
        summary.filter("customer_id IS NULL").count()
        summary.filter("order_count < 0").count()

    def one_pass() -> None:
        daily.silver_results(P.ORDERS_CONTRACT, silver, bronze, bad, run_id="r", pipeline="p",
                             freshness_hours=1, as_of="2001-08-01 00:00:00").collect()
        daily.summary_results(summary, run_id="r", as_of="2001-08-01 00:00:00").collect()

    return {"audit_one_action_per_check": timed(separate), "audit_one_pass": timed(one_pass)}


def routing(spark: SparkSession, bronze: DataFrame) -> dict[str, float]:
    def two_scans() -> None:
        out = scratch_path(spark, "split")
        sides = R.split(P.orders_silver(bronze), P.ORDER_RULES)
        sides.silver.write.parquet(f"{out}/silver")
        sides.rejected.write.parquet(f"{out}/rejected")

    def one_write() -> None:
        routed = R.route(P.orders_silver(bronze), P.ORDER_RULES)
        routed.write.partitionBy(R.ROUTE).parquet(scratch_path(spark, "routed"))

    return {"split_two_scans": timed(two_scans), "split_one_routed_write": timed(one_write)}


def hot_history(events: DataFrame) -> dict[str, float]:
    """Half of all changes belong to one key."""
    changes = events.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    keys, order = ["user_id"], ["ts", "event_id"]
    window = Window.partitionBy(*keys).orderBy(*order)
    return {
        "scd2_plain_window": timed(lambda: sink(changes.withColumn(H.END, F.lead("ts").over(window)))),
        "scd2_sliced": timed(lambda: sink(H.scd2(changes, keys, order, drop_copies=False))),
        "scd2_sliced_copies_merged": timed(lambda: sink(H.scd2(changes, keys, order))),
    }


def hot_summary(spark: SparkSession, customers: DataFrame, orders: DataFrame) -> dict[str, float]:
    """Half of all dimension rows are copies of one key; no broadcast."""
    dims = customers.withColumn("k", F.when(F.col("c_custkey") % 2 == 0, F.lit(7)).otherwise(F.col("c_custkey")))
    facts = orders.withColumnRenamed("o_custkey", "k")
    measures = {"n": F.count(F.lit(1)), "last": F.max("o_orderdate")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    plain = dims.join(facts.groupBy("k").agg(*[m.alias(n) for n, m in measures.items()]), "k", "left")
    laned = summarise(dims, facts, "k", measures, ["c_name", "c_acctbal", "c_mktsegment"], zero=["n"])
    return {"summary_plain_join": timed(lambda: sink(plain)), "summary_laned_join": timed(lambda: sink(laned))}


SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def main() -> None:
    times, cores = int(os.environ.get("BENCH_COPIES", "40")), os.environ.get("BENCH_CPUS", "8")
    spark = local_session("shapes", cores=cores, shuffle_partitions=4 * int(cores))
    data = scratch_path(spark, "inputs")
    sizes = {"orders": "o_orderkey", "events": "event_id", "customer": "c_custkey"}
    for name, key in sizes.items():
        copies(A.table(spark, SF, name), key, 10_000_000, times).repartition(int(cores)).write.parquet(f"{data}/{name}.parquet")
    events = spark.read.parquet(f"{data}/events.parquet").drop("props")
    bronze = A.orders_bronze(spark, data)
    result = {**audits(spark, bronze), **routing(spark, bronze), **hot_history(events),
              **hot_summary(spark, A.table(spark, data, "customer"), A.table(spark, data, "orders"))}
    print(json.dumps({"copies": times, "rows": {n: A.table(spark, data, n).count() for n in sizes}, "seconds": result}))
    spark.stop()


if __name__ == "__main__":
    main()
