"""Runs the product once: ``spark-submit ... -m assayworks`` or ``python -m assayworks``."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from assayworks.plans.daily import Product, run_product
from assayworks.session import RECOMMENDED_CONF
from assayworks.sources.landing import BatchLimit


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assayworks", description="One run of the customer and order product.")
    parser.add_argument("--customers", required=True, help="landing folder of customer CSV files")
    parser.add_argument("--orders", required=True, help="landing folder of order CSV files")
    parser.add_argument("--root", required=True, help="folder for tables and stream checkpoints")
    parser.add_argument("--schema", required=True, help="catalog schema of logs and views")
    parser.add_argument("--mode", choices=("drop", "fail"), default="drop")
    parser.add_argument("--freshness-hours", type=int, required=True)
    parser.add_argument("--full-refresh", action="store_true", help="rebuild all tables from all landing files")
    parser.add_argument("--run-id", default=None)
    parser.add_argument("--git-sha", default=None)
    parser.add_argument("--target", default="dev")
    parser.add_argument("--batch-bytes", type=int, default=None, help="bytes a micro-batch may take")
    return parser.parse_args()


def main() -> None:
    chosen = arguments()
    builder = SparkSession.builder.appName("assayworks")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{chosen.schema}`")
    product = Product(
        {"customers": chosen.customers, "orders": chosen.orders}, chosen.root, chosen.schema, mode=chosen.mode,
        freshness_hours=chosen.freshness_hours, target=chosen.target,
        batch=BatchLimit(size=chosen.batch_bytes) if chosen.batch_bytes else None,
    )
    run_id = chosen.run_id or uuid.uuid4().hex
    try:
        run_product(spark, product, run_id, git_sha=chosen.git_sha, full_refresh=chosen.full_refresh)
    finally:
        report(spark, chosen.schema, run_id)


def report(spark: SparkSession, schema: str, run_id: str) -> None:
    """Prints the status and all check rows of a run, as far as the run came to define the views."""
    if spark.catalog.tableExists(f"`{schema}`.ops_current_status_v"):
        spark.table(f"`{schema}`.ops_current_status_v").show(truncate=False, vertical=True)
    if spark.catalog.tableExists(f"`{schema}`.ops_pipeline_run_history_v"):
        rows = spark.table(f"`{schema}`.ops_pipeline_run_history_v").filter(
            F.col("run_id").isin(f"{run_id}-silver", f"{run_id}-gold")).orderBy("checked_at", "pipeline_name")
        rows.show(max(1, rows.count()), False)


if __name__ == "__main__":
    main()
