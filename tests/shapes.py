"""Small frames in the product's shapes."""

from datetime import datetime
from decimal import Decimal

NOON = datetime(2026, 5, 19, 12, 0, 0)
LINEAGE = "_source_file string, _ingested_at timestamp"
CUSTOMERS = f"customer_id string, name string, email string, country_code string, phone string, {LINEAGE}"
ORDERS = f"order_id string, customer_id string, amount decimal(10,2), order_date timestamp, status string, {LINEAGE}"
CHECKS = ("run_id string, pipeline_name string, check_name string, check_type string, status string, "
          "message string, checked_at timestamp")
RUNS = ("job_run_id string, recorded_at timestamp, catalog_name string, schema_name string, bundle_target string, "
        "git_sha string, started_at timestamp, job_run_url string")
TASKS = "job_run_id string, ord int, task_key string, result_state string, state_message string"
JOB_LOG = ("job_run_id string, recorded_at timestamp, catalog_name string, schema_name string, bundle_target string, "
           "git_sha string, overall_status string, failed_task_key string, failure_message string, "
           "started_at timestamp, completed_at timestamp, duration_seconds bigint, job_run_url string")


def customer(spark, **values):
    row = {"customer_id": "k1", "name": "Ann", "email": "ann@shop.example", "country_code": "NO", "phone": "1"} | values
    return customers(spark, [tuple(row.values())])


def customers(spark, rows):
    return spark.createDataFrame([(*r, "f.csv", NOON) for r in rows], CUSTOMERS)


def order(spark, **values):
    row = {"order_id": "n1", "customer_id": "k1", "amount": Decimal("9.99"), "order_date": NOON, "status": "paid"} | values
    return orders(spark, [tuple(row.values())])


def orders(spark, rows):
    return spark.createDataFrame([(*r, "f.csv", NOON) for r in rows], ORDERS)


def values(df, column):
    return [row[column] for row in df.collect()]
