"""The driver's tables in the shapes the operators expect.

Plain projections over whole tables. Defects are made by key arithmetic so that
every rule and status has rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_TIME = "2001-08-01 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) AS customer_id",
        "concat('  ', lower(c_mktsegment), ' buyer  ') AS name",
        "CASE WHEN c_custkey % 10 = 3 THEN 'not-an-email' WHEN c_custkey % 10 = 7 THEN NULL "
        "ELSE upper(concat('user', c_custkey, '@example.com')) END AS email",
        "element_at(array('NO', 'SE', 'DK', 'DE', 'GB', 'US', 'CA', 'ZZ'), c_nationkey % 8 + 1) AS country_code",
        "CASE WHEN c_custkey % 8 <> 0 THEN concat('+47', c_custkey) END AS phone",
        "'landing/customers' AS _source_file",
        f"timestamp_ntz '{INGEST_TIME}' AS _ingested_at",
    )


def customers_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze customers without lineage."""
    return customers_bronze(spark, sf_dir).drop("_source_file", "_ingested_at")


def orders_columns(df: DataFrame) -> DataFrame:
    """Bronze columns without lineage. Every twentieth customer's orders go to the next one, so some have none."""
    return df.selectExpr(
        "cast(o_orderkey as string) AS order_id",
        "cast(if(o_custkey % 20 = 0, o_custkey + 1, o_custkey) as string) AS customer_id",
        "CASE WHEN o_orderkey % 50 = 11 THEN NULL WHEN o_orderkey % 15 = 9 "
        "THEN -cast(o_totalprice AS decimal(10,2)) ELSE cast(o_totalprice AS decimal(10,2)) END AS amount",
        "o_orderdate AS order_date",
        "CASE WHEN o_orderkey % 15 <> 10 THEN concat(' ', lower(o_orderstatus), ' ') END AS status",
    )


def orders_lineage(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "'landing/orders' AS _source_file", "order_date AS _ingested_at")


def orders_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_lineage(orders_columns(table(spark, sf_dir, "orders")))


def orders_bronze_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders where some ids are NULL, for critical rules that must not abort."""
    return orders_bronze(spark, sf_dir).selectExpr(
        "CASE WHEN order_id % 40 <> 7 THEN order_id END AS order_id",
        "CASE WHEN order_id % 60 <> 13 THEN customer_id END AS customer_id",
        "amount", "order_date", "status", "_source_file", "_ingested_at",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups start an update; other events report progress, some without or with broken results."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('pipeline_', user_id % 3) AS pipeline_name",
        "ts AS timestamp",
        "CASE WHEN event_type = 'signup' AND user_id % 3 <> 2 THEN 'create_update' ELSE 'flow_progress' END AS event_type",
        "named_struct('update_id', concat('u', user_id % 7), 'flow_name', concat('flow_', user_id % 2)) AS origin",
        """CASE
             WHEN event_type = 'signup' THEN concat('{"create_update":{"update_id":"u', user_id % 7, '"}}')
             WHEN event_type = 'view' THEN '{"flow_progress":{"status":"RUNNING"}}'
             WHEN event_type = 'error' THEN '{"flow_progress":{"data_quality":{"expectations":[{'
             ELSE concat(
               '{"flow_progress":{"data_quality":{"expectations":[{"name":"amount_ok","dataset":"d",',
               '"passed_records":', get_json_object(props, '$.k'), ',"failed_records":', event_id % 3, '},',
               '{"name":"id_ok","dataset":"d","passed_records":', event_id % 11, ',"failed_records":0},',
               '{"name":"unmeasured","dataset":"d","passed_records":1}]}}}')
           END AS details""",
    )


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a check row; ten events make a run."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id div 10 AS string) AS run_id",
        "concat('pipeline_', user_id % 3) AS pipeline_name",
        "event_type AS check_name",
        "CASE WHEN event_id % 3 = 0 THEN 'expectation' ELSE 'direct' END AS check_type",
        "CASE WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'signup' AND event_id % 25 = 4 "
        "THEN 'WARN' ELSE 'PASS' END AS status",
        "concat('event ', event_id) AS message",
        "ts AS checked_at",
    )


def checks_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check rows whose runs are hours: all checks of an hour are of one run."""
    return check_log(spark, sf_dir).withColumn("run_id", F.date_format("checked_at", "yyyyMMddHH"))


def contract_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a contract row; rows of one hour share a check time."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id div 10 AS string) AS run_id",
        "concat('table_', user_id % 3) AS table_name",
        "event_type AS check_name",
        "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS status",
        "cast(event_id % 5 AS string) AS actual_value",
        "'> 0' AS expected_value",
        "cast(date_trunc('hour', ts) AS timestamp_ntz) AS checked_at",
    )


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four events make a run: it starts with the first and is recorded up to an hour after the last."""
    runs = table(spark, sf_dir, "events").groupBy(F.expr("event_id div 4").alias("run")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("last_at"))
    return runs.selectExpr(
        "cast(run AS string) AS job_run_id",
        "last_at + make_dt_interval(0, 0, 0, run % 3600) AS recorded_at",
        "'shop' AS catalog_name",
        "element_at(array('dev', 'pr', 'prod'), cast(run % 3 AS int) + 1) AS schema_name",
        "element_at(array('dev', 'pr', 'prod'), cast(run % 3 AS int) + 1) AS bundle_target",
        "CASE WHEN run % 9 <> 0 THEN substring(md5(cast(run AS string)), 1, 7) END AS git_sha",
        "started_at",
        "concat('https://jobs.example/runs/', run) AS job_run_url",
    )


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four events of a run as its tasks, the last one the finalizer; tasks of every 50th run name no known run."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat(if((event_id div 4) % 50 = 0, 'unlisted-', ''), event_id div 4) AS job_run_id",
        "cast(event_id % 4 AS int) AS ord",
        "element_at(array('run_customers', 'run_orders', 'run_gold', 'finalize_ops_status'), "
        "cast(event_id % 4 AS int) + 1) AS task_key",
        "CASE WHEN event_type <> 'error' THEN 'SUCCESS' WHEN value > 100 THEN 'TIMEDOUT' ELSE 'FAILED' END AS result_state",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat(repeat('x', cast(event_id % 600 AS int)), props) END AS state_message",
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a user's record; errors delete it."""
    return table(spark, sf_dir, "events").selectExpr("user_id", "ts", "event_id", "event_type", "value")


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 17 = 3, -o_orderkey, o_orderkey) AS o_orderkey", "o_custkey", "CASE WHEN o_orderkey % 13 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus",
        "CASE WHEN o_orderkey % 29 <> 6 THEN o_totalprice END AS o_totalprice",
    )


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 19 = 5, -o_orderkey - 1, o_orderkey) AS o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


def orders_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot between orders_before and orders_after: other keys are missing, other rows differ."""
    return table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 23 = 7, -o_orderkey - 2, o_orderkey) AS o_orderkey", "o_custkey",
        "CASE WHEN o_orderkey % 31 = 4 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus",
        "CASE WHEN o_orderkey % 29 <> 5 THEN o_totalprice END AS o_totalprice")


def in_one_hour(column: str) -> str:
    """A time moved into the first hour of 2024, keeping its minute, second and fraction."""
    return f"timestamp_ntz '2024-01-01 00:00:00' + ({column} - cast(date_trunc('hour', {column}) AS timestamp_ntz))"
