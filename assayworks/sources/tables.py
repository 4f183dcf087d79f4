"""Log tables, versioned table refreshes and serving views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the three logs. Each log is partitioned by the day of
# one of its times, so readers of recent days skip the rest.
LOGS = {
    "ops_pipeline_run_log": (
        "run_id STRING, pipeline_name STRING, check_name STRING, check_type STRING, status STRING, "
        "message STRING, checked_at TIMESTAMP", "checked_at",
    ),
    "ops_contract_check_log": (
        "run_id STRING, table_name STRING, check_name STRING, status STRING, actual_value STRING, "
        "expected_value STRING, checked_at TIMESTAMP", "checked_at",
    ),
    "ops_job_run_log": (
        "job_run_id STRING, recorded_at TIMESTAMP, catalog_name STRING, schema_name STRING, "
        "bundle_target STRING, git_sha STRING, overall_status STRING, failed_task_key STRING, "
        "failure_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, "
        "duration_seconds BIGINT, job_run_url STRING", "recorded_at",
    ),
}
DAY = "log_day"

def qualified(*parts: str | None) -> str:
    return ".".join(f"`{p}`" for p in parts if p)


def ensure_logs(spark: SparkSession, schema: str) -> None:
    """Creates missing log tables in a catalog schema; existing ones are left alone."""
    for name, (columns, _) in LOGS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified(schema, name)} ({columns}, {DAY} DATE) "
            f"USING PARQUET PARTITIONED BY ({DAY})"
        )


def append_log(rows: DataFrame, schema: str, name: str) -> None:
    """Appends rows computed by a query; they go from executors to storage."""
    _, time_column = LOGS[name]
    columns = [F.col(c).cast(kind).alias(c) for c, kind in (d.split() for d in LOGS[name][0].split(", "))]
    table = rows.select(*columns).withColumn(DAY, F.col(time_column).cast("date"))
    table.write.mode("append").insertInto(qualified(schema, name))


def publish(df: DataFrame, root: str, view: str | None = None) -> str:
    """Replaces a materialised table: write a new version folder, then point the view at it.

    Readers see the old version until the write has succeeded, and running queries
    keep the files they started with. Returns the path of the new version. Old versions stay until
    someone who knows their readers removes them.
    """
    path = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    if view:
        df.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return path


def published(df: DataFrame, path: str, condition: str = "true") -> str:
    """A view's query over a folder that streams write to: committed rows only, and the schema also without rows."""
    if df.isEmpty():
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema)
        return f"SELECT {columns} WHERE false"
    return f"SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM parquet.`{path}` WHERE {condition}"


def define_views(spark: SparkSession, schema: str, definitions: Mapping[str, str]) -> None:
    for name, query in definitions.items():
        spark.sql(f"CREATE OR REPLACE VIEW {qualified(schema, name)} AS {query}")


def status_views(schema: str, stale_hours: int = 48) -> dict[str, str]:
    """Definitions of the serving views over the three logs."""
    def columns(log: str) -> str:
        return ", ".join(c.split()[0] for c in LOGS[log][0].split(", "))

    runs, checks, contracts = (qualified(schema, name) for name in
                               ("ops_job_run_log", "ops_pipeline_run_log", "ops_contract_check_log"))
    job_columns = columns("ops_job_run_log")
    return {
        "ops_current_status_v": (
            f"SELECT {job_columns}, "
            "CASE overall_status WHEN 'FAILED' THEN 'FAILED' WHEN 'WARNING' THEN 'WARNING' "
            "WHEN 'SUCCESS' THEN IF((unix_timestamp(current_timestamp()) - unix_timestamp(completed_at)) "
            f"> {stale_hours * 3600}, 'STALE', 'HEALTHY') ELSE 'UNKNOWN' END AS dashboard_status, "
            f"current_timestamp() AS view_refreshed_at FROM {runs} "
            "ORDER BY recorded_at DESC, job_run_id DESC LIMIT 1"
        ),
        "ops_run_history_v": f"SELECT {job_columns} FROM {runs}",
        "ops_pipeline_run_history_v": f"SELECT {columns('ops_pipeline_run_log')} FROM {checks}",
        "ops_contract_check_history_v": f"SELECT {columns('ops_contract_check_log')} FROM {contracts}",
        **board_views(schema),
    }


def board_views(schema: str, run_days: int = 2, days: int = 7) -> dict[str, str]:
    """Definitions of the views behind a board: the latest run's and contract's checks, all direct checks, reliability, last success.

    They give what the operators of the same meaning give (operators.status). The newest day comes from the partitions,
    and of the logs only the days that matter are read.
    """
    runs, checks, contracts = (qualified(schema, name) for name in
                               ("ops_job_run_log", "ops_pipeline_run_log", "ops_contract_check_log"))

    def newest(log: str) -> str:
        return f"(SELECT max({DAY}) FROM {log})"

    return {
        "ops_latest_run_checks_v": (
            f"SELECT pipeline_name, check_name, status, message, checked_at FROM {checks} "
            f"WHERE check_type = 'direct' AND {DAY} > date_sub({newest(checks)}, {run_days}) "
            f"AND run_id = (SELECT max_by(run_id, struct(checked_at, run_id)) FROM {checks} WHERE {DAY} = {newest(checks)})"
        ),
        "ops_latest_contract_checks_v": (
            f"SELECT table_name, check_name, status, actual_value, expected_value, checked_at FROM {contracts} "
            f"WHERE {DAY} = {newest(contracts)} "
            f"AND checked_at = (SELECT max(checked_at) FROM {contracts} WHERE {DAY} = {newest(contracts)})"
        ),
        "ops_direct_checks_v": (
            f"SELECT pipeline_name, check_name, status, message, checked_at, run_id FROM {checks} "
            "WHERE check_type = 'direct' ORDER BY checked_at DESC, run_id, pipeline_name, check_name, message"
        ),
        "ops_reliability_v": (
            "SELECT concat(count_if(overall_status = 'SUCCESS'), ' / ', count(1), ' runs succeeded') AS reliability "
            f"FROM {runs} WHERE started_at >= date_sub(current_date(), {days}) "
            f"AND ({DAY} >= date_sub(current_date(), {days}) OR {DAY} IS NULL)"
        ),
        "ops_last_success_v": (
            f"SELECT completed_at AS last_success_at FROM {runs} WHERE overall_status = 'SUCCESS' "
            "ORDER BY completed_at DESC LIMIT 1"
        ),
    }
