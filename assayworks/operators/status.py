"""Run outcomes and the views a status board reads."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayworks.functions.clock import Moment, days_before, hours_between, moment, seconds_between
from assayworks.functions.sliced import last_marked
from assayworks.functions.text import clipped
from assayworks.operators.checks import CONTRACT_LOG_COLUMNS, DIRECT, FAIL, PASS, RUN_LOG_COLUMNS, WARN
from assayworks.operators.summary import summarise

# Result states, status words, log columns and limits.
FAILED_STATES = ("FAILED", "TIMEDOUT", "CANCELED")
FINALIZER = "finalize_ops_status"
MESSAGE_LENGTH = 500
STALE_HOURS = 48
JOB_LOG_COLUMNS = (
    "job_run_id", "recorded_at", "catalog_name", "schema_name", "bundle_target", "git_sha",
    "overall_status", "failed_task_key", "failure_message", "started_at", "completed_at",
    "duration_seconds", "job_run_url",
)


def run_outcomes(runs: DataFrame, tasks: DataFrame, checks: DataFrame | None = None,
                 finalizer: str = FINALIZER, message_length: int = MESSAGE_LENGTH,
                 slices: tuple[str, str] | None = None) -> DataFrame:
    """One job-log row per run; of a failure message its first ``message_length`` characters.

    ``runs``: job_run_id, recorded_at, catalog_name, schema_name, bundle_target,
    git_sha, started_at, job_run_url. ``tasks``: job_run_id, ord, task_key,
    result_state, state_message. ``checks``: a run log.

    FAILED when a task other than the finalizer failed, with the first such task
    in listing order; UNKNOWN when a run has no task rows; SUCCESS otherwise, and
    WARNING instead of SUCCESS when a direct check warned between start and recording.

    Runs and warnings are put in order in slices of an hour within a day. Where an hour may hold most runs, give finer
    ``slices``, such as ("second", "hour"): tasks shrink, at a marker row for every second in use.
    """
    failed = F.col("result_state").isin(*FAILED_STATES) & (F.col("task_key") != finalizer)
    first = F.min(F.when(failed, F.struct(
        "ord", "task_key", clipped("state_message", message_length).alias("message"))))
    carried = ["recorded_at", "catalog_name", "schema_name", "bundle_target", "git_sha",
               "started_at", "job_run_url"]
    graded = summarise(
        runs, tasks, "job_run_id", {"_tasks": F.count(F.lit(1)), "_first": first}, carried, zero=["_tasks"]
    )
    warned = F.lit(False)
    if checks is not None:
        graded = _with_last_warning(graded, checks, slices)
        warned = F.coalesce(F.col("_warned_at") >= F.col("started_at"), F.lit(False))
    status = (
        F.when(F.col("_tasks") == 0, F.lit("UNKNOWN"))
        .when(F.col("_first").isNotNull(), F.lit("FAILED"))
        .when(warned, F.lit("WARNING"))
        .otherwise(F.lit("SUCCESS"))
    )
    message = F.col("_first.message")
    return graded.select(
        "job_run_id", "recorded_at", "catalog_name", "schema_name", "bundle_target",
        F.coalesce(F.col("git_sha"), F.lit("unknown")).alias("git_sha"),
        status.alias("overall_status"),
        F.col("_first.task_key").alias("failed_task_key"),
        F.when(message != "", message).alias("failure_message"),
        "started_at", F.col("recorded_at").alias("completed_at"),
        seconds_between("recorded_at", "started_at").cast("long").alias("duration_seconds"),
        "job_run_url",
    )


def _with_last_warning(runs: DataFrame, checks: DataFrame, slices: tuple[str, str] | None) -> DataFrame:
    """Adds the newest direct warning not after recorded_at, without pairing runs and checks.

    Run rows and warning times are put on one time line, and each run looks back
    along it. A run needs only the newest warning: any warning since its start
    exists exactly when the newest one is not before the start.
    """
    warnings = checks.filter((F.col("status") == WARN) & (F.col("check_type") == DIRECT)).select(
        F.col("checked_at").alias("_at")
    ).distinct()
    line = runs.select(F.col("recorded_at").alias("_at"), F.struct("*").alias("_run")).unionByName(
        warnings.select("_at", F.lit(None).cast(runs.select(F.struct("*")).schema[0].dataType).alias("_run"))
    )
    seen = last_marked(line, "_at", F.col("_run").isNull(), "_warned_at", *([] if slices is None else [
        F.date_trunc(slices[0], "_at").cast("timestamp_ntz"),
        lambda c: F.date_trunc(slices[1], c).cast("timestamp_ntz")]))
    return seen.filter(F.col("_run").isNotNull()).select("_run.*", "_warned_at")


# --- serving views -----------------------------------------------------------------------------


def board_status(as_of: Moment = None, stale_hours: float = STALE_HOURS) -> Column:
    """Status word shown for a run. Exactly the limit is not stale, nor is a NULL completion."""
    age = hours_between(moment(as_of), "completed_at")
    status = F.col("overall_status")
    return (
        F.when(status == "FAILED", F.lit("FAILED"))
        .when(status == "WARNING", F.lit("WARNING"))
        .when((status == "SUCCESS") & (age > stale_hours), F.lit("STALE"))
        .when(status == "SUCCESS", F.lit("HEALTHY"))
        .otherwise(F.lit("UNKNOWN"))
    )


def current_status(runs: DataFrame, as_of: Moment = None, stale_hours: float = STALE_HOURS,
                   by: Sequence[str] = ()) -> DataFrame:
    """The newest run with its board status; with ``by``, the newest run of each group.

    Without groups this is a top-1, with groups a ranked window that Spark already limits
    to one row per group before the shuffle. Ties go to the greater job_run_id.
    """
    newest_first = [F.col("recorded_at").desc(), F.col("job_run_id").desc()]
    if by:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*newest_first))
        newest = runs.withColumn("_rank", rank).filter(F.col("_rank") == 1)
    else:
        newest = runs.orderBy(*newest_first).limit(1)
    return newest.select(
        *JOB_LOG_COLUMNS, board_status(as_of, stale_hours).alias("dashboard_status"),
        moment(as_of).alias("view_refreshed_at"),
    )


def run_history(runs: DataFrame) -> DataFrame:
    return runs.select(*JOB_LOG_COLUMNS)


def check_history(log: DataFrame) -> DataFrame:
    return log.select(*RUN_LOG_COLUMNS)


def contract_history(log: DataFrame) -> DataFrame:
    return log.select(*CONTRACT_LOG_COLUMNS)


def newest_day(log: DataFrame, day: str) -> Column:
    """The greatest day of a log partitioned by day. No column is read from a file for it."""
    return log.agg(F.max(day)).scalar()


def latest_run_checks(log: DataFrame, latest: Literal["recent", "lexicographic"] = "recent",
                      day: str | None = None, run_days: int = 2) -> DataFrame:
    """Direct checks of the latest run.

    "recent" takes the run with the newest check. "lexicographic" takes the
    greatest run_id as text, which ranks "9" above "10".

    ``day`` names a partition column with the date of checked_at. The newest run is then sought in the newest day alone, and its
    checks in the ``run_days`` days up to that one, the most days that the checks of a run are spread over. It is no help for "lexicographic".
    """
    if latest not in ("recent", "lexicographic"):
        raise ValueError(f"unknown latest {latest!r}")
    scope, near = log, log
    if latest == "recent" and day is not None:
        newest = newest_day(log, day)
        scope = log.filter(F.col(day) == newest)
        near = log.filter(F.col(day) > F.date_sub(newest, run_days))
    top = scope.agg(F.max_by("run_id", F.struct("checked_at", "run_id")) if latest == "recent" else F.max("run_id"))
    return near.filter((F.col("check_type") == DIRECT) & (F.col("run_id") == top.scalar())).select(
        "pipeline_name", "check_name", "status", "message", "checked_at"
    )


def latest_contract_checks(log: DataFrame, day: str | None = None) -> DataFrame:
    """Contract checks of the newest check time; ``day`` names a partition column with the date of checked_at."""
    scope = log if day is None else log.filter(F.col(day) == newest_day(log, day))
    newest = scope.agg(F.max("checked_at"))
    return scope.filter(F.col("checked_at") == newest.scalar()).select(
        "table_name", "check_name", "status", "actual_value", "expected_value", "checked_at"
    )


def all_direct_checks(log: DataFrame) -> DataFrame:
    """Every direct check, newest first.

    The further sort columns only break ties; they let the range exchange divide
    a time that many checks share.
    """
    return log.filter(F.col("check_type") == DIRECT).select(
        "pipeline_name", "check_name", "status", "message", "checked_at", "run_id"
    ).orderBy(F.col("checked_at").desc(), "run_id", "pipeline_name", "check_name", "message")


def reliability(runs: DataFrame, as_of: Moment = None, days: int = 7, day: str | None = None) -> DataFrame:
    """``"x / y runs succeeded"`` over runs started since midnight ``days`` days ago.

    ``day`` names a partition column with the date of recorded_at. A run is not recorded before it starts, so earlier days are not read;
    runs without a recorded time are.
    """
    since = days_before(as_of, days)
    recent = runs.filter(F.col("started_at") >= since)
    if day is not None:
        recent = recent.filter((F.col(day) >= since) | F.col(day).isNull())
    return recent.agg(F.concat(
        F.count_if(F.col("overall_status") == "SUCCESS").cast("string"), F.lit(" / "),
        F.count(F.lit(1)).cast("string"), F.lit(" runs succeeded"),
    ).alias("reliability"))


def last_success(runs: DataFrame) -> DataFrame:
    """Completion time of the newest successful run; no row when there is none."""
    return runs.filter(F.col("overall_status") == "SUCCESS").select(
        F.col("completed_at").alias("last_success_at")
    ).orderBy(F.col("last_success_at").desc()).limit(1)


def duration_series(runs: DataFrame) -> DataFrame:
    return runs.groupBy("completed_at").agg(F.sum("duration_seconds").alias("duration_seconds"))


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def quality_trend(log: DataFrame) -> DataFrame:
    """Passed, warned and failed checks per day and check."""
    day = F.col("checked_at").cast("date").alias("day")
    return log.groupBy(day, "check_name").agg(*[
        F.count_if(F.col("status") == status).alias(name)
        for status, name in ((PASS, "passed"), (WARN, "warned"), (FAIL, "failed"))
    ])
