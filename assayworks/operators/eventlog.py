"""Expectation results from a pipeline event log.

The log is an ordinary table: pipeline_name, timestamp, event_type,
origin struct<update_id, flow_name>, details (JSON text).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.functions.clock import Moment, moment
from assayworks.functions.details import expectations, update_id
from assayworks.operators.checks import EXPECTATION, PASS, RUN_LOG_COLUMNS, WARN
from assayworks.operators.rules import Rule

# Event types, and the check written when a pipeline has no update.
STARTED, PROGRESS = "create_update", "flow_progress"
NO_UPDATE_CHECK = "event_log_enrichment"
NO_UPDATE_MESSAGE = "No update found in event_log — pipeline may not have run yet"

UNREADABLE_MESSAGE = "event_log could not be read: "


EVENT_TYPE = ("pipeline_name string, timestamp timestamp, event_type string, "
              "origin struct<update_id:string, flow_name:string>, details string")


def update_events(spark: SparkSession, pipeline: str, update: str, flow_name: str, rules: Sequence[Rule],
                  batches: Sequence[Mapping[str, int]], at: datetime) -> DataFrame:
    """Log rows for one update: its start, and one progress event per micro-batch.

    ``batches`` are the observed counts of a stream (see routing.observed): "rows"
    and one violation count per rule. This is run metadata, not table rows.
    """
    def progress(counts: Mapping[str, int]) -> str:
        found = [{"name": r.name, "dataset": flow_name, "passed_records": counts["rows"] - counts[r.name],
                  "failed_records": counts[r.name]} for r in rules]
        return json.dumps({"flow_progress": {"data_quality": {"expectations": found}}})

    start = json.dumps({"create_update": {"update_id": update}})
    rows = [(pipeline, at, STARTED, (update, None), start)]
    rows += [(pipeline, at, PROGRESS, (update, flow_name), progress(counts)) for counts in batches]
    return spark.createDataFrame(rows, EVENT_TYPE)


def latest_updates(events: DataFrame) -> DataFrame:
    """The newest update of every pipeline; the id is NULL where there is none or it has no id."""
    started = events.filter(F.col("event_type") == STARTED).select(
        "pipeline_name", "timestamp", update_id("details").alias("update_id")
    )
    return started.groupBy("pipeline_name").agg(
        F.max_by("update_id", F.struct("timestamp", "update_id")).alias("update_id")
    )


def _scoped(events: DataFrame, pipelines: Sequence[str] | None) -> DataFrame:
    return events if pipelines is None else events.filter(F.col("pipeline_name").isin(*pipelines))


def update_totals(events: DataFrame, pipelines: Sequence[str] | None = None) -> DataFrame:
    """Per pipeline of the log its newest update_id (NULL without one) and ``totals``, that update's sums per (flow, expectation).

    One scan and no join. The sums are made for every update, partially before the shuffle, so a row per (pipeline, update, flow,
    expectation) and map task is all that travels. They are then gathered per update, a list as long as the update has
    rules, and the newest update of a pipeline is the greatest by start time. Progress without results, and events of
    other kinds, only name their pipeline.
    """
    started = F.col("event_type") == STARTED
    progress = F.col("event_type") == PROGRESS
    told = F.when(started, update_id("details")).when(progress, F.col("origin.update_id"))
    rows = _scoped(events, pipelines).select(
        "pipeline_name", told.alias("update_id"), F.when(started, F.lit(1)).alias("begun"),
        F.when(started, F.col("timestamp")).alias("at"), F.when(progress, F.col("origin.flow_name")).alias("flow_name"),
        F.posexplode_outer(F.when(progress, expectations("details"))).alias("place", "one"),
    )
    # Plain columns only, so that Spark can hash the sums instead of sorting rows for them.
    sums = rows.select("pipeline_name", "update_id", "begun", "at", "flow_name", "one.*", F.col("place").isNotNull().alias("counted")).groupBy(
        "pipeline_name", "update_id", "flow_name", "name", "counted",
    ).agg(F.max("begun").alias("begun"), F.max("at").alias("at"), F.sum("passed_records").alias("total_passed"),
          F.sum("failed_records").alias("total_failed"))
    total = F.struct("flow_name", F.col("name").alias("expectation_name"), "total_passed", "total_failed")
    updates = sums.groupBy("pipeline_name", "update_id").agg(
        F.max("begun").alias("begun"), F.max("at").alias("at"), F.collect_list(F.when(F.col("counted"), total)).alias("totals"))
    order = F.when(F.col("begun") == 1, F.struct("at", "update_id"))
    newest = updates.groupBy("pipeline_name").agg(F.max_by(F.struct("update_id", "totals"), order).alias("newest"))
    # Without a start there is no newest; a pipeline without a name has no update of its own.
    known = F.col("pipeline_name").isNotNull() & F.col("newest.update_id").isNotNull()
    return newest.select("pipeline_name", F.when(known, F.col("newest.update_id")).alias("update_id"),
                         F.when(known, F.col("newest.totals")).alias("totals"))


def expectation_totals(events: DataFrame, pipelines: Sequence[str] | None = None) -> DataFrame:
    """Passed and failed records per (pipeline, flow, expectation) of the latest update."""
    return update_totals(events, pipelines).select("pipeline_name", F.inline("totals"))


def unreadable_checks(spark: SparkSession, run_id: str, pipelines: Sequence[str], error: Exception,
                      as_of: Moment = None) -> DataFrame:
    """One WARN row per pipeline for a log that cannot be read. Expectation results inform; they never block."""
    told = UNREADABLE_MESSAGE + str(error)
    rows = [(run_id, p, NO_UPDATE_CHECK, EXPECTATION, WARN, told) for p in pipelines]
    named = spark.createDataFrame(
        rows, "run_id string, pipeline_name string, check_name string, check_type string, status string, message string")
    return named.withColumn("checked_at", moment(as_of)).select(*RUN_LOG_COLUMNS)


def expectation_checks(events: DataFrame, run_id: str, as_of: Moment = None,
                       pipelines: Sequence[str] | None = None) -> DataFrame:
    """Run-log rows: PASS where no record failed, else WARN; a pipeline without update warns.

    ``pipelines`` names the pipelines to report; by default those found in the log.
    """
    found = update_totals(events, pipelines)
    if pipelines is not None:
        named = events.sparkSession.createDataFrame([(p,) for p in pipelines], "pipeline_name string")
        found = named.join(found, "pipeline_name", "left")
    none_failed = F.coalesce(F.col("total_failed") == 0, F.lit(False))
    # NULL sums and names are told as the word None
    told = {c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
            for c in ("flow_name", "total_passed", "total_failed")}
    silent = F.col("update_id").isNull()
    # An update without results reports nothing; a pipeline without update reports that, in one row.
    reported = F.when(silent, F.array(F.lit(None).cast(found.schema["totals"].dataType.elementType))).otherwise(F.col("totals"))
    graded = found.select("pipeline_name", "update_id", F.inline(reported)).select(
        "pipeline_name",
        F.when(silent, F.lit(NO_UPDATE_CHECK)).otherwise(F.col("expectation_name")).alias("check_name"),
        F.when(none_failed, F.lit(PASS)).otherwise(F.lit(WARN)).alias("status"),
        F.when(silent, F.lit(NO_UPDATE_MESSAGE)).otherwise(
            F.concat(F.lit("flow="), told["flow_name"], F.lit(" passed="), told["total_passed"],
                     F.lit(" failed="), told["total_failed"])).alias("message"),
    )
    return graded.select(
        F.lit(run_id).alias("run_id"), F.lit(EXPECTATION).alias("check_type"),
        moment(as_of).alias("checked_at"), "*",
    ).select(*RUN_LOG_COLUMNS)
