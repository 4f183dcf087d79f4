"""Landing files to bronze, bronze to silver and rejected, as available-now streams.

Both steps end in Spark's file sink: its commit log makes each micro-batch
visible whole and once, also after a lost driver or a retried batch. Silver and
rejected are two partitions of one routed table, so a batch is read once,
transformed once and written by one job. When an abort rule fires, that job
fails and the batch is not committed.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType, TimestampType

from assayworks.functions.clock import Moment
from assayworks.operators.routing import ROUTE, STAMP, Split, observed, route, routed_split
from assayworks.operators.rules import Mode, NullPolicy, Rule
from assayworks.sources.landing import (
    INGESTED_AT,
    SOURCE_FILE,
    BatchLimit,
    stream_csv,
    stream_table,
    to_bronze,
)

METRICS = "quality"


@dataclass(frozen=True)
class Layout:
    """Folders of one domain. A full refresh is a run into a new layout."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def routed(self) -> str:
        return f"{self.root}/routed"

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/_checkpoints/{step}"


def bronze_schema(declared: StructType) -> StructType:
    return StructType([*declared.fields]).add(SOURCE_FILE, StringType()).add(INGESTED_AT, TimestampType())


def append_available(df: DataFrame, path: str, checkpoint: str,
                     partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Starts a query that processes what is there, appends it as Parquet and stops."""
    writer = (
        df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def land(spark: SparkSession, source: str, declared: StructType, layout: Layout, *,
         as_of: Moment = None, batch: BatchLimit | None = None) -> StreamingQuery:
    """New CSV files to bronze."""
    raw = stream_csv(spark, source, declared, batch=batch)
    return append_available(to_bronze(raw, declared, as_of), layout.bronze, layout.checkpoint("bronze"))


def refine(spark: SparkSession, layout: Layout, bronze: StructType, transform: Callable[[DataFrame], DataFrame],
           rules: Sequence[Rule], *, mode: Mode = "drop", null_policy: NullPolicy = "pass",
           source: str | None = None, batch: BatchLimit | None = None,
           stamp: int | None = None) -> StreamingQuery:
    """New bronze rows to the routed table, with violation counts as observed metrics.

    ``stamp`` marks the rows this query commits, as a partition, so that a later
    step can read just them. Use a greater stamp per query, and stamps always or never.
    """
    rows = stream_table(spark, source or layout.bronze, bronze, batch=batch)
    candidates = observed(transform(rows), rules, METRICS, null_policy)
    routed = route(candidates, rules, mode, null_policy)
    if stamp is None:
        return append_available(routed, layout.routed, layout.checkpoint("routed"), [ROUTE])
    stamped = routed.withColumn(STAMP, F.lit(stamp).cast("bigint"))
    return append_available(stamped, layout.routed, layout.checkpoint("routed"), [STAMP, ROUTE])


def finish(query: StreamingQuery, timeout: int | None = None) -> list[dict[str, int]]:
    """Waits for an available-now query; returns the observed counts of its batches.

    Raises what the query raised, for instance on an abort rule. Spark keeps the
    progress of the last spark.sql.streaming.numRecentProgressUpdates batches; when a run had
    more, earlier counts are gone and a warning says so (rule_metrics over the tables has them all).
    """
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s; it resumes from its checkpoint")
    progress = query.recentProgress
    kept = SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates")
    if len(progress) >= int(kept):
        warnings.warn("counts of the earliest micro-batches are no longer kept", stacklevel=2)
    observations = [one["observedMetrics"] or {} for one in progress]
    return [seen[METRICS].asDict() for seen in observations if METRICS in seen]


def tables(spark: SparkSession, layout: Layout, schema: StructType | None = None,
           stamps: tuple[int, int] | None = None) -> Split:
    """Silver and rejected of a layout, committed batches only; with ``stamps``, only partitions after the first up to the second.

    Pass the routed schema to read a table that may not have a committed row yet.
    """
    routed = routed_table(spark, layout, schema)
    if stamps is None:
        return routed_split(routed)
    after, upto = stamps
    return routed_split(routed.filter((F.col(STAMP) > after) & (F.col(STAMP) <= upto)))


def routed_table(spark: SparkSession, layout: Layout, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(layout.routed)
