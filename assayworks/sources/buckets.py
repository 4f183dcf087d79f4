"""Keyed state in hash buckets: a batch replaces the buckets of its keys and leaves the files of all others alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET, MARK = "_bucket", "_mark"


@dataclass(frozen=True)
class Buckets:
    """A folder of Parquet files in one partition per bucket. ``schema`` is that of a state row; the number of buckets never changes."""

    path: str
    keys: tuple[str, ...]
    count: int
    schema: StructType

    def of_key(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """State rows with their bucket and its mark; of some buckets only those partitions are listed and read."""
        stored = StructType([*self.schema.fields]).add(MARK, "long").add(BUCKET, "integer")
        rows = spark.read.schema(stored).parquet(self.path)
        return rows if buckets is None else rows.filter(F.col(BUCKET).isin(*buckets))

    def state(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).select(*self.schema.names)

    def create(self, state: DataFrame, mark: int = 0) -> None:
        """Writes a first state into a folder that does not exist."""
        _placed(self, state, mark).write.partitionBy(BUCKET).parquet(self.path)

    def apply(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], mark: int = 0) -> list[int]:
        """Replaces the buckets of the batch's keys by ``change(state of these buckets, batch)``; returns their numbers.

        The new files are written beside the old ones and change places with them when the job commits. A driver lost between two
        buckets leaves some new and some old, each of them whole. Apply the batch again then: a ``change`` that takes a batch twice without
        harm (latest row, spliced history) needs nothing else. For sums pass a growing ``mark``; a bucket keeps the mark of its
        last batch, and rows of a bucket that has this mark or a greater one are left out.
        Two writers must not work on a folder at the same time, and a change must leave every bucket it gets a row: a bucket
        without any would keep its old files.
        """
        spark = batch.sparkSession
        placed = batch.withColumn(BUCKET, self.of_key())
        touched = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())  # at most ``count`` numbers
        if mark and touched:
            marks = self.read(spark, touched).groupBy(BUCKET).agg(F.max(MARK).alias(MARK))
            done = {r[0] for r in marks.filter(F.col(MARK) >= mark).collect()}
            touched = [b for b in touched if b not in done]
        if not touched:
            return []
        fresh = placed.filter(F.col(BUCKET).isin(*touched)).drop(BUCKET)
        after = change(self.read(spark, touched).select(*self.schema.names), fresh)
        (_placed(self, after, mark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))
        return touched


def _placed(to: Buckets, state: DataFrame, mark: int) -> DataFrame:
    """Rows in their buckets. Rebalancing lets AQE cut a bucket that a hot key makes heavy into several files."""
    kinds = {f.name: f.dataType for f in to.schema.fields}
    rows = state.select(*[F.col(c).cast(kinds[c]).alias(c) for c in to.schema.names], F.lit(mark).cast("bigint").alias(MARK))
    return rows.withColumn(BUCKET, to.of_key()).hint("rebalance", F.col(BUCKET))
