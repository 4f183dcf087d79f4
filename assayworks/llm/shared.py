"""Scratch tables and positions within groups, shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from assayworks.sources.scratch import scratch_path

ROWS_PER_BUCKET = 20_000


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder; later reads need no earlier stage."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, label: str) -> str:
    """A column name that the frame does not have."""
    return f"_{label}_{uuid.uuid4().hex[:12]}"


def mapped_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                added: Sequence[StructField] = ()) -> DataFrame:
    """mapInArrow that keeps all columns, whatever their names, and adds some at the end; ``run`` finds columns by place."""
    fields = [StructField(f"c{i}", f.dataType, True) for i, f in enumerate(df.schema.fields)]
    out = df.toDF(*[f.name for f in fields]).mapInArrow(run, StructType([*fields, *added]))
    return out.toDF(*df.columns, *[f.name for f in added])


def one_of_each(df: DataFrame, text: Column) -> DataFrame:
    """One row of those with the same doc_id and text; other columns may have any type."""
    digest = free_name(df, "digest")
    return df.withColumn(digest, F.sha2(text, 256)).dropDuplicates(["doc_id", digest]).drop(digest)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running(df: DataFrame, by: Sequence[str], order: str, value: Column, name: str, rows: int) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows of the same ``by`` group.

    ``order`` must be unique. Rows are dealt into buckets by its hash; the total order is (bucket, order).
    A bucket is a task-sized part of a group whatever the group's size, and only one row per
    bucket meets in the second window, so a group of any share of the table is spread out.
    ``rows`` is the number of rows of the table.
    """
    buckets = max(1, rows // ROWS_PER_BUCKET)
    bucket, before, base, amount = (free_name(df, x) for x in ("bucket", "before", "base", "amount"))
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(order), F.lit(buckets))).withColumn(amount, value.cast("long"))
    sums = dealt.groupBy(*by, bucket).agg(F.sum(amount).alias(base))
    whole = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn(before, F.coalesce(F.sum(base).over(whole), F.lit(0))).drop(base)
    inner = Window.partitionBy(*by, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn(name, F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    joined = local.join(bases, [*by, bucket])
    return joined.withColumn(name, F.col(name) + F.col(before)).drop(bucket, before, amount)
