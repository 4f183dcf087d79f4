"""Landing files as bronze rows, in batch or as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from assayworks.functions.clock import Moment, moment

# Lineage columns.
SOURCE_FILE, INGESTED_AT = "_source_file", "_ingested_at"

# Spark's file streams skip files much older than the newest one seen. Archives and late deliveries keep
# their old times, so no file may age out.
KEEP_OLD_FILES = {"maxFileAge": "36500d"}


@dataclass(frozen=True)
class BatchLimit:
    """How much one micro-batch may take: a number of files or of bytes. Less per batch is less to redo."""

    files: int | None = None
    size: int | None = None


def _options(header: bool, strict_header: bool, corrupt_column: str | None) -> dict[str, str]:
    options = {"header": str(header).lower(), "enforceSchema": str(not strict_header).lower()}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return options


def _full_schema(schema: StructType, corrupt_column: str | None) -> StructType:
    if not corrupt_column:
        return schema
    return StructType([*schema.fields]).add(corrupt_column, StringType(), True)


def landing_path(root: str, product: str, target: str, domain: str) -> str:
    """Where a domain's raw files land under a root folder."""
    return f"{root.rstrip('/')}/{product}/{target}/{domain}_raw/"


def read_csv(spark: SparkSession, path: str, schema: StructType, *, header: bool = True,
             strict_header: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """CSV files with a declared schema; unreadable fields become NULL.

    Columns bind by position. ``strict_header`` fails the read when a header names
    other columns, ``corrupt_column`` keeps the text of malformed rows.
    """
    return (
        spark.read.options(**_options(header, strict_header, corrupt_column))
        .schema(_full_schema(schema, corrupt_column)).csv(path)
    )


def stream_csv(spark: SparkSession, path: str, schema: StructType, *, header: bool = True,
               strict_header: bool = False, corrupt_column: str | None = None,
               batch: BatchLimit | None = None) -> DataFrame:
    """The same as a stream. Files already taken are known from the query's checkpoint."""
    reader = (
        spark.readStream.options(**_options(header, strict_header, corrupt_column), **_limit(batch), **KEEP_OLD_FILES)
        .schema(_full_schema(schema, corrupt_column))
    )
    return reader.csv(path)


def _limit(batch: BatchLimit | None) -> dict[str, str]:
    if batch is None:
        return {}
    wanted = {"maxFilesPerTrigger": batch.files, "maxBytesPerTrigger": batch.size}
    return {option: str(value) for option, value in wanted.items() if value is not None}


def stream_table(spark: SparkSession, path: str, schema: StructType, *,
                 batch: BatchLimit | None = None) -> DataFrame:
    """New Parquet files of an upstream table as a stream."""
    return spark.readStream.schema(schema).options(**_limit(batch), **KEEP_OLD_FILES).parquet(path)


def to_bronze(df: DataFrame, schema: StructType, as_of: Moment = None,
              corrupt_column: str | None = None) -> DataFrame:
    """Exactly the declared columns plus source file and ingest time."""
    declared = schema.names + ([corrupt_column] if corrupt_column else [])
    return df.select(
        *declared,
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        moment(as_of).alias(INGESTED_AT),
    )
