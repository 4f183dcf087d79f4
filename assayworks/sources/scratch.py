"""Folders for intermediate tables and stream checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a new local one only in a session without executors of its own."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    local = tempfile.mkdtemp(prefix="assayworks-")
    spark.conf.set(SETTING, local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back; later reads need no earlier stage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
