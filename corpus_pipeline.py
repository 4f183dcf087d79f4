"""A corpus pipeline of five stages over the table documents; each keeps the rows that the next one gets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayworks.llm import decontaminate, exact, neardup, quality
from assayworks.llm.queries import packed
from assayworks.llm.shared import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, with all their columns."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact.without_exact_duplicates(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 and more."""
    return neardup.without_near_duplicates(docs, n=5, percent=80)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def training_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", distinct_texts),
    ("minhash_near_dedup", distinct_content),
    ("benchmark_decontamination", without_test_items),
    ("best_fit_packing", training_sequences),
]

#: SQL cannot express the classifier, the alignment or the tokenizer; the stages are tested by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
