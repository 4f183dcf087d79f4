"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.llm import (
    decontaminate,
    exact,
    neardup,
    packing,
    phrases,
    quality,
    repair,
    runs,
    secrets,
    shards,
    simhash,
    substrings,
    tokens,
    urls,
)
from assayworks.llm.sql import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}

# URL rules as host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
URL_DEFAULT = "allow"

SEQUENCE_TOKENS = 1024
END_ID = 2
SHARDS = 24


def query(function: Query) -> Query:
    LLM_QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pieces(docs: DataFrame) -> DataFrame:
    """Token pieces by the vocabulary of the contract."""
    import public_tokenizers

    return tokens.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, END_ID,
                               SEQUENCE_TOKENS)


def packed(docs: DataFrame) -> DataFrame:
    digests = pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, "length", SEQUENCE_TOKENS)


@query
def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed(_table(spark, sf, "documents"))


@query
def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    nodes = shards.document_nodes(_table(spark, sf, "documents"))
    placed = shards.balanced_shards(nodes, None, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact.exact_duplicates(_table(spark, sf, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op4_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = substrings.without_repeated_bytes(_table(spark, sf, "documents"), size=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf, "documents"), n=2, percent=80)


@query
def op6_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@query
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = secrets.secret_spans(docs, secrets.fit_markov(secrets.training_strings(docs)))
    return found.select(
        "doc_id", *[secrets.counted(F.col("base"), kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("found")).alias("spans"))


@query
def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = phrases.without_repeated_passages(_table(spark, sf, "documents"), size=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = quality.fit_quality(docs, _table(spark, sf, "labels").filter(remainder != 2))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (remainder == 2).alias("held_out"), "score", "predicted")


@query
def op10_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.apply_rules(_table(spark, sf, "pages"), rules, "page_id", "url", URL_DEFAULT)


@query
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_planted_runs(_table(spark, sf, "documents")))
    # Runs come by start, then period, so the first of the greatest exponent is the one wanted.
    best = F.expr("""aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0),
                     (best, r) -> if(r.length * best.period > best.length * r.period, r, best))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op11_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    conversations = _table(spark, sf, "conversations")
    return repair.with_everyone(repair.repaired(repair.damaged(conversations)), conversations)
