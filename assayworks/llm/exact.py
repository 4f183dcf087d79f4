"""Exact deduplication of documents: local, salted and global combining by full content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.llm.shared import ascii_lower, free_name, one_of_each, text_or_empty, written

SALTS = 64

Digest = Callable[[Column], Column]


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _members(docs: DataFrame, digest: Digest) -> DataFrame:
    content = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(text_or_empty()).alias("content"))
    return content.withColumn("digest", digest(F.col("content")))


def exact_groups(docs: DataFrame, digest: Digest = sha256, salts: int = SALTS) -> DataFrame:
    """One row per group of equal texts: digest, content, keep_id, group_size.

    Rows are combined in three steps, each by digest and full content: within each
    input task (map-side aggregation), within a salted digest group, and over the
    winners of the salts. A task hands on one row per content and a salt one row per
    content, so a text that a third of all rows share never meets in one task.
    """
    keyed = _members(docs, digest).withColumn("salt", F.spark_partition_id() % salts)
    salted = keyed.groupBy("digest", "salt", "content").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_duplicates(docs: DataFrame, digest: Digest = sha256, salts: int = SALTS) -> DataFrame:
    """Every document with the document that stays for its text.

    Texts are equal when identical after lower-casing A to Z. Returns doc_id,
    keep_id (the largest doc_id of the group), group_size, kept and the binary digest; one row per
    input row.

    A NULL text counts as empty; empty texts form one group. Rows with a NULL
    doc_id are members like others and never win against a number; a group of only
    such rows has a NULL keep_id and keeps them all. Repeated rows (same doc_id and
    text) each give a row, count in group_size and are all kept if their doc_id wins.
    Other columns are ignored. An empty table gives no rows.

    Equal contents have equal digests, so where full comparison found a single content
    for a digest, the digest alone leads documents to their group. Documents of a
    digest with several contents are led by content as well.
    """
    groups = exact_groups(docs, digest, salts)
    found = written(groups.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size")), "exact-groups")
    members = _members(docs, digest)
    led = members.drop("content").join(found.filter("contents = 1").drop("contents"), "digest")
    colliding = found.filter("contents > 1").select("digest")
    if not colliding.isEmpty():
        several = groups.join(colliding, "digest", "left_semi")
        led = led.unionByName(members.join(several, ["digest", "content"]).drop("content"))
    return led.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "digest")


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names and types.

    A row stays when its doc_id won for its own text, so rows that share an id are told apart by their texts. Rows with a
    NULL doc_id stay when no numbered document has their text. Of rows with the same doc_id and text one stays.
    """
    digest, winner, won = (free_name(docs, x) for x in ("digest", "winner", "won"))
    winners = exact_duplicates(docs).filter("kept").select(
        F.col("doc_id").alias(winner), F.col("digest").alias(won)).distinct()
    keyed = docs.withColumn(digest, sha256(ascii_lower(text_or_empty())))
    kept = keyed.join(winners, F.col("doc_id").eqNullSafe(F.col(winner)) & (F.col(digest) == F.col(won)), "left_semi")
    return one_of_each(kept.drop(digest), text_or_empty())
