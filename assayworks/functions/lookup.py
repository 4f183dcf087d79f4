"""Replacing codes by values from a small map or from a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mapped(code: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """``mapping[code]``, or ``default`` for NULL and unknown codes. The match is case-sensitive.

    The map is part of the plan and searched entry by entry; for thousands of codes joined() is faster.
    """
    if not mapping:
        return F.lit(default)
    literal = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(literal, code if isinstance(code, Column) else F.col(code)), F.lit(default))


def joined(df: DataFrame, code: str, table: DataFrame, key: str, value: str,
           default: str, out: str) -> DataFrame:
    """Left lookup against a table with one row per ``key``.

    There is no broadcast hint: the optimizer broadcasts the table only when its
    size is under spark.sql.autoBroadcastJoinThreshold, and otherwise uses a
    sort-merge join whose hot codes (or NULLs) AQE splits.
    """
    side = table.select(F.col(key).alias("_lookup_key"), F.col(value).alias("_lookup_value"))
    return df.join(side, F.col(code) == F.col("_lookup_key"), "left").select(
        *[F.col(name) for name in df.columns],
        F.coalesce(F.col("_lookup_value"), F.lit(default)).alias(out),
    )
