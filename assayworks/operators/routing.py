"""Applying rules to rows: enforce, split, route and count."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayworks.functions.text import missing_text
from assayworks.operators.rules import (
    Mode,
    NullPolicy,
    Rule,
    any_broken,
    broken,
    broken_names,
    grade,
    satisfied,
)

# Names and contents of the columns added to rejected rows.
REASON = "rejection_reason"
SEVERITY = "rejection_severity"
REASON_SEPARATOR = ", "
DROPPED_SEVERITY = "business_invalid"

ROUTE = "_route"
STAMP = "_stamp"
SILVER = "silver"
REJECTED = "rejected"


class Split(NamedTuple):
    silver: DataFrame
    rejected: DataFrame


def violations(df: DataFrame, rule: Rule, null_policy: NullPolicy = "pass") -> DataFrame:
    return df.filter(broken(rule, null_policy))


def tag(df: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass",
        out: str = "_failed") -> DataFrame:
    """Adds the array of broken rule names, in rule order; empty when the row is clean."""
    names = broken_names(rules, null_policy)
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.select("*", failed.alias(out))


def enforce(df: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    """Passes rows through; a row that breaks a rule fails the job that reads it.

    The check sits in a filter because Catalyst would prune an unused assertion
    column. The partition id makes the filter non-deterministic in Catalyst's eyes, so no
    later filter (such as a join's implied IS NOT NULL) is moved below it and
    hides rows from it. Only a LIMIT that stops the scan can.
    """
    if not rules:
        return df
    message = F.concat(
        F.lit("quality rule violated: "),
        F.concat_ws(REASON_SEPARATOR, *broken_names(rules, null_policy)),
    )
    violated = (F.spark_partition_id() >= 0) & any_broken(rules, null_policy)
    return df.filter(F.when(violated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def accepted(df: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    """Rows that break no business_invalid rule."""
    for rule in grade(rules).drop:
        df = df.filter(satisfied(rule, null_policy))
    return df


def rejected(df: DataFrame, rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> DataFrame:
    """Rows that break at least one business_invalid rule, with the names of those rules."""
    dropping = grade(rules).drop
    if not dropping:
        return df.filter(F.lit(False)).select("*", *missing_text(REASON, SEVERITY))
    return df.filter(any_broken(dropping, null_policy)).select(
        "*",
        F.concat_ws(REASON_SEPARATOR, *broken_names(dropping, null_policy)).alias(REASON),
        F.lit(DROPPED_SEVERITY).alias(SEVERITY),
    )


def split(df: DataFrame, rules: Sequence[Rule], mode: Mode = "drop",
          null_policy: NullPolicy = "pass") -> Split:
    """Two lazy frames over the same input.

    Each is a scan with a filter and no shuffle. To materialise both sides in one
    pass, write route() partitioned by its route column instead. The mode only concerns
    silver: in "fail" mode reading it aborts, while rejected still shows the offending rows.
    """
    grading = grade(rules, mode)
    checked = enforce(df, grading.abort, null_policy)
    return Split(accepted(checked, grading.drop, null_policy), rejected(df, rules, null_policy))


def route(df: DataFrame, rules: Sequence[Rule], mode: Mode = "drop",
          null_policy: NullPolicy = "pass") -> DataFrame:
    """Every input row once, with reason, severity and the table it belongs to.

    Written with ``partitionBy("_route")`` this yields silver and rejected from a
    single scan in a single job; a broken abort rule fails that job, so neither
    side is committed.
    """
    grading = grade(rules, mode)
    checked = enforce(df, grading.abort, null_policy)
    if not grading.drop:
        return checked.select("*", *missing_text(REASON, SEVERITY), F.lit(SILVER).alias(ROUTE))
    fails = F.coalesce(any_broken(grading.drop, null_policy), F.lit(False))
    reason = F.concat_ws(REASON_SEPARATOR, *broken_names(grading.drop, null_policy))
    return checked.select(
        "*",
        F.when(fails, reason).alias(REASON),
        F.when(fails, F.lit(DROPPED_SEVERITY)).alias(SEVERITY),
        F.when(fails, F.lit(REJECTED)).otherwise(F.lit(SILVER)).alias(ROUTE),
    )


def routed_split(routed: DataFrame) -> Split:
    """Silver and rejected as views over a routed table; the filter prunes partitions."""
    silver = routed.filter(F.col(ROUTE) == SILVER).drop(ROUTE, STAMP, REASON, SEVERITY)
    bad = routed.filter(F.col(ROUTE) == REJECTED).drop(ROUTE, STAMP)
    return Split(silver, bad)


def violation_counts(rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> list[Column]:
    return [F.count_if(broken(rule, null_policy)).alias(rule.name) for rule in rules]


def observed(df: DataFrame, rules: Sequence[Rule], name: str = "quality",
             null_policy: NullPolicy = "pass") -> DataFrame:
    """Attaches row and violation counts to whatever job runs ``df``, at no extra pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *violation_counts(rules, null_policy))


def rule_metrics(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = (),
                 null_policy: NullPolicy = "pass") -> DataFrame:
    """Passed and failed row counts per rule, all rules in one aggregation."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *violation_counts(rules, null_policy)
    )
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.severity).alias("severity"),
            (F.col("_rows") - F.col(rule.name)).alias("passed"),
            F.col(rule.name).alias("failed"),
        )
        for rule in rules
    ]
    return counted.select(*by, F.inline(F.array(*rows)))
