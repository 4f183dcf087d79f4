"""Quality rules: a named SQL predicate with a severity.

============================  =============================  ==================
severity                      mode "drop"                    mode "fail"
============================  =============================  ==================
critical                      abort                          abort
business_invalid              route the row to rejected      abort
warning                       keep the row, count it         keep, count
============================  =============================  ==================

A constraint that evaluates to NULL satisfies the rule under ``null_policy="pass"``
and breaks it under ``"violation"``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Severity = Literal["critical", "business_invalid", "warning"]
Mode = Literal["drop", "fail"]
NullPolicy = Literal["pass", "violation"]

SEVERITIES = ("critical", "business_invalid", "warning")


@dataclass(frozen=True)
class Rule:
    name: str
    constraint: str
    severity: Severity

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"rule {self.name}: unknown severity {self.severity!r}")


class Grading(NamedTuple):
    """Rules by what a violation does."""

    abort: tuple[Rule, ...]
    drop: tuple[Rule, ...]
    observe: tuple[Rule, ...]


def grade(rules: Sequence[Rule], mode: Mode = "drop") -> Grading:
    if mode not in ("drop", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    aborting = {"critical"} if mode == "drop" else {"critical", "business_invalid"}
    abort = tuple(r for r in rules if r.severity in aborting)
    observe = tuple(r for r in rules if r.severity == "warning")
    return Grading(abort, tuple(r for r in rules if r not in abort and r not in observe), observe)


def broken(rule: Rule, null_policy: NullPolicy = "pass") -> Column:
    """TRUE where the row violates the rule; never TRUE elsewhere.

    The form is three-valued on purpose: as a filter, a WHEN branch or a
    count_if argument NULL acts as "not broken", and a bare comparison can
    still be pushed into a file scan.
    """
    violated = ~F.expr(rule.constraint)
    if null_policy == "pass":
        return violated
    if null_policy == "violation":
        return violated | F.expr(rule.constraint).isNull()
    raise ValueError(f"unknown null_policy {null_policy!r}")


def satisfied(rule: Rule, null_policy: NullPolicy = "pass") -> Column:
    """TRUE exactly where ``broken`` is not TRUE, again in a form that can be pushed down."""
    holds = F.expr(rule.constraint)
    if null_policy == "pass":
        return holds | F.expr(rule.constraint).isNull()
    if null_policy == "violation":
        return holds
    raise ValueError(f"unknown null_policy {null_policy!r}")


def any_broken(rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> Column:
    verdict = F.lit(False)
    for position, rule in enumerate(rules):
        verdict = broken(rule, null_policy) if position == 0 else verdict | broken(rule, null_policy)
    return verdict


def broken_names(rules: Sequence[Rule], null_policy: NullPolicy = "pass") -> list[Column]:
    """One column per rule: its name where broken, else NULL."""
    return [F.when(broken(rule, null_policy), F.lit(rule.name)) for rule in rules]
