"""Declared table contracts, turned into rules and checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from assayworks.operators import checks as C
from assayworks.operators.rules import Rule


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    """Columns, quality checks and rejection rules of one published table."""

    table: str
    columns: tuple[ContractColumn, ...]
    quality_checks: tuple[Mapping[str, Any], ...] = ()
    rejection: tuple[Rule, ...] = ()

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> Contract:
        """Accepts the parsed form of a contract file (JSON or YAML)."""
        severity = (spec.get("rejection") or {}).get("severity", "business_invalid")
        return cls(
            table=spec["table"],
            columns=tuple(
                ContractColumn(c["name"], c["type"], c.get("nullable", True)) for c in spec["schema"]
            ),
            quality_checks=tuple(spec.get("quality_checks") or ()),
            rejection=tuple(
                Rule(r["name"], r["constraint"], severity)
                for r in (spec.get("rejection") or {}).get("rules", ())
            ),
        )

    @classmethod
    def from_file(cls, path: str, **names: str) -> Contract:
        """Reads a ``.json`` or ``.yml`` contract; ``${name}`` placeholders are filled from ``names``."""
        with open(path, encoding="utf-8") as source:
            text = source.read()
        for name, value in names.items():
            text = text.replace("${" + name + "}", value)
        if path.endswith(".json"):
            import json
            return cls.from_dict(json.loads(text))
        try:
            import yaml
        except ImportError as missing:  # optional dependency
            raise RuntimeError("reading YAML contracts needs the yaml package") from missing
        return cls.from_dict(yaml.safe_load(text))

    def checks(self, df: DataFrame, *, bronze: DataFrame | None = None,
               rejected: DataFrame | None = None) -> list[C.Check]:
        """The declared quality checks, in order. A ratio check needs bronze and rejected."""
        return [self._check(spec, df, bronze, rejected) for spec in self.quality_checks]

    def schema_checks(self, df: DataFrame) -> list[C.Check]:
        """Types and nullability of the declared columns."""
        found = [C.column_types(df, {c.name: c.type for c in self.columns})]
        required = [c.name for c in self.columns if not c.nullable]
        return found + ([C.nullability(required)] if required else [])

    def _check(self, spec: Mapping[str, Any], df: DataFrame, bronze: DataFrame | None,
               rejected: DataFrame | None) -> C.Check:
        kind, name = spec["type"], spec["name"]
        if kind == "row_count_gt_zero":
            return C.not_empty(self.table, name)
        if kind == "freshness_hours":
            return C.freshness(spec["column"], spec["threshold"], name)
        if kind == "columns_present":
            return C.required_columns(df, spec["columns"], name)
        if kind == "column_not_null":
            return C.column_not_null(spec["column"], name)
        if kind == "column_gte_zero":
            return C.column_gte_zero(spec["column"], name)
        if kind == "unique_key":
            return C.unique_key(spec["columns"], name)
        if kind == "fraction_lt_threshold":
            if bronze is None or rejected is None:
                raise ValueError(f"{name}: pass bronze and rejected")
            return C.rejection_ratio(bronze, rejected, spec["threshold"], name)
        raise ValueError(f"unknown check type {kind!r}")
