"""Text standardisation and message formatting. Only space characters are trimmed, tabs stay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(value: Column | str) -> Column:
    """Trimmed, first letter of every blank-separated word upper, the rest lower."""
    return F.initcap(F.trim(value))


def lower_case(value: Column | str) -> Column:
    return F.lower(F.trim(value))


def upper_case(value: Column | str) -> Column:
    return F.upper(F.trim(value))


def clipped(value: Column | str, length: int) -> Column:
    """The first ``length`` characters; NULL becomes the empty string."""
    return F.substring(F.coalesce(value if isinstance(value, Column) else F.col(value), F.lit("")), 1, length)


def one_decimal(value: str) -> str:
    """SQL for a double as text with one decimal, by its exact binary value and ties to even.

    The engine's own format_string rounds the shortest decimal form half up, which tells 0.15 as 0.2
    although the double lies below 0.15. Here the double is scaled by a power of two to a whole
    number, so that twenty times the value can be split into whole and rest without error.
    """
    scaled = (f"transform(array(CAST({value} AS DOUBLE)), x -> "
              "struct(x, least(62, 54 - CAST(floor(log2(abs(x))) AS INT)) AS bits))")
    twenty = (f"transform({scaled}, v -> struct(v.x, CAST(abs(v.x) * pow(2, v.bits) AS BIGINT) * 20 AS n, "
              "CAST(pow(2, v.bits) AS BIGINT) AS unit))")
    parts = f"transform({twenty}, v -> struct(v.x, v.n div v.unit AS half_tenths, v.n % v.unit = 0 AS exact))"
    # an odd count of half tenths rounds up, unless it is exact and the tenth below is even
    tenths = (f"transform({parts}, v -> struct(v.x, v.half_tenths div 2 + "
              "IF(v.half_tenths % 2 = 1 AND NOT (v.exact AND v.half_tenths % 4 = 1), 1, 0) AS n))")
    return f"element_at(transform({tenths}, v -> concat(IF(v.x < 0, '-', ''), v.n div 10, '.', v.n % 10)), 1)"


def missing_text(*names: str) -> list[Column]:
    """Typed NULL string columns, for outputs that must keep a fixed schema."""
    return [F.lit(None).cast("string").alias(name) for name in names]


def list_text(names: list[str]) -> str:
    """``['a', 'b']`` for a sorted list of names, the form used in audit values."""
    return str(sorted(names))
