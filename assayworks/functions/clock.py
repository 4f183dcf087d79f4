"""Time arithmetic. Every operator that needs "now" takes it as an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = Column | datetime | str | None


def moment(value: Moment = None) -> Column:
    """None is the query's current time; a string is read as a zone-less timestamp."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        return F.lit(value)
    return F.lit(value).cast("timestamp_ntz")


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds, fractions cut on both sides first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier).cast("double") / 3600


def from_epoch_millis(value: Column | str) -> Column:
    return F.timestamp_millis(value)


def days_before(value: Moment, days: int) -> Column:
    return F.date_sub(moment(value).cast("date"), days)
