import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assayworks.functions import clock
from assayworks.functions.text import clipped, one_decimal
from tests.shapes import NOON


def test_one_decimal_is_exact(spark):
    """Decimal ties, exact ties, hours from whole seconds, percentages and tiny or large values."""
    rng = random.Random(3)
    numbers = [n / 20 for n in range(2001)] + [n / 2000 * 100 for n in range(2001)] + [s / 3600 for s in range(0, 400000, 180)]
    numbers += [rng.uniform(0, 10 ** rng.randrange(-6, 9)) for _ in range(3000)] + [0.0, 1e-300, 0.04, 0.05, 2.0 ** 30, 0.95, 9.95]
    numbers += [-n for n in numbers]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    told = {r.x: r.t for r in df.select("x", F.expr(one_decimal("x")).alias("t")).collect()}
    plain = lambda text: "0.0" if text == "-0.0" else text
    wrong = [(n, told[n], f"{n:.1f}") for n in numbers if plain(told[n]) != plain(f"{n:.1f}")]
    assert wrong == []
    assert spark.range(1).select(F.expr(one_decimal("CAST(NULL AS DOUBLE)"))).first()[0] is None


@pytest.mark.parametrize("later, earlier, seconds, hours", [
    (datetime(2026, 1, 2), datetime(2026, 1, 1), 86400, 24.0),
    (datetime(2026, 1, 1, 0, 0, 1, 200000), datetime(2026, 1, 1, 0, 0, 0, 900000), 1, 1 / 3600),
    (NOON, None, None, None),
])
def test_elapsed_time_cuts_fractions_first(spark, later, earlier, seconds, hours):
    row = spark.createDataFrame([(later, earlier)], "a timestamp, b timestamp").select(
        clock.seconds_between("a", "b").alias("s"), clock.hours_between("a", "b").alias("h")).first()
    assert (row.s, row.h) == (seconds, hours)


def test_moments(spark):
    row = spark.range(1).select(
        clock.from_epoch_millis(F.lit(1700000000123)).alias("millis"), clock.days_before("2026-03-01 10:00:00", 7).alias("day"),
        clock.moment(NOON).alias("at"), clock.moment("2026-05-19 12:00:00").alias("text"), clock.moment().alias("now")).first()
    assert (row.millis, row.day) == (datetime(2023, 11, 14, 22, 13, 20, 123000), date(2026, 2, 22))
    assert row["at"] == row.text == NOON and row.now is not None


def test_clipped(spark):
    df = spark.createDataFrame([("abcdef",), (None,)], "m string")
    assert [r[0] for r in df.select(clipped("m", 3)).collect()] == ["abc", ""]
