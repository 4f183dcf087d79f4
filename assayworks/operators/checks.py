"""Table checks: all metrics of a table in one aggregation, then one row per check.

A check is an aggregate plus a verdict over it. ``run`` puts the aggregates of
every check into a single pass over the table; only checks that need another
input (``over``) add a pass of their own. Results are a DataFrame with the columns of
both check logs, nothing is brought to the driver until ``gate``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.functions.clock import Moment, moment
from assayworks.functions.text import list_text, one_decimal

# Statuses, check types and log columns.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
DIRECT, EXPECTATION = "direct", "expectation"
RUN_LOG_COLUMNS = (
    "run_id", "pipeline_name", "check_name", "check_type", "status", "message", "checked_at",
)
CONTRACT_LOG_COLUMNS = (
    "run_id", "table_name", "check_name", "status", "actual_value", "expected_value", "checked_at",
)


class CheckFailed(RuntimeError):
    """Raised by gate() with one line per failed check."""


class Verdict(NamedTuple):
    """SQL text over the metrics and ``now``."""

    status: str
    message: str
    actual: str
    expected: str


Values = Mapping[str, Any]


@dataclass(frozen=True)
class Footer:
    """How file footers can answer a check: counts and extremes to ask for, and the check's measures from them, or None if they do not tell."""

    asks: Mapping[str, str]
    measures: Callable[[Values], Values | None]


@dataclass(frozen=True)
class Check:
    """``measures`` are SQL aggregates; ``verdict`` gets the column name of each."""

    name: str
    verdict: Callable[[Mapping[str, str]], Verdict]
    measures: Mapping[str, str] = field(default_factory=dict)
    over: Callable[[DataFrame], DataFrame] | None = None
    needs: tuple[str, ...] = ()
    check_type: str = DIRECT
    footer: Footer | None = None


def _quoted(text: object) -> str:
    """A SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _decide(failed: str, when_failed: str, when_passed: str, actual: str, expected: object) -> Verdict:
    return Verdict(f"IF({failed}, '{FAIL}', '{PASS}')", f"IF({failed}, {when_failed}, {when_passed})",
                   f"CAST({actual} AS STRING)", _quoted(expected))


def _constant(name: str, failed: bool, message: str, actual: str, expected: str) -> Check:
    verdict = Verdict(f"'{FAIL if failed else PASS}'", _quoted(message), _quoted(actual), _quoted(expected))
    return Check(name, lambda _: verdict)


def _none_counted(name: str, aggregate: str, found: str, clean: str, **scope: Any) -> Check:
    """Fails when the counted number of offending rows or keys is not zero."""
    def verdict(m: Mapping[str, str]) -> Verdict:
        return _decide(f"{m['n']} > 0", f"concat({m['n']}, {_quoted(found)})", _quoted(clean), m["n"], 0)
    return Check(name, verdict, {"n": aggregate}, **scope)


# --- checks answered by the shared pass --------------------------------------------------------


def not_empty(table: str, name: str = "silver_not_empty") -> Check:
    def verdict(m: Mapping[str, str]) -> Verdict:
        rows = m["rows"]
        return _decide(f"{rows} = 0", _quoted(f"{table} is empty"), f"concat({rows}, ' rows')", rows, "> 0")
    return Check(name, verdict, {"rows": "count(1)"}, footer=Footer({"rows": "count(1)"}, lambda v: {"rows": v["rows"]}))


def freshness(column: str, limit_hours: float, name: str = "silver_freshness") -> Check:
    """Fails when the newest value is older than the limit (exactly the limit passes) or missing."""
    def verdict(m: Mapping[str, str]) -> Verdict:
        newest = m["newest"]
        age = f"((unix_timestamp(now) - unix_timestamp({newest})) / 3600D)"
        told = f"concat({_quoted(f'Most recent {column} is ')}, {one_decimal(age)}, 'h ago')"
        late = f"concat({told}, {_quoted(f' (threshold: {limit_hours}h)')})"
        absent = f"{newest} IS NULL"
        return _decide(f"({absent} OR {age} > {limit_hours})",
                       f"IF({absent}, {_quoted(f'{column} is null')}, {late})", told,
                       f"IF({absent}, NULL, {one_decimal(age)})", f"<= {limit_hours}")
    return Check(name, verdict, {"newest": f"max({_named(column)})"}, needs=(column,))


def column_not_null(column: str, name: str | None = None) -> Check:
    return _none_counted(name or f"{column}_not_null", f"count_if({_named(column)} IS NULL)",
                         f" rows with null {column}", f"No null {column} rows", needs=(column,),
                         footer=Footer({"rows": "count(1)", "set": f"count({_named(column)})"}, lambda v: {"n": v["rows"] - v["set"]}))


def column_gte_zero(column: str, name: str | None = None) -> Check:
    return _none_counted(name or f"non_negative_{column}", f"count_if({_named(column)} < 0)",
                         f" rows with {column} < 0", f"All {column} values >= 0", needs=(column,),
                         footer=Footer({"low": f"min({_named(column)})"}, lambda v: None if v["low"] is not None and v["low"] < 0 else {"n": 0}))


def nullability(columns: Sequence[str], name: str = "non_nullable_columns") -> Check:
    """Fails when any of the columns holds a NULL; the message lists the offenders with counts."""
    def verdict(m: Mapping[str, str]) -> Verdict:
        total = "(" + " + ".join(m[c] for c in columns) + ")"
        offenders = ", ".join(f"IF({m[c]} > 0, concat({_quoted(f'{c}=')}, {m[c]}), NULL)" for c in columns)
        return _decide(f"{total} > 0", f"concat('NULLs in ', concat_ws(', ', {offenders}))",
                       "'No NULLs in non-nullable columns'", total, 0)
    asks = {"rows": "count(1)", **{f"set_{c}": f"count({_named(c)})" for c in columns}}
    return Check(name, verdict, {c: f"count_if({_named(c)} IS NULL)" for c in columns}, needs=tuple(columns),
                 footer=Footer(asks, lambda v: {c: v["rows"] - v[f"set_{c}"] for c in columns}))


# --- checks answered by the schema alone -------------------------------------------------------


def required_columns(df: DataFrame, columns: Sequence[str], name: str = "required_columns") -> Check:
    missing = [c for c in columns if c not in df.columns]
    message = f"Missing columns: {list_text(missing)}" if missing else "All expected columns present"
    return _constant(name, bool(missing), message, list_text(df.columns), list_text(list(columns)))


def column_types(df: DataFrame, expected: Mapping[str, str], name: str = "column_types") -> Check:
    """``decimal`` accepts any precision and ``timestamp`` also the zone-less kind."""
    aliases = {"long": "bigint", "integer": "int", "timestamp_ntz": "timestamp"}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def same(declared: str, found: str) -> bool:
        declared, found = aliases.get(declared, declared), aliases.get(found, found)
        return found.startswith("decimal(") if declared == "decimal" else declared == found

    wrong = {c: t for c, t in expected.items() if not same(t, actual.get(c, "absent"))}
    found = ", ".join(f"{c} {actual.get(c, 'absent')}" for c in wrong)
    declared = ", ".join(f"{c} {t}" for c, t in expected.items())
    return _constant(name, bool(wrong), f"Type differs: {found}" if wrong else "All types as declared",
                     found or declared, declared)


# --- checks with an input of their own ---------------------------------------------------------


def rejection_ratio(bronze: DataFrame, rejected: DataFrame, threshold: float,
                    name: str = "rejection_ratio") -> Check:
    """Fails above the threshold, so exactly the threshold passes; empty bronze only warns."""
    def both(_: DataFrame) -> DataFrame:
        return bronze.select(F.lit(True).alias("landed")).unionAll(rejected.select(F.lit(False)))

    def verdict(m: Mapping[str, str]) -> Verdict:
        landed, bad = m["bronze"], m["rejected"]
        ratio = f"try_divide({bad}, {landed})"
        share = f"concat({one_decimal(f'{ratio} * 100')}, '%')"
        empty = f"{landed} = 0"
        return Verdict(
            f"CASE WHEN {empty} THEN '{WARN}' WHEN {ratio} > {threshold}D THEN '{FAIL}' ELSE '{PASS}' END",
            f"IF({empty}, 'bronze table is empty — skipping ratio check', concat({bad}, '/', {landed}, "
            f"' rows rejected (', {share}, ', threshold: {threshold:.0%})'))",
            f"IF({empty}, 'no rows', {share})", _quoted(f"<= {threshold:.0%}"),
        )
    return Check(name, verdict, {"bronze": "count_if(landed)", "rejected": "count_if(NOT landed)"}, over=both)


def unique_key(keys: Sequence[str], name: str = "unique_key") -> Check:
    """Counts key values that occur more than once, NULL counting as a value."""
    label = ", ".join(keys)
    return _none_counted(name, "count_if(_copies > 1)", f" repeated keys ({label})",
                         f"Every key is unique ({label})", needs=tuple(keys),
                         over=lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")))


def no_orphans(parent: DataFrame, keys: Sequence[str], name: str = "no_orphan_keys") -> Check:
    """Counts rows whose key is absent from ``parent``; see orphan_keys()."""
    return _none_counted(name, "coalesce(sum(_rows), 0L)", " rows without a parent", "Every row has a parent",
                         needs=tuple(keys), over=lambda df: orphan_keys(df, parent, keys))


def orphan_keys(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their row counts.

    Both sides are reduced to one row per key before the anti join, with partial
    aggregation, so neither a hot child key nor many copies of a parent key travel whole.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.join(parent.select(*keys).distinct(), list(keys), "left_anti")


# --- running -----------------------------------------------------------------------------------


def run(df: DataFrame, checks: Sequence[Check], *, run_id: str, pipeline: str, table: str,
        as_of: Moment = None, parquet: str | None = None) -> DataFrame:
    """Check rows in the order given. A check on an absent column fails instead of erroring.

    ``parquet`` names the folder of Parquet files that ``df`` reads whole. Checks that the files' footers answer (counts, missing values,
    no value below zero) then read no rows; the others are measured as usual.
    """
    ready = [_guarded(df, check) for check in checks]
    shared = [c for c in ready if c.over is None]
    known = {} if parquet is None else _from_footers(df.sparkSession, parquet, shared)
    settled, rest = [c for c in shared if c.name in known], [c for c in shared if c.name not in known]
    order = {c.name: position for position, c in enumerate(ready)}
    passes = [(df, rest)] if rest else []
    passes += [(c.over(df), [c]) for c in ready if c.over is not None]
    frames = [_one_pass(source, group, order, moment(as_of)) for source, group in passes]
    if settled:
        frames.append(_one_pass(df, settled, order, moment(as_of), known))
    return reduce(DataFrame.unionAll, frames).selectExpr(
        f"{_quoted(run_id)} AS run_id", f"{_quoted(pipeline)} AS pipeline_name", f"{_quoted(table)} AS table_name",
        "check_name", "check_type", "status", "message", "actual_value", "expected_value",
        "now AS checked_at", "position",
    )


def _guarded(df: DataFrame, check: Check) -> Check:
    absent = [c for c in check.needs if c not in df.columns]
    if not absent:
        return check
    return _constant(check.name, True, f"Missing columns: {list_text(absent)}", "absent", "present")


def footer_aggregates(spark: SparkSession, path: str, asks: Mapping[str, str]) -> DataFrame:
    """One row of counts and extremes of a folder of Parquet files, which Spark takes from their footers where these have them."""
    session = spark.newSession()  # with settings of its own; those of the caller stay as they are
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(*[F.expr(sql).alias(name) for name, sql in asks.items()])


def _from_footers(spark: SparkSession, path: str, checks: Sequence[Check]) -> dict[str, Values]:
    """The measures of the checks that footers settle; one row comes to the driver.

    A file whose column is all NULL has no extremes, and Spark then refuses; counts are asked for alone then, and what no footer
    tells is left to be measured from the rows.
    """
    for extremes in (True, False):
        able = [c for c in checks if c.footer and (extremes or not any(sql.startswith("min(") for sql in c.footer.asks.values()))]
        asks = {f"{i}_{k}": sql for i, c in enumerate(able) for k, sql in c.footer.asks.items()}
        if not asks:
            return {}
        try:
            row = footer_aggregates(spark, path, asks).first().asDict()
        except (CapturedException, Py4JJavaError):
            continue
        if any(row[name] is None for name, sql in asks.items() if sql.startswith("count(")):  # files without rows tell nothing
            return {}
        told = {c.name: c.footer.measures({k: row[f"{i}_{k}"] for k in c.footer.asks}) for i, c in enumerate(able)}
        return {name: values for name, values in told.items() if values is not None}
    return {}


def _one_pass(source: DataFrame, checks: Sequence[Check], order: Mapping[str, int], now: Column,
              known: Mapping[str, Values] | None = None) -> DataFrame:
    metrics, rows = [], []
    for index, check in enumerate(checks):
        labels = {key: f"`m{index}_{key}`" for key in check.measures}
        if known is None:
            metrics += [F.expr(f"{sql} AS {labels[key]}") for key, sql in check.measures.items()]
        else:
            metrics += [F.lit(known[check.name][key]).cast("long").alias(labels[key].strip("`")) for key in check.measures]
        status, message, actual, expected = check.verdict(labels)
        rows.append(
            f"struct({order[check.name]} AS position, {_quoted(check.name)} AS check_name, "
            f"{_quoted(check.check_type)} AS check_type, {status} AS status, {message} AS message, "
            f"{actual} AS actual_value, {expected} AS expected_value)"
        )
    if known is not None:
        measured = source.sparkSession.range(1).select(*metrics)
    elif metrics:
        measured = source.agg(*metrics)
    else:  # schema-only checks: a one-row frame that reads nothing
        measured = source.sparkSession.range(1)
    return measured.withColumn("now", now).select("now", F.expr(f"inline(array({', '.join(rows)}))"))


def to_run_log(results: DataFrame) -> DataFrame:
    return results.select(*RUN_LOG_COLUMNS)


def to_contract_log(results: DataFrame) -> DataFrame:
    return results.select(*CONTRACT_LOG_COLUMNS)


def tally(results: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Passed, warned and failed counts with the overall status; warnings never fail a run."""
    counted = results.groupBy(*by).agg(*[
        F.count_if(F.col("status") == status).alias(name)
        for status, name in ((PASS, "passed"), (WARN, "warned"), (FAIL, "failed"))
    ])
    return counted.select(
        "*", F.when(F.col("failed") > 0, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("overall")
    )


def gate(results: DataFrame) -> None:
    """Raises CheckFailed when a check failed. Call it on logged rows, after the log write.

    Only failed check rows come to the driver; there are as many as checks were declared.
    """
    failed = results.filter(F.col("status") == FAIL).select("pipeline_name", "check_name", "message")
    lines = [f"[{row[0]}] {row[1]}: {row[2]}" for row in failed.collect()]
    if lines:
        raise CheckFailed(f"{len(lines)} check(s) failed\n" + "\n".join(lines))


def gate_decisions(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """What gate() would do with each group of check rows: ``passes``, and the number of failed checks."""
    failed = F.count_if(F.col("status") == FAIL)
    return results.groupBy(*by).agg((failed == 0).alias("passes"), failed.alias("failed"))


def reconcile(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Actual against expected row counts, one count-only scan per table."""
    spark = next(iter(tables.values())).sparkSession
    wanted = spark.createDataFrame(list(expected.items()), "table_name string, expected_rows bigint")
    counted = reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(name).alias("table_name"), "actual_rows")
        for name, df in tables.items()
    ])
    return wanted.join(counted, "table_name", "left").select(
        "table_name", "expected_rows", "actual_rows",
        F.when(F.col("expected_rows") == F.col("actual_rows"), F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
    )
