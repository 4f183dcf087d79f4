"""Named queries over the driver's tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.functions.clock import from_epoch_millis
from assayworks.functions.lookup import joined
from assayworks.operators import checks as C
from assayworks.operators import eventlog as E
from assayworks.operators import history as H
from assayworks.operators import routing as R
from assayworks.operators import status as S
from assayworks.operators.contract import Contract, ContractColumn
from assayworks.operators.rules import Rule
from assayworks.operators.summary import summarise
from assayworks.plans import adapters as A
from assayworks.plans import customer_orders as P
from assayworks.plans import daily
from assayworks.sources import tables as T
from assayworks.sources.buckets import Buckets
from assayworks.sources.landing import landing_path, read_csv, to_bronze
from assayworks.sources.scratch import materialised, scratch_path
from assayworks.sources.versions import merged_read
from assayworks.streaming import flow

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01 18:00:00"
EVENTS_AS_OF = "2024-01-31 12:00:00"
FILE_NAME = r"([^/]+)$"

EVENT_RULES = (
    Rule("known_user", "user_id IS NOT NULL", "critical"),
    Rule("value_over_five", "value > 5", "business_invalid"),
    Rule("no_errors", "event_type <> 'error'", "business_invalid"),
    Rule("value_under_300", "value < 300", "warning"),
)

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return P.customers_silver(A.customers_bronze(spark, sf))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return P.orders_silver(A.orders_bronze(spark, sf))


# --- bronze and silver -------------------------------------------------------------------------


@query
def bronze_orders_projection(spark: SparkSession, sf: str) -> DataFrame:
    raw = A.table(spark, sf, "orders")
    return to_bronze(raw, raw.schema, AS_OF).withColumn(
        "_source_file", F.regexp_extract("_source_file", FILE_NAME, 1)
    )


@query
def customers_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _customers(spark, sf)


@query
def orders_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf)


@query
def region_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """Codes are shifted, so that some name no nation."""
    regions = A.table(spark, sf, "nation").join(
        A.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = A.table(spark, sf, "customer").selectExpr("c_custkey", "cast(c_nationkey + 4 as bigint) AS nation_code")
    return joined(customers, "nation_code", regions, "n_nationkey", "r_name", "Unknown", "region")


# --- rules and routing -------------------------------------------------------------------------


@query
def customers_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return R.split(_customers(spark, sf), P.CUSTOMER_RULES).rejected


@query
def orders_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return R.split(_orders(spark, sf), P.ORDER_RULES).rejected


@query
def orders_rejected_null_violation(spark: SparkSession, sf: str) -> DataFrame:
    return R.split(_orders(spark, sf), P.ORDER_RULES, null_policy="violation").rejected


@query
def rejected_no_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Without a business-invalid rule every order is silver."""
    return R.route(_orders(spark, sf), [r for r in P.ORDER_RULES if r.severity != "business_invalid"])


@query
def split_no_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of a split without a business-invalid rule, counted: nothing is rejected, whatever else a rule says."""
    sides = R.split(_orders(spark, sf), [r for r in P.ORDER_RULES if r.severity != "business_invalid"])
    counted = [side.groupBy().agg(F.count(F.lit(1)).alias("n_rows"), F.count(side.columns[0]).alias("n_ids")).withColumn("destination", F.lit(name))
               for name, side in (("silver", sides.silver), ("rejected", sides.rejected))]
    return counted[0].unionByName(counted[1])


@query
def events_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return R.rejected(A.customer_changes(spark, sf), EVENT_RULES)


@query
def orders_routed(spark: SparkSession, sf: str) -> DataFrame:
    return R.route(_orders(spark, sf), P.ORDER_RULES)


@query
def events_tagged(spark: SparkSession, sf: str) -> DataFrame:
    tagged = R.tag(A.customer_changes(spark, sf), EVENT_RULES, out="failed")
    return tagged.withColumn("failed", F.array_join("failed", "+"))


@query
def split_partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    routed = R.route(_customers(spark, sf), P.CUSTOMER_RULES, null_policy="violation")
    return routed.groupBy(F.col(R.ROUTE).alias("destination")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def warning_violations(spark: SparkSession, sf: str) -> DataFrame:
    return R.violations(_customers(spark, sf), P.CUSTOMER_RULES[2])


@query
def rule_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return R.rule_metrics(P.orders_silver(A.orders_bronze_with_gaps(spark, sf)), P.ORDER_RULES)


@query
def rule_metrics_by_event_type(spark: SparkSession, sf: str) -> DataFrame:
    return R.rule_metrics(A.customer_changes(spark, sf), EVENT_RULES, by=["event_type"])


@query
def enforce_fail_clean(spark: SparkSession, sf: str) -> DataFrame:
    rules = [r for r in P.ORDER_RULES if r.severity == "critical"]
    return R.enforce(_orders(spark, sf), rules).groupBy("status_std").agg(F.count(F.lit(1)).alias("n_rows"))


# --- summaries ---------------------------------------------------------------------------------


def _summary(spark: SparkSession, sf: str, null_policy: str = "pass") -> DataFrame:
    customers = R.split(_customers(spark, sf), P.CUSTOMER_RULES, null_policy=null_policy)
    orders = R.split(_orders(spark, sf), P.ORDER_RULES, null_policy=null_policy)
    return P.customer_order_summary(customers.silver, orders.silver)


@query
def customer_order_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf)


@query
def customer_order_summary_null_violation(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf, "violation")


@query
def part_supplier_summary(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = A.table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "supplier_id")
    lines = A.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "supplier_id")
    return summarise(
        suppliers, lines, "supplier_id",
        {
            "line_count": F.count("l_orderkey"),
            "returned_value": F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice").cast("decimal(12,2)"))),
            "last_ship_date": F.max("l_shipdate"),
        },
        carry=["s_name"], zero=["line_count"],
    )


@query
def order_totals_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the orders before 2001, folded with those of the later batch."""
    orders = _orders(spark, sf)
    early = F.col("order_date") < F.lit("2001-01-01").cast("timestamp_ntz")
    return P.order_totals(orders.filter(~early), before=P.order_totals(orders.filter(early)))


@query
def summary_versioned_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals in buckets: three batches, the second one delivered twice, then the summary of the totals."""
    customers = R.split(_customers(spark, sf), P.CUSTOMER_RULES).silver
    orders = R.split(_orders(spark, sf), P.ORDER_RULES).silver.withColumn("order_date", F.col("order_date").cast("timestamp"))
    totals = P.order_buckets(scratch_path(spark, "order_totals"), 8)
    totals.create(spark.createDataFrame([], totals.schema))
    for mark, part in ((1, 0), (2, 1), (2, 1), (3, 2)):
        totals.apply(orders.filter(f"order_id % 3 = {part}"), P.totals_with, mark=mark)
    summary = P.summary_of_totals(customers, totals.state(spark))
    return summary.withColumn("last_order_date", F.col("last_order_date").cast("timestamp_ntz"))


# --- audits ------------------------------------------------------------------------------------


def _silver_audit(spark: SparkSession, sf: str, domain: str, hours: int) -> DataFrame:
    bronze, transform, rules, contract = {
        "customers": (A.customers_bronze, P.customers_silver, P.CUSTOMER_RULES, P.CUSTOMERS_CONTRACT),
        "orders": (A.orders_bronze, P.orders_silver, P.ORDER_RULES, P.ORDERS_CONTRACT),
    }[domain]
    landed = bronze(spark, sf)
    sides = R.split(transform(landed), rules)
    return daily.silver_results(
        contract, sides.silver, landed, sides.rejected, run_id="r1", pipeline=f"{domain}_pipeline",
        freshness_hours=hours, as_of=AS_OF,
    )


@query
def audit_silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return C.to_run_log(_silver_audit(spark, sf, "customers", 168))


@query
def audit_silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are 18 hours old, over a limit of 12."""
    return C.to_run_log(_silver_audit(spark, sf, "orders", 12))


@query
def audit_contract_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Declared quality checks of the orders contract, in contract-log form."""
    landed = A.orders_bronze(spark, sf)
    sides = R.split(P.orders_silver(landed), P.ORDERS_CONTRACT.rejection)
    found = P.ORDERS_CONTRACT.checks(sides.silver, bronze=landed, rejected=sides.rejected)
    return C.to_contract_log(C.run(
        sides.silver, found, run_id="r1", pipeline="orders_pipeline", table="orders_silver", as_of=AS_OF))


def _summary_audit(spark: SparkSession, sf: str) -> DataFrame:
    return daily.summary_results(_summary(spark, sf), run_id="r2", as_of=AS_OF)


@query
def audit_gold(spark: SparkSession, sf: str) -> DataFrame:
    return C.to_contract_log(_summary_audit(spark, sf))


@query
def audit_gold_run_log(spark: SparkSession, sf: str) -> DataFrame:
    return C.to_run_log(_summary_audit(spark, sf))


@query
def audit_gold_from_footers(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks over a published version of the summary, answered by its files' footers."""
    path = T.publish(_summary(spark, sf), scratch_path(spark, "summary"))
    return C.to_contract_log(daily.summary_results(spark.read.parquet(path), run_id="r2", as_of=AS_OF, parquet=path))


@query
def audit_contract_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The orders contract against rows with missing ids."""
    silver = P.orders_silver(A.orders_bronze_with_gaps(spark, sf))
    return C.to_contract_log(C.run(
        silver, P.ORDERS_CONTRACT.schema_checks(silver), run_id="r3", pipeline="orders_pipeline",
        table="orders_silver", as_of=AS_OF))


@query
def audit_contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A contract that lineitem breaks in every check."""
    lines = A.table(spark, sf, "lineitem").withColumn("l_discount", F.col("l_discount") - 0.05)
    contract = Contract(
        "lineitem", (ContractColumn("l_orderkey", "int"), ContractColumn("l_shipdate", "timestamp")),
        ({"name": "columns", "type": "columns_present", "columns": ["l_orderkey", "l_batch"]},
         {"name": "batch_set", "type": "column_not_null", "column": "l_batch"},
         {"name": "discount_sign", "type": "column_gte_zero", "column": "l_discount"},
         {"name": "one_line_per_order", "type": "unique_key", "columns": ["l_orderkey"]}),
    )
    found = contract.checks(lines) + contract.schema_checks(lines)
    return C.to_contract_log(C.run(
        lines, found, run_id="r4", pipeline="lines_pipeline", table="lineitem", as_of=AS_OF))


@query
def audit_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Silver orders against silver customers."""
    customers = R.split(_customers(spark, sf), P.CUSTOMER_RULES).silver
    orders = R.split(_orders(spark, sf), P.ORDER_RULES).silver
    return C.to_contract_log(C.run(
        orders, [C.no_orphans(customers, ["customer_id"]), C.unique_key(["order_id"])],
        run_id="r5", pipeline="orders_pipeline", table="orders_silver", as_of=AS_OF))


@query
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _silver_audit(spark, sf, "customers", 168).unionByName(_silver_audit(spark, sf, "orders", 12))
    return C.tally(rows.unionByName(_summary_audit(spark, sf)))


@query
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    customers = R.split(_customers(spark, sf), P.CUSTOMER_RULES)
    orders = R.split(_orders(spark, sf), P.ORDER_RULES)
    bad_mail, negative = F.expr("c_custkey % 10 = 3"), F.expr("o_orderkey % 15 = 9 AND o_orderkey % 50 <> 11")
    n, bad = A.table(spark, sf, "customer").agg(F.count(F.lit(1)), F.count_if(bad_mail)).first()
    m, worse = A.table(spark, sf, "orders").agg(F.count(F.lit(1)), F.count_if(negative)).first()
    return C.reconcile(
        {"customers_silver": customers.silver, "customers_rejected": customers.rejected,
         "orders_silver": orders.silver, "orders_rejected": orders.rejected},
        {"customers_silver": n - bad, "customers_rejected": bad, "orders_silver": m - worse, "orders_rejected": worse},
    )


# --- event log ---------------------------------------------------------------------------------


@query
def event_log_latest_updates(spark: SparkSession, sf: str) -> DataFrame:
    return E.latest_updates(A.event_log(spark, sf))


@query
def event_log_totals(spark: SparkSession, sf: str) -> DataFrame:
    return E.expectation_totals(A.event_log(spark, sf))


@query
def event_log_expectations(spark: SparkSession, sf: str) -> DataFrame:
    return E.expectation_checks(A.event_log(spark, sf), "r6", EVENTS_AS_OF)


# --- status ------------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return S.run_outcomes(A.job_runs(spark, sf), A.task_runs(spark, sf), A.check_log(spark, sf))


@query
def run_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(spark, sf)


@query
def run_outcome_one_hour(spark: SparkSession, sf: str) -> DataFrame:
    """All runs and checks within one hour, in order by seconds of hours."""
    runs = A.job_runs(spark, sf).withColumn("recorded_at", F.expr(A.in_one_hour("recorded_at"))).withColumn(
        "started_at", F.expr("recorded_at - INTERVAL 2 SECONDS"))
    checks = A.check_log(spark, sf).withColumn("checked_at", F.expr(A.in_one_hour("checked_at")))
    return S.run_outcomes(runs, A.task_runs(spark, sf), checks, slices=("second", "hour"))


@query
def current_status(spark: SparkSession, sf: str) -> DataFrame:
    return S.current_status(_runs(spark, sf), EVENTS_AS_OF)


@query
def current_status_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The newest run of every schema and day; with this clock the older successes are stale."""
    runs = _runs(spark, sf).withColumn("day", F.col("recorded_at").cast("date"))
    return S.current_status(runs, EVENTS_AS_OF, by=["schema_name", "day"])


@query
def run_history(spark: SparkSession, sf: str) -> DataFrame:
    return S.run_history(_runs(spark, sf))


@query
def check_history(spark: SparkSession, sf: str) -> DataFrame:
    return S.check_history(A.check_log(spark, sf))


@query
def contract_history(spark: SparkSession, sf: str) -> DataFrame:
    return S.contract_history(A.contract_log(spark, sf))


@query
def latest_run_checks(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_run_checks(A.check_log(spark, sf))


@query
def latest_run_checks_lexicographic(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_run_checks(A.check_log(spark, sf), "lexicographic")


@query
def latest_contract_checks(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_contract_checks(A.contract_log(spark, sf))


@query
def all_direct_checks(spark: SparkSession, sf: str) -> DataFrame:
    return S.all_direct_checks(A.check_log(spark, sf))


@query
def reliability_7d(spark: SparkSession, sf: str) -> DataFrame:
    return S.reliability(_runs(spark, sf), EVENTS_AS_OF)


@query
def last_success(spark: SparkSession, sf: str) -> DataFrame:
    return S.last_success(_runs(spark, sf))


@query
def run_duration_series(spark: SparkSession, sf: str) -> DataFrame:
    return S.duration_series(_runs(spark, sf))


@query
def dataset_count(spark: SparkSession, sf: str) -> DataFrame:
    return S.row_total(_runs(spark, sf))


@query
def quality_trend(spark: SparkSession, sf: str) -> DataFrame:
    return S.quality_trend(A.check_log(spark, sf))


def _by_day(log: DataFrame, time: str, label: str) -> DataFrame:
    """The log as a table with a partition per day, as the product keeps it."""
    path = scratch_path(log.sparkSession, label)
    log.withColumn(T.DAY, F.col(time).cast("date")).write.partitionBy(T.DAY).parquet(path)
    return log.sparkSession.read.schema(log.schema.add(T.DAY, "date")).parquet(path)


@query
def latest_run_checks_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """From a log in days: ten neighbouring events in time make a run."""
    return S.latest_run_checks(_by_day(A.checks_in_time(spark, sf), "checked_at", "check_log"), day=T.DAY)


@query
def latest_contract_checks_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_contract_checks(_by_day(A.contract_log(spark, sf), "checked_at", "contract_log"), day=T.DAY)


@query
def reliability_7d_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return S.reliability(_by_day(_runs(spark, sf), "recorded_at", "job_log"), EVENTS_AS_OF, day=T.DAY)


# --- names, logs and views ---------------------------------------------------------------------


@contextmanager
def _catalog_schema(spark: SparkSession) -> Iterator[str]:
    """A catalog schema of its own, so that no call sees what another one left."""
    name = f"shop_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_path(spark, 'catalog')}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


@query
def log_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Check rows appended to the log in two writes, each gated, and read through the history view."""
    log = A.check_log(spark, sf).filter("status <> 'FAIL'")
    with _catalog_schema(spark) as schema:
        T.ensure_logs(spark, schema)
        T.ensure_logs(spark, schema)  # the second time changes nothing
        for part in (0, 1):
            rows = log.filter(f"run_id % 2 = {part}")
            T.append_log(rows, schema, "ops_pipeline_run_log")
        C.gate(spark.read.table(T.qualified(schema, "ops_pipeline_run_log")))
        T.define_views(spark, schema, T.status_views(schema))
        seen = spark.read.table(T.qualified(schema, "ops_pipeline_run_history_v"))
        return materialised(seen.withColumn("checked_at", F.col("checked_at").cast("timestamp_ntz")), "log_roundtrip")


@query
def gate_decision(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate says to each run of the check log: passed, or the number of failed direct checks."""
    return C.gate_decisions(A.check_log(spark, sf).filter(F.col("check_type") == C.DIRECT), ["run_id"])


@query
def board_from_views(spark: SparkSession, sf: str) -> DataFrame:
    """Runs appended to the job log, and the board's row read through its view."""
    with _catalog_schema(spark) as schema:
        T.ensure_logs(spark, schema)
        T.append_log(_runs(spark, sf), schema, "ops_job_run_log")
        T.define_views(spark, schema, T.status_views(schema))
        board = spark.read.table(T.qualified(schema, "ops_current_status_v")).drop("view_refreshed_at")
        times = [F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in board.dtypes]
        return materialised(board.select(*times), "board")


def _from_view(spark: SparkSession, log: DataFrame, name: str, view: str) -> DataFrame:
    """Rows appended to a log and one of the board's views read over it."""
    with _catalog_schema(spark) as schema:
        T.ensure_logs(spark, schema)
        T.append_log(log, schema, name)
        T.define_views(spark, schema, T.status_views(schema))
        seen = spark.read.table(T.qualified(schema, view))
        times = [F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in seen.dtypes]
        return materialised(seen.select(*times), "board_view")


@query
def latest_run_checks_view(spark: SparkSession, sf: str) -> DataFrame:
    return _from_view(spark, A.checks_in_time(spark, sf), "ops_pipeline_run_log", "ops_latest_run_checks_v")


@query
def latest_contract_checks_view(spark: SparkSession, sf: str) -> DataFrame:
    return _from_view(spark, A.contract_log(spark, sf), "ops_contract_check_log", "ops_latest_contract_checks_v")


@query
def direct_checks_view(spark: SparkSession, sf: str) -> DataFrame:
    return _from_view(spark, A.check_log(spark, sf), "ops_pipeline_run_log", "ops_direct_checks_v")


@query
def last_success_view(spark: SparkSession, sf: str) -> DataFrame:
    return _from_view(spark, _runs(spark, sf), "ops_job_run_log", "ops_last_success_v")


@query
def published_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver and rejected orders read by their names in the catalog."""
    routed = R.route(_orders(spark, sf), P.ORDER_RULES)
    path = scratch_path(spark, "routed")
    routed.write.partitionBy(R.ROUTE).parquet(path)
    sides = R.routed_split(spark.read.schema(routed.schema).parquet(path))
    with _catalog_schema(spark) as schema:
        T.define_views(spark, schema, {
            "orders_silver": T.published(sides.silver, path, f"{R.ROUTE} = '{R.SILVER}'"),
            "orders_rejected": T.published(sides.rejected, path, f"{R.ROUTE} = '{R.REJECTED}'")})
        silver, bad = (spark.read.table(T.qualified(schema, f"orders_{side}")) for side in ("silver", "rejected"))
        both = silver.withColumn("table_name", F.lit("orders_silver")).unionByName(
            bad.withColumn("table_name", F.lit("orders_rejected")), allowMissingColumns=True)
        return materialised(both, "published")


@query
def event_times_from_millis(spark: SparkSession, sf: str) -> DataFrame:
    """Event times told in milliseconds, as a job service does, and read as times."""
    told = A.table(spark, sf, "events").select("event_id", F.expr("unix_millis(cast(ts AS timestamp))").alias("millis"))
    return told.select("event_id", from_epoch_millis("millis").cast("timestamp_ntz").alias("at"))


# --- change history ----------------------------------------------------------------------------


@query
def backfill_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Events loaded twice, the second time with other values for every third."""
    events = A.customer_changes(spark, sf)
    again = events.withColumn("value", F.expr("if(event_id % 3 = 0, value + 1, value)"))
    return H.deduplicated(events.unionByName(again), ["event_id"], order=["value"])


@query
def backfill_drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    events = A.customer_changes(spark, sf)
    return H.deduplicated(events.unionByName(events), ["event_id"])


@query
def scd1_events(spark: SparkSession, sf: str) -> DataFrame:
    return H.scd1(A.customer_changes(spark, sf), ["user_id"], ["ts", "event_id"], "event_type = 'error'")


@query
def scd1_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches that interleave in time, applied one after the other."""
    changes, keys, order = A.customer_changes(spark, sf), ["user_id"], ["ts", "event_id"]
    first = H.latest(changes.filter("event_id % 2 = 0"), keys, order)
    state = H.scd1_state(first, changes.filter("event_id % 2 = 1"), keys, order)
    return H.live(state, "event_type = 'error'")


@query
def scd2_events(spark: SparkSession, sf: str) -> DataFrame:
    return H.scd2(A.customer_changes(spark, sf), ["user_id"], ["ts", "event_id"], "event_type = 'error'")


@query
def scd2_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """The same with one key for all events of types view and click."""
    changes = A.customer_changes(spark, sf).withColumn(
        "user_id", F.when(F.col("event_type").isin("view", "click"), F.lit(-1)).otherwise(F.col("user_id")))
    return H.scd2(changes, ["user_id"], ["ts", "event_id"])


@query
def scd2_hot_time(spark: SparkSession, sf: str) -> DataFrame:
    """Most changes are of one key and one instant; ranges of the whole order cut both."""
    changes = A.customer_changes(spark, sf).withColumn(
        "user_id", F.when(F.col("event_type").isin("view", "click"), F.lit(-1)).otherwise(F.col("user_id"))).withColumn(
        "ts", F.when(F.col("event_type") == "view", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    return H.scd2(changes, ["user_id"], ["ts", "event_id"], ranged=True)


@query
def scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """State in buckets of the user, and two batches that interleave with it in time, the last one delivered twice."""
    changes, keys, order = A.customer_changes(spark, sf), ["user_id"], ["ts", "event_id"]
    first = H.scd2_state(changes.filter("event_id % 3 = 0"), keys, order)
    kept = Buckets(scratch_path(spark, "user_history"), tuple(keys), 8, first.schema)
    kept.create(first)
    for part in (1, 2, 2):
        kept.apply(changes.filter(f"event_id % 3 = {part}"), lambda state, batch: H.scd2_spliced(state, batch, keys, order))
    return H.live(kept.state(spark), "event_type = 'error'")


@query
def scd1_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Last write wins, the state in buckets; the second batch touches the users of a few buckets only."""
    changes, keys, order = A.customer_changes(spark, sf), ["user_id"], ["ts", "event_id"]
    late = F.col("user_id") % 50 == 0
    first = H.latest(changes.filter(~late | (F.col("event_id") % 2 == 0)), keys, order)
    kept = Buckets(scratch_path(spark, "user_latest"), tuple(keys), 16, first.schema)
    kept.create(first)
    kept.apply(changes.filter(late & (F.col("event_id") % 2 == 1)), lambda state, batch: H.scd1_state(state, batch, keys, order))
    return H.live(kept.state(spark), "event_type = 'error'")


@query
def scd2_active(spark: SparkSession, sf: str) -> DataFrame:
    return H.active(scd2_events(spark, sf))


@query
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return H.snapshot_diff(A.orders_before(spark, sf), A.orders_after(spark, sf), ["o_orderkey"])


@query
def snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    return H.snapshot_delta(A.orders_before(spark, sf), A.orders_after(spark, sf), ["o_orderkey"])


@query
def snapshot_apply(spark: SparkSession, sf: str) -> DataFrame:
    """The last of three snapshots, read from the first one and two stored deltas."""
    snapshots = [A.orders_before(spark, sf), A.orders_between(spark, sf), A.orders_after(spark, sf)]
    path = scratch_path(spark, "order_deltas")
    for version, (old, new) in enumerate(zip(snapshots, snapshots[1:], strict=False), start=1):
        H.snapshot_delta(old, new, ["o_orderkey"]).withColumn("version", F.lit(version)).write.mode("append").parquet(path)
    return H.merged(snapshots[0], spark.read.parquet(path), ["o_orderkey"], "version")


@query
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot in the middle, though a later delta is known."""
    snapshots = [A.orders_before(spark, sf), A.orders_between(spark, sf), A.orders_after(spark, sf)]
    deltas = [H.snapshot_delta(old, new, ["o_orderkey"]).withColumn("version", F.lit(version))
              for version, (old, new) in enumerate(zip(snapshots, snapshots[1:], strict=False), start=1)]
    return H.merged(snapshots[0], deltas[0].unionByName(deltas[1]), ["o_orderkey"], "version", upto=1)


@query
def cdc_quality_split(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that break a rule are diverted before the latest state is taken."""
    clean = R.split(A.customer_changes(spark, sf), EVENT_RULES).silver
    return H.scd1(clean, ["user_id"], ["ts", "event_id"])


def _evolved(spark: SparkSession, sf: str) -> list[DataFrame]:
    orders = A.table(spark, sf, "orders")
    return [
        orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus"),
        orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderpriority", "o_orderstatus"),
    ]


@query
def additive_schema(spark: SparkSession, sf: str) -> DataFrame:
    return H.stacked(_evolved(spark, sf), "addNewColumns")


@query
def fixed_schema(spark: SparkSession, sf: str) -> DataFrame:
    return H.stacked(_evolved(spark, sf), "none")


@query
def merged_schema_read(spark: SparkSession, sf: str) -> DataFrame:
    """A folder whose files were written under three schemas: a column added, then types widened."""
    orders, path = A.table(spark, sf, "orders"), scratch_path(spark, "orders_versions")
    narrow = ["cast(o_orderkey AS int) AS o_orderkey", "cast(o_custkey AS int) AS o_custkey",
              "cast(o_totalprice AS decimal(10,2)) AS price", "cast(o_orderdate AS date) AS ordered"]
    versions = [
        narrow, [*narrow, "o_orderpriority"],
        ["o_orderkey", "o_custkey + 0.5D AS o_custkey", "cast(o_totalprice AS decimal(14,4)) AS price", "o_orderdate AS ordered", "o_orderpriority"],
    ]
    for k, columns in enumerate(versions):
        orders.filter(f"o_orderkey % 3 = {k}").selectExpr(*columns).write.parquet(f"{path}/version={k}")
    return merged_read(spark, [f"{path}/version={k}" for k in range(3)])


@query
def orphan_orders(spark: SparkSession, sf: str) -> DataFrame:
    customers = R.split(_customers(spark, sf), P.CUSTOMER_RULES).silver
    orders = R.split(_orders(spark, sf), P.ORDER_RULES).silver
    return C.orphan_keys(orders, customers, ["customer_id"]).withColumnRenamed("_rows", "order_rows")


@query
def column_rename_window(spark: SparkSession, sf: str) -> DataFrame:
    return H.with_new_names(_summary(spark, sf), {"total_amount": "order_value", "region": "sales_region"})


# --- streams -----------------------------------------------------------------------------------


@query
def stream_orders_medallion(spark: SparkSession, sf: str) -> DataFrame:
    """The orders table as a stream, routed, and both sides read back."""
    source = A.table(spark, sf, "orders").schema
    layout = flow.Layout(scratch_path(spark, "orders_medallion"))
    flow.finish(flow.refine(
        spark, layout, source, lambda df: P.orders_silver(A.orders_lineage(A.orders_columns(df))),
        P.ORDER_RULES, source=f"{sf}/orders.parquet*",  # the glob takes a file as well as a folder
    ))
    sides = flow.tables(spark, layout)
    return sides.silver.withColumn("destination", F.lit(R.SILVER)).unionByName(
        sides.rejected.withColumn("destination", F.lit(R.REJECTED)), allowMissingColumns=True
    )


def _orders_as_csv(spark: SparkSession, sf: str) -> str:
    landing = scratch_path(spark, "orders_landing")
    A.orders_columns(A.table(spark, sf, "orders")).write.csv(
        landing, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return landing


def _landed(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("order_date", F.col("order_date").cast("timestamp_ntz")).withColumn(
        "_source_file", F.regexp_extract("_source_file", "(orders_landing)-", 1))


@query
def stream_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV landing files, then streamed into bronze."""
    layout = flow.Layout(scratch_path(spark, "orders_bronze"))
    flow.land(spark, _orders_as_csv(spark, sf), P.ORDERS_LANDING, layout, as_of=AS_OF).awaitTermination()
    return _landed(spark.read.parquet(layout.bronze))


@query
def batch_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    raw = read_csv(spark, _orders_as_csv(spark, sf), P.ORDERS_LANDING, strict_header=True)
    return _landed(to_bronze(raw, P.ORDERS_LANDING, AS_OF))


@query
def landing_path_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV files where the product's landing path puts them."""
    path = landing_path(scratch_path(spark, "landing"), "shop", "dev", "orders")
    A.orders_columns(A.table(spark, sf, "orders")).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    bronze = to_bronze(read_csv(spark, path, P.ORDERS_LANDING), P.ORDERS_LANDING, AS_OF)
    return bronze.withColumn("order_date", F.col("order_date").cast("timestamp_ntz")).withColumn(
        "_source_file", F.regexp_extract("_source_file", "/(shop/dev/orders_raw)/", 1))


def _deliveries(spark: SparkSession, sf: str, layout: flow.Layout) -> Iterator[int]:
    """Orders as two deliveries of landing files, the second in between the days of the first; each is landed and refined."""
    landing = scratch_path(spark, "orders_deliveries")
    for part in (0, 1):
        A.orders_columns(A.table(spark, sf, "orders").filter(f"o_orderkey % 2 = {part}")).write.mode("append").csv(
            landing, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        flow.finish(flow.land(spark, landing, P.ORDERS_LANDING, layout, as_of=AS_OF))
        flow.finish(flow.refine(spark, layout, flow.bronze_schema(P.ORDERS_LANDING), P.orders_silver, P.ORDER_RULES, stamp=part + 1))
        yield part + 1


@query
def stream_two_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries and two runs: what each run added, by its stamp, on both sides."""
    layout = flow.Layout(scratch_path(spark, "orders_two"))
    for _ in _deliveries(spark, sf, layout):
        pass
    found = []
    for stamp in (1, 2):
        sides = flow.tables(spark, layout, stamps=(stamp - 1, stamp))
        found += [side.select("order_id", "customer_id", "amount", F.lit(stamp).alias("delivery"), F.lit(name).alias("destination"))
                  for side, name in zip(sides, (R.SILVER, R.REJECTED), strict=True)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query
def event_log_from_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Rule counts of the rows that streams committed, logged as updates and read back: the newest update's results."""
    layout, rows = flow.Layout(scratch_path(spark, "orders_counted")), None
    for stamp in _deliveries(spark, sf, layout):
        sides = flow.tables(spark, layout, stamps=(stamp - 1, stamp))
        committed = sides.silver.unionByName(sides.rejected.select(sides.silver.columns))
        counts = committed.agg(F.count(F.lit(1)).alias("rows"), *R.violation_counts(P.ORDER_RULES)).first().asDict()
        at = datetime(2001, 8, stamp)
        events = E.update_events(spark, "orders_pipeline", f"u{stamp}", "orders_silver", P.ORDER_RULES, [counts], at)
        rows = events if rows is None else rows.unionByName(events)
    return E.expectation_checks(rows, "r7", AS_OF)


@query
def summary_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A whole product in two runs, then rebuilt in a new generation of its root, which is spelled in another way."""
    customers, orders, root = (scratch_path(spark, n) for n in ("customers_landing", "orders_landing", "product"))
    A.customers_columns(spark, sf).write.csv(customers, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    with _catalog_schema(spark) as schema:
        product = daily.Product({"customers": customers, "orders": orders}, root, schema, freshness_hours=24 * 3650)
        again = daily.Product(product.sources, f"{root}//", schema, freshness_hours=24 * 3650)
        for part, (given, refresh) in enumerate(((product, False), (again, False), (product, True))):
            if part < 2:
                A.orders_columns(A.table(spark, sf, "orders").filter(f"o_orderkey % 2 = {part}")).write.mode("append").csv(
                    orders, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            daily.run_product(spark, given, str(part), now=datetime(2001, 8, 1, 18), full_refresh=refresh)
        summary = spark.read.table(T.qualified(schema, "customer_order_summary"))
        return materialised(summary.withColumn("last_order_date", F.col("last_order_date").cast("timestamp_ntz")), "summary")
