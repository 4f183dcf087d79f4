"""The run of the product, step by step: refine, audit, gate, summarise, audit, report.

The steps are plain functions that an outside scheduler can call one by one;
run_product calls them in order. Check rows are logged before a gate raises, and the outcome is logged
whatever happened, so a failed run is on record.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayworks.functions.clock import Moment, days_before, moment
from assayworks.operators import checks as C
from assayworks.operators.contract import Contract
from assayworks.operators.eventlog import expectation_checks, unreadable_checks, update_events
from assayworks.operators.routing import REJECTED, ROUTE, SILVER, STAMP, Split, route, violation_counts
from assayworks.operators.rules import Mode, Rule
from assayworks.operators.status import run_outcomes
from assayworks.plans import customer_orders as P
from assayworks.sources import state
from assayworks.sources.buckets import Buckets
from assayworks.sources.landing import BatchLimit
from assayworks.sources.tables import (
    DAY,
    append_log,
    define_views,
    ensure_logs,
    publish,
    published,
    qualified,
    status_views,
)
from assayworks.streaming import flow

# Pipeline and table names, and the states of finished tasks.
GOLD_PIPELINE = "gold_pipeline"
SUMMARY = "customer_order_summary"
CUSTOMERS, ORDERS = "customers", "orders"
SUCCEEDED, FAILED = "SUCCESS", "FAILED"
RUN_TYPE = ("job_run_id string, recorded_at timestamp, catalog_name string, schema_name string, "
            "bundle_target string, git_sha string, started_at timestamp, job_run_url string")
TASK_TYPE = "job_run_id string, ord int, task_key string, result_state string, state_message string"


@dataclass(frozen=True)
class Domain:
    """One source domain: what lands, how it becomes silver, and what must hold."""

    name: str
    declared: StructType
    transform: Callable[[DataFrame], DataFrame]
    rules: tuple[Rule, ...]
    contract: Contract

    @property
    def pipeline(self) -> str:
        return f"{self.name}_pipeline"


DOMAINS = (
    Domain(CUSTOMERS, P.CUSTOMERS_LANDING, P.customers_silver, P.CUSTOMER_RULES, P.CUSTOMERS_CONTRACT),
    Domain(ORDERS, P.ORDERS_LANDING, P.orders_silver, P.ORDER_RULES, P.ORDERS_CONTRACT),
)


# --- steps -------------------------------------------------------------------------------------


def silver_results(contract: Contract, silver: DataFrame, bronze: DataFrame, rejected: DataFrame, *,
                   run_id: str, pipeline: str, freshness_hours: float, as_of: Moment = None,
                   rejection_limit: float = P.REJECTION_LIMIT, name: str | None = None) -> DataFrame:
    """Not-empty, freshness and rejection-ratio rows of one domain; ``name`` is the table's full name, told in the rows."""
    table = name or contract.table
    found = [
        C.not_empty(table),
        C.freshness(P.INGESTED_AT, freshness_hours),
        C.rejection_ratio(bronze, rejected, rejection_limit),
    ]
    return C.run(silver, found, run_id=run_id, pipeline=pipeline, table=table, as_of=as_of)


def summary_results(summary: DataFrame, *, run_id: str, as_of: Moment = None, name: str | None = None,
                    parquet: str | None = None) -> DataFrame:
    """The contract checks of the summary table; ``name`` is its full name, told in the rows.

    ``parquet`` is the folder of the version that ``summary`` reads; then its footers answer what they can.
    """
    contract = replace(P.SUMMARY_CONTRACT, table=name or P.SUMMARY_CONTRACT.table)
    return C.run(summary, contract.checks(summary), run_id=run_id, pipeline=GOLD_PIPELINE,
                 table=contract.table, as_of=as_of, parquet=parquet)


def log_and_gate(results: DataFrame, schema: str, run_id: str, contract_log: bool = False,
                 inform: Callable[[], None] | None = None) -> None:
    """Appends check rows to the logs, then raises if a direct check among this run's rows failed or none is there.

    The gate reads the rows back from the log, from the days that the written rows have. ``inform`` runs
    between log and gate; it can add rows, but what goes wrong in it must not keep the gate from deciding.
    """
    results = results.persist()  # as many rows as there are checks
    append_log(results, schema, "ops_pipeline_run_log")
    if contract_log:
        append_log(results, schema, "ops_contract_check_log")
    day = F.col("checked_at").cast("date")
    first, last = results.agg(F.min(day), F.max(day)).first()
    results.unpersist()
    if inform is not None:
        inform()
    logged = results.sparkSession.read.table(qualified(schema, "ops_pipeline_run_log"))
    written = logged.filter(F.col(DAY).between(first, last) & (F.col("run_id") == run_id))
    direct = written.filter(F.col("check_type") == C.DIRECT)
    if direct.isEmpty():
        raise C.CheckFailed(f"no direct check of run {run_id} is in the log")
    C.gate(direct)


def refresh_summary(customers: DataFrame, orders: DataFrame, root: str, view: str | None = None) -> str:
    """Recomputes the summary from the given silver versions and swaps it in."""
    return publish(P.customer_order_summary(customers, orders), root, view)


def finalize(spark: SparkSession, schema: str, runs: DataFrame, tasks: DataFrame,
             since: datetime | None = None) -> None:
    """Logs the outcome of finished runs and redefines the serving views.

    ``since``, the earliest start of the runs, limits the days of the check log that are read.
    """
    checks = spark.read.table(qualified(schema, "ops_pipeline_run_log"))
    if since is not None:
        checks = checks.filter(F.col(DAY) >= days_before(since, 1))
    append_log(run_outcomes(runs, tasks, checks), schema, "ops_job_run_log")
    define_views(spark, schema, status_views(schema))


# --- the whole run -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Product:
    """Where the product lives: landing folders by domain, table folders, catalog schema of logs and views."""

    sources: dict[str, str]
    root: str
    schema: str
    mode: Mode = "drop"
    freshness_hours: float = 168
    catalog: str = "spark_catalog"
    target: str = "dev"
    batch: BatchLimit | None = None
    #: Buckets of the order totals; never changed for a root that has some. About one per 100 MB of totals.
    buckets: int = 16

    def layout(self, domain: Domain) -> flow.Layout:
        return flow.Layout(f"{self.root}/{domain.name}")

    def named(self, table: str) -> str:
        """A table's full name, as check rows tell it."""
        return f"{self.catalog}.{self.schema}.{table}"

    def totals(self) -> Buckets:
        return P.order_buckets(f"{self.root}/order_totals", self.buckets)

    def event_log(self, domain: Domain) -> str:
        """One folder per domain: the domains append at the same time, and Spark jobs must not share a target."""
        return f"{self.root}/event_log/{domain.name}"


def refresh_domain(spark: SparkSession, product: Product, domain: Domain, update: str, at: datetime) -> None:
    """New files to bronze to silver and rejected; rule counts go to the event log."""
    layout, batch = product.layout(domain), product.batch
    stamp = state.next_batch(spark, layout.root)  # before any row can carry it
    flow.finish(flow.land(spark, product.sources[domain.name], domain.declared, layout, as_of=at, batch=batch))
    try:
        flow.finish(flow.refine(
            spark, layout, flow.bronze_schema(domain.declared), domain.transform, domain.rules, mode=product.mode,
            batch=batch, stamp=stamp))
    finally:  # also what a failed stream has committed
        counts = stamp_counts(spark, product, domain, stamp)
        events = update_events(spark, domain.pipeline, update, f"{domain.name}_silver", domain.rules, counts, at)
        events.write.mode("append").parquet(product.event_log(domain))
        publish_domain(spark, product, domain)


def publish_domain(spark: SparkSession, product: Product, domain: Domain) -> None:
    """Gives bronze, silver and rejected their names in the catalog: <domain>_bronze and so on."""
    layout, (bronze, sides) = product.layout(domain), domain_tables(spark, product, domain)
    define_views(spark, product.schema, {
        f"{domain.name}_bronze": published(bronze, layout.bronze),
        f"{domain.name}_silver": published(sides.silver, layout.routed, f"{ROUTE} = '{SILVER}'"),
        f"{domain.name}_rejected": published(sides.rejected, layout.routed, f"{ROUTE} = '{REJECTED}'"),
    })


def stamp_counts(spark: SparkSession, product: Product, domain: Domain, stamp: int) -> list[dict[str, int]]:
    """Rows and violations per rule of the rows that carry a stamp, counted in the tables themselves."""
    sides = domain_tables(spark, product, domain, (stamp - 1, stamp))[1]
    rows = sides.silver.unionByName(sides.rejected.select(sides.silver.columns))
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), *violation_counts(domain.rules)).first().asDict()
    return [counts] if counts["rows"] else []


def routed_schema(spark: SparkSession, product: Product, domain: Domain) -> StructType:
    bronze = spark.createDataFrame([], flow.bronze_schema(domain.declared))
    return route(domain.transform(bronze), domain.rules, product.mode).schema.add(STAMP, "long")


def domain_tables(spark: SparkSession, product: Product, domain: Domain,
                  stamps: tuple[int, int] | None = None) -> tuple[DataFrame, Split]:
    """Bronze, and silver and rejected; with ``stamps``, what batches after the first up to the second number added."""
    bronze = spark.read.schema(flow.bronze_schema(domain.declared)).parquet(product.layout(domain).bronze)
    return bronze, flow.tables(spark, product.layout(domain), routed_schema(spark, product, domain), stamps)


def update_totals(spark: SparkSession, product: Product) -> DataFrame:
    """Brings the order totals up to the newest batch of orders and returns them.

    Silver only grows and the measures add up, so history is not read again: batches between two marks are a
    range of partitions, and only buckets of customers with new orders are written. An attempt is marked before it begins. One
    that died is taken up again with the same batches first, and skips the buckets it had come to; so each order counts once.
    """
    orders, totals = DOMAINS[1], product.totals()
    root = product.layout(orders).root
    newest = state.greatest(spark, root, state.BATCHES)
    routed = flow.routed_table(spark, product.layout(orders), routed_schema(spark, product, orders))
    held = routed.agg(F.max(STAMP)).first()[0] or 0
    if held > newest:
        raise RuntimeError(f"silver orders of batch {held} are known to no state under {root}")
    if not state.exists(spark, totals.path):
        totals.create(spark.createDataFrame([], totals.schema))
    applied = state.greatest(spark, root, state.APPLIED)
    for upto in sorted({n for n in (*state.marks(spark, root, state.ATTEMPTS), newest) if n > applied}):
        state.put_mark(spark, root, state.ATTEMPTS, upto)
        totals.apply(domain_tables(spark, product, orders, (applied, upto))[1].silver, P.totals_with, mark=upto)
        state.put_mark(spark, root, state.APPLIED, upto)
        applied = upto
    return totals.state(spark)


def update_summary(spark: SparkSession, product: Product, view: str) -> str:
    """Refreshes the summary from all customers and the order totals, and swaps it in; returns the folder of the new version."""
    customers = domain_tables(spark, product, DOMAINS[0])[1].silver
    return publish(P.summary_of_totals(customers, update_totals(spark, product)), f"{product.root}/{SUMMARY}", view)


def readiness(spark: SparkSession, product: Product, run_id: str, as_of: Moment = None) -> DataFrame:
    """Direct checks of both domains."""
    found = []
    for domain in DOMAINS:
        bronze, sides = domain_tables(spark, product, domain)
        found.append(C.to_run_log(silver_results(
            domain.contract, sides.silver, bronze, sides.rejected, run_id=run_id, pipeline=domain.pipeline,
            freshness_hours=product.freshness_hours, as_of=as_of, name=product.named(f"{domain.name}_silver"))))
    return reduce(DataFrame.unionByName, found)


def log_expectations(spark: SparkSession, product: Product, run_id: str, as_of: Moment = None) -> None:
    """Logs the expectation results of the latest updates, or one warning per pipeline if Spark cannot read them."""
    pipelines = [d.pipeline for d in DOMAINS]
    try:
        events = spark.read.parquet(*[product.event_log(d) for d in DOMAINS])
        append_log(expectation_checks(events, run_id, as_of, pipelines), product.schema, "ops_pipeline_run_log")
    except (CapturedException, Py4JJavaError) as error:  # what the JVM raised; errors of our own code go on
        append_log(unreadable_checks(spark, run_id, pipelines, error, as_of), product.schema, "ops_pipeline_run_log")


def run_product(spark: SparkSession, product: Product, job_run_id: str, *, git_sha: str | None = None,
                job_run_url: str | None = None, now: datetime | None = None, full_refresh: bool = False) -> None:
    """One complete run. Raises the first error after the outcome has been logged.

    Both domains run side by side; each later step needs the ones before it.
    ``now`` fixes the run's clock; by default it is the time of each step. ``full_refresh`` begins a new generation of tables,
    checkpoints and state under the root, reads all landing files again, and later runs go on from there.
    """
    begin = state.new_generation if full_refresh else state.active_root
    product = replace(product, root=begin(spark, product.root))
    at = now or datetime.now(timezone.utc)
    as_of = None if now is None else moment(now)
    ensure_logs(spark, product.schema)
    view = qualified(product.schema, SUMMARY)
    done: list[tuple[str, int, str, str, str | None]] = []
    errors: list[Exception] = []
    versions: list[str] = []

    def attempt(order: int, key: str, action: Callable[[], None]) -> None:
        try:
            action()
            done.append((job_run_id, order, key, SUCCEEDED, None))
        except Exception as error:  # recorded as the task's outcome and raised at the end
            errors.append(error)
            done.append((job_run_id, order, key, FAILED, str(error)))

    def check_silver() -> None:
        run_id = f"{job_run_id}-silver"
        log_and_gate(readiness(spark, product, run_id, as_of), product.schema, run_id,
                     inform=lambda: log_expectations(spark, product, run_id, as_of))

    def build_summary() -> None:
        versions.append(update_summary(spark, product, view))

    def check_summary() -> None:
        run_id = f"{job_run_id}-gold"
        results = summary_results(spark.read.table(view), run_id=run_id, as_of=as_of, name=product.named(SUMMARY), parquet=versions[-1])
        log_and_gate(results, product.schema, run_id, contract_log=True)

    with ThreadPoolExecutor(len(DOMAINS)) as pool:
        for order, domain in enumerate(DOMAINS):
            pool.submit(attempt, order, f"run_{domain.name}",
                        lambda d=domain: refresh_domain(spark, product, d, job_run_id, at))
    for order, (key, action) in enumerate((
        ("validate_silver_readiness", check_silver), ("run_gold", build_summary),
        ("validate_gold_contract", check_summary),
    ), start=len(DOMAINS)):
        if not errors:
            attempt(order, key, action)

    recorded = now or datetime.now(timezone.utc)
    runs = spark.createDataFrame(
        [(job_run_id, recorded, product.catalog, product.schema, product.target, git_sha, at, job_run_url)], RUN_TYPE)
    finalize(spark, product.schema, runs, spark.createDataFrame(done, TASK_TYPE), since=at)
    if errors:
        raise errors[0]
