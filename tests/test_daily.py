"""Landing files to status views, in batch and as streams, on a small sample of odd rows."""

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayworks.operators import checks as C
from assayworks.operators import eventlog as E
from assayworks.operators import routing as R
from assayworks.operators import status as S
from assayworks.plans import customer_orders as P
from assayworks.plans import daily
from assayworks.sources import landing, scratch, state, tables
from assayworks.streaming import flow
from tests.shapes import CHECKS, NOON, RUNS, TASKS

CUSTOMER_CSV = """customer_id,name,email,country_code,phone
p01,ola berg,ola@shop.example,NO,+4711
p02,  eva lind  ,EVA@SHOP.EXAMPLE,SE,+4612
p03,sam gray,sam@shop.example,GB,
p04,lee park,lee@shop.example,KR,+8213
p05,kim roy,kim@shop.example,CA,+1214
p06,bad mail,nowhere,NO,+4715
p07,half mail,half@,DE,+4916
"""
ORDER_CSV = """order_id,customer_id,amount,order_date,status
q01,p01,10.25,2026-01-02 08:00:00,paid
q02,p01,20.50,2026-03-02 08:00:00, pending
q03,p02,5.00,2026-02-02 08:00:00,paid
q04,p03,7.00,2026-02-03 08:00:00,
q05,p05,-4.00,2026-02-04 08:00:00,error
q06,p06,9.00,2026-02-05 08:00:00,paid
q07,p02,oops,2026-02-06 08:00:00,paid
q08,p02,1.239,not a date,paid
q09,p04,99999999999.00,2026-02-07 08:00:00,paid
"""


def land(folder, name, text):
    path = f"{folder}/{name}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part{len(os.listdir(path))}.csv", "w") as out:
        out.write(text)
    return path


def content(df, *without):
    kept = [c for c in sorted(df.columns) if c not in without]
    return sorted(map(str, df.select(*kept).collect()))


def test_batch_from_files_to_summary(spark, folder):
    raw = landing.read_csv(spark, land(folder, "c", CUSTOMER_CSV), P.CUSTOMERS_LANDING)
    customers = R.split(P.customers_silver(landing.to_bronze(raw, P.CUSTOMERS_LANDING, NOON)), P.CUSTOMER_RULES)
    raw = landing.read_csv(spark, land(folder, "o", ORDER_CSV), P.ORDERS_LANDING)
    bronze = landing.to_bronze(raw, P.ORDERS_LANDING, NOON)
    orders = R.split(P.orders_silver(bronze), P.ORDER_RULES)
    counts = {"customers": customers.silver, "bad_customers": customers.rejected, "orders": orders.silver,
              "bad_orders": orders.rejected, "bronze": bronze}
    expected = {"customers": 5, "bad_customers": 2, "orders": 8, "bad_orders": 1, "bronze": 9}
    assert all(r.status == "PASS" for r in C.reconcile(counts, expected).collect())
    assert bronze.select("_source_file").distinct().first()[0].endswith("/o/part0.csv")
    rows = {r.customer_id: (r.name_std, r.region, r.order_count, r.total_amount, r.last_order_date)
            for r in P.customer_order_summary(customers.silver, orders.silver).collect()}
    assert rows == {
        "p01": ("Ola Berg", "Europe", 2, Decimal("30.75"), datetime(2026, 3, 2, 8)),
        "p02": ("Eva Lind", "Europe", 3, Decimal("6.24"), datetime(2026, 2, 6, 8)),
        "p03": ("Sam Gray", "Europe", 1, Decimal("7.00"), datetime(2026, 2, 3, 8)),
        "p04": ("Lee Park", "Unknown", 1, None, datetime(2026, 2, 7, 8)),
        "p05": ("Kim Roy", "North America", 0, None, None),
    }


def test_reader_options(spark, folder):
    path = land(folder, "c", CUSTOMER_CSV.replace("customer_id,name,", "name,customer_id,"))
    assert landing.read_csv(spark, path, P.CUSTOMERS_LANDING).first().customer_id == "p01"
    with pytest.raises(Exception, match="does not conform|header"):
        landing.read_csv(spark, path, P.CUSTOMERS_LANDING, strict_header=True).collect()
    kept = landing.read_csv(spark, land(folder, "o", ORDER_CSV), P.ORDERS_LANDING, corrupt_column="_corrupt_record")
    bronze = landing.to_bronze(kept, P.ORDERS_LANDING, NOON, "_corrupt_record").persist()
    bad = [r._corrupt_record for r in bronze.filter("_corrupt_record IS NOT NULL").collect()]
    assert [b[:3] for b in bad] == ["q07", "q08"] or [b[:3] for b in bad] == ["q07", "q08", "q09"]
    assert landing.landing_path("/lake/", "shop", "dev", "orders") == "/lake/shop/dev/orders_raw/"


def start(spark, folder, mode="drop", name="orders"):
    layout = flow.Layout(f"{folder}/{name}_tables")
    flow.finish(flow.land(spark, f"{folder}/{name}", P.ORDERS_LANDING, layout, as_of=F.lit(NOON)))
    metrics = flow.finish(flow.refine(
        spark, layout, flow.bronze_schema(P.ORDERS_LANDING), P.orders_silver, P.ORDER_RULES, mode=mode))
    return layout, metrics


def test_stream_equals_batch_and_takes_files_once(spark, folder):
    path = land(folder, "orders", ORDER_CSV)
    layout, metrics = start(spark, folder)
    assert [m["rows"] for m in metrics] == [9] and metrics[0]["positive_amount"] == 1
    assert metrics[0]["status_not_null"] == 1

    def batch():
        raw = landing.read_csv(spark, path, P.ORDERS_LANDING)
        return R.split(P.orders_silver(landing.to_bronze(raw, P.ORDERS_LANDING, NOON)), P.ORDER_RULES)

    sides = flow.tables(spark, layout)
    assert content(sides.silver, "_source_file") == content(batch().silver, "_source_file")
    assert content(sides.rejected, "_source_file") == content(batch().rejected, "_source_file")

    log = E.update_events(spark, "orders_pipeline", "u1", "orders_silver", P.ORDER_RULES, metrics, NOON)
    found = {r.check_name: (r.status, r.message) for r in E.expectation_checks(log, "r", NOON).collect()}
    assert found == {
        "order_id_not_null": ("PASS", "flow=orders_silver passed=9 failed=0"),
        "customer_id_not_null": ("PASS", "flow=orders_silver passed=9 failed=0"),
        "positive_amount": ("WARN", "flow=orders_silver passed=8 failed=1"),
        "status_not_null": ("WARN", "flow=orders_silver passed=8 failed=1"),
    }

    start(spark, folder)  # nothing new
    assert spark.read.parquet(layout.bronze).count() == 9
    land(folder, "orders", ORDER_CSV.replace("q0", "r0"))
    start(spark, folder)
    sides = flow.tables(spark, layout)
    assert (spark.read.parquet(layout.bronze).count(), sides.silver.count(), sides.rejected.count()) == (18, 16, 2)
    assert content(sides.silver, "_source_file") == content(batch().silver, "_source_file")

    # A full refresh is a run into new folders over the same landing files.
    fresh = flow.Layout(f"{folder}/fresh")
    flow.finish(flow.land(spark, path, P.ORDERS_LANDING, fresh, as_of=F.lit(NOON), batch=landing.BatchLimit(files=1)))
    flow.finish(flow.refine(spark, fresh, flow.bronze_schema(P.ORDERS_LANDING), P.orders_silver, P.ORDER_RULES,
                            batch=landing.BatchLimit(size=1)))
    assert content(flow.tables(spark, fresh).silver) == content(sides.silver)
    assert len(os.listdir(f"{fresh.checkpoint('routed')}/commits")) > 2  # a batch per file or so, and checksums


def test_fail_mode_commits_nothing_and_can_resume(spark, folder):
    path = land(folder, "orders", ORDER_CSV)
    with pytest.raises(Exception, match="positive_amount"):
        start(spark, folder, mode="fail")
    layout = flow.Layout(f"{folder}/orders_tables")
    schema = R.route(P.orders_silver(spark.read.parquet(layout.bronze)), P.ORDER_RULES).schema
    sides = flow.tables(spark, layout, schema)
    assert (sides.silver.count(), sides.rejected.count()) == (0, 0)
    assert os.path.exists(path) and spark.read.parquet(layout.bronze).count() == 9
    flow.finish(flow.refine(spark, layout, flow.bronze_schema(P.ORDERS_LANDING), P.orders_silver, P.ORDER_RULES))
    sides = flow.tables(spark, layout, schema)
    assert (sides.silver.count(), sides.rejected.count()) == (8, 1)


def test_critical_violation_stops_the_stream(spark, folder):
    land(folder, "orders", ORDER_CSV + ",p01,5.00,2026-02-05 08:00:00,paid\n")
    with pytest.raises(Exception, match="order_id_not_null"):
        start(spark, folder)


def test_routed_write_is_one_job_over_one_scan(spark, folder):
    routed = R.route(P.orders_silver(spark.read.parquet(_orders(spark, folder))), P.ORDER_RULES)
    routed.write.partitionBy(R.ROUTE).parquet(f"{folder}/routed")
    sides = R.routed_split(spark.read.parquet(f"{folder}/routed"))
    plan = sides.silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_route" in plan and "rejection_reason" not in plan.split("ReadSchema")[1]
    assert sides.silver.count() + sides.rejected.count() == 9


def _orders(spark, folder):
    raw = landing.read_csv(spark, land(folder, "raw", ORDER_CSV), P.ORDERS_LANDING)
    landing.to_bronze(raw, P.ORDERS_LANDING, NOON).write.parquet(f"{folder}/bronze")
    return f"{folder}/bronze"


@pytest.fixture
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS shop")
    yield "shop"
    spark.sql("DROP SCHEMA shop CASCADE")


def test_logs_gates_and_views(spark, folder, schema):
    tables.ensure_logs(spark, schema)
    tables.ensure_logs(spark, schema)
    bronze = spark.read.parquet(_orders(spark, folder))
    sides = R.split(P.orders_silver(bronze), P.ORDER_RULES)
    audit = lambda run_id, as_of: daily.silver_results(
        P.ORDERS_CONTRACT, sides.silver, bronze, sides.rejected, run_id=run_id, pipeline="orders_pipeline",
        freshness_hours=168, as_of=as_of)
    daily.log_and_gate(audit("1", NOON), schema, "1")
    with pytest.raises(C.CheckFailed, match="silver_freshness"):
        daily.log_and_gate(audit("2", NOON + timedelta(days=9)), schema, "2")
    assert spark.table("shop.ops_pipeline_run_log").groupBy("run_id").count().count() == 2  # also the failed run
    daily.log_and_gate(audit("3", NOON), schema, "3")  # an older failure does not block a newer run

    customers = P.customers_silver(landing.to_bronze(
        landing.read_csv(spark, land(folder, "c", CUSTOMER_CSV), P.CUSTOMERS_LANDING), P.CUSTOMERS_LANDING, NOON))
    path = daily.refresh_summary(customers, sides.silver, f"{folder}/summary", "shop.customer_order_summary")
    before = spark.table("shop.customer_order_summary")
    assert before.count() == 7
    daily.log_and_gate(daily.summary_results(before, run_id="4", as_of=NOON), schema, "4", contract_log=True)
    assert spark.table("shop.ops_contract_check_log").count() == 4
    other = daily.refresh_summary(customers.limit(2), sides.silver, f"{folder}/summary", "shop.customer_order_summary")
    assert other != path and spark.table("shop.customer_order_summary").count() == 2
    assert spark.read.parquet(path).count() == 7  # readers of the old version are not disturbed

    runs = spark.createDataFrame(
        [(str(i), NOON + timedelta(hours=i), "c", "shop", "dev", None, NOON, "u") for i in range(3)], RUNS)
    tasks = spark.createDataFrame([("0", 0, "a", "SUCCESS", None), ("1", 0, "a", "FAILED", "m"), ("2", 0, "a", "SUCCESS", "")], TASKS)
    daily.finalize(spark, schema, runs, tasks)
    board = spark.table("shop.ops_current_status_v").collect()
    expected = S.current_status(spark.table("shop.ops_run_history_v")).collect()
    assert [r.dashboard_status for r in board] == [r.dashboard_status for r in expected]
    assert board[0].job_run_id == "2" and len(board) == 1
    assert spark.table("shop.ops_run_history_v").count() == 3
    assert spark.table("shop.ops_pipeline_run_history_v").columns == list(C.RUN_LOG_COLUMNS)
    assert spark.table("shop.ops_contract_check_history_v").columns == list(C.CONTRACT_LOG_COLUMNS)


def product(folder, **options):
    return daily.Product({"customers": f"{folder}/customers", "orders": f"{folder}/orders"}, f"{folder}/tables", "shop", **options)


def job_rows(spark):
    return {r.job_run_id: (r.overall_status, r.failed_task_key) for r in spark.table("shop.ops_run_history_v").collect()}


def test_whole_runs(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", git_sha="abc", now=NOON)
    assert job_rows(spark) == {"1": ("SUCCESS", None)}
    first = {r.customer_id: r.order_count for r in spark.table("shop.customer_order_summary").collect()}
    assert first == {"p01": 2, "p02": 3, "p03": 1, "p04": 1, "p05": 0}
    log = spark.table("shop.ops_pipeline_run_history_v")
    kinds = {(r.pipeline_name, r.check_type): r["count"] for r in log.groupBy("pipeline_name", "check_type").count().collect()}
    assert kinds == {("customers_pipeline", "direct"): 3, ("orders_pipeline", "direct"): 3, ("gold_pipeline", "direct"): 4,
                     ("customers_pipeline", "expectation"): 3, ("orders_pipeline", "expectation"): 4}
    assert spark.table("shop.ops_contract_check_history_v").filter("status = 'PASS'").count() == 4

    land(folder, "orders", ORDER_CSV.replace("q0", "r0"))  # only the new file is taken
    daily.run_product(spark, product(folder), "2", now=NOON + timedelta(hours=1))
    second = {r.customer_id: r.order_count for r in spark.table("shop.customer_order_summary").collect()}
    assert second == {k: 2 * n for k, n in first.items()}

    full = {d.name: daily.domain_tables(spark, product(folder), d)[1].silver for d in daily.DOMAINS}
    again = P.customer_order_summary(full["customers"], full["orders"])
    assert content(spark.table("shop.customer_order_summary")) == content(again)
    assert spark.table("shop.customer_order_summary").dtypes == again.dtypes
    root = f"{folder}/tables/orders"
    assert state.marks(spark, root, state.APPLIED) == state.marks(spark, root, state.BATCHES) == [2]

    # A gate stops the run before the summary is rebuilt, and the run is on record.
    with pytest.raises(C.CheckFailed, match="silver_freshness"):
        daily.run_product(spark, product(folder), "3", now=NOON + timedelta(days=20))
    assert job_rows(spark) == {"1": ("SUCCESS", None), "2": ("SUCCESS", None), "3": ("FAILED", "validate_silver_readiness")}
    board = spark.table("shop.ops_current_status_v").first()
    assert (board.job_run_id, board.dashboard_status) == ("3", "FAILED")
    assert "silver_freshness" in board.failure_message

    # The orders of a failed run are taken in by the next, and a run without new files changes nothing.
    land(folder, "orders", ORDER_CSV.replace("q0", "t0"))
    assert (state.marks(spark, root, state.APPLIED), state.marks(spark, root, state.BATCHES)) == ([2], [3])
    for attempt in ("4", "5"):
        daily.run_product(spark, product(folder), attempt, now=NOON + timedelta(hours=3))
        third = {r.customer_id: r.order_count for r in spark.table("shop.customer_order_summary").collect()}
        assert third == {k: 3 * n for k, n in first.items()}
        assert state.marks(spark, root, state.APPLIED) == state.marks(spark, root, state.BATCHES)
    orders = daily.DOMAINS[1]
    added = daily.domain_tables(spark, product(folder), orders, (1, 3))[1].silver
    assert "_stamp" in added._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert [daily.domain_tables(spark, product(folder), orders, (i, i + 1))[1].silver.count() for i in range(5)] == [8, 8, 0, 8, 0]


def test_fail_mode_run_halts_and_is_recorded(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    with pytest.raises(Exception, match="quality rule violated"):
        daily.run_product(spark, product(folder, mode="fail"), "9", now=NOON)
    assert job_rows(spark) == {"9": ("FAILED", "run_customers")}
    assert not spark.catalog.tableExists("shop.customer_order_summary")


@pytest.mark.parametrize("status, hours, shown", [
    ("SUCCESS", 1, "HEALTHY"), ("SUCCESS", 49, "STALE"), ("FAILED", 99, "FAILED"), ("WARNING", 99, "WARNING"),
    ("UNKNOWN", 1, "UNKNOWN"), (None, 1, "UNKNOWN")])
def test_status_view(spark, schema, status, hours, shown):
    tables.ensure_logs(spark, schema)
    row = spark.range(1).selectExpr(
        "'1' AS job_run_id", "current_timestamp() AS recorded_at", "'c' AS catalog_name", "'s' AS schema_name",
        "'d' AS bundle_target", "'g' AS git_sha", f"{'NULL' if status is None else repr(status)} AS overall_status",
        "CAST(NULL AS STRING) AS failed_task_key", "CAST(NULL AS STRING) AS failure_message",
        "current_timestamp() AS started_at", f"current_timestamp() - INTERVAL {hours} HOURS AS completed_at",
        "1L AS duration_seconds", "'u' AS job_run_url")
    tables.append_log(row, schema, "ops_job_run_log")
    tables.define_views(spark, schema, tables.status_views(schema))
    assert [r.dashboard_status for r in spark.table("shop.ops_current_status_v").collect()] == [shown]


def test_log_readers_prune_days(spark, schema):
    tables.ensure_logs(spark, schema)
    rows = [("1", "p", "c", "direct", "PASS", "m", NOON + timedelta(days=d)) for d in range(3)]
    tables.append_log(spark.createDataFrame(rows, CHECKS), schema, "ops_pipeline_run_log")
    day = spark.table("shop.ops_pipeline_run_log").filter("log_day = DATE '2026-05-20'")
    assert day.count() == 1 and "PartitionFilters: [isnotnull(log_day" in day._jdf.queryExecution().executedPlan().toString()


def test_scratch_uses_the_named_folder(spark):
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get(scratch.SETTING)) and scratch.scratch_path(spark, "x") != path


def test_old_versions_can_be_refreshed_from(spark, folder):
    """A summary is recomputed from silver versions that are named explicitly."""
    customers = P.customers_silver(landing.to_bronze(
        landing.read_csv(spark, land(folder, "c", CUSTOMER_CSV), P.CUSTOMERS_LANDING), P.CUSTOMERS_LANDING, NOON))
    orders = P.orders_silver(spark.read.parquet(_orders(spark, folder)))
    first = tables.publish(orders, f"{folder}/silver")
    tables.publish(orders.limit(1), f"{folder}/silver")
    path = daily.refresh_summary(customers, spark.read.parquet(first), f"{folder}/gold")
    assert spark.read.parquet(path).agg(F.sum("order_count")).first()[0] == 9


def test_late_file_with_an_old_time_is_taken(spark, folder):
    path = land(folder, "orders", ORDER_CSV)
    layout, _ = start(spark, folder)
    land(folder, "orders", ORDER_CSV.replace("q0", "z0"))
    old = (NOON - timedelta(days=4000)).timestamp()
    os.utime(f"{path}/part1.csv", (old, old))
    start(spark, folder)
    assert spark.read.parquet(layout.bronze).count() == 18


def test_gate_fails_on_failed_checks_of_any_day(spark, folder, schema):
    tables.ensure_logs(spark, schema)
    rows = [("7", "p", "silver_freshness", "direct", "FAIL", "m", datetime(2001, 8, 1))]
    with pytest.raises(C.CheckFailed, match="silver_freshness"):
        daily.log_and_gate(spark.createDataFrame(rows, CHECKS), schema, "7")
    with pytest.raises(C.CheckFailed, match="no direct check"):
        daily.log_and_gate(spark.createDataFrame(rows, CHECKS), schema, "8")


def test_counts_do_not_depend_on_kept_progress(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    for i in range(5):
        land(folder, "orders", ORDER_CSV.replace("q0", f"q{i}"))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        daily.run_product(spark, product(folder, batch=landing.BatchLimit(files=1)), "1", now=NOON)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    told = {r.message for r in spark.table("shop.ops_pipeline_run_log").filter(
        "pipeline_name = 'orders_pipeline' AND check_type = 'expectation' AND check_name = 'positive_amount'").collect()}
    assert told == {"flow=orders_silver passed=40 failed=5"}


def test_full_refresh_into_a_new_root_does_not_double(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", now=NOON)
    first = content(spark.table("shop.customer_order_summary"))
    fresh = daily.Product({"customers": f"{folder}/customers", "orders": f"{folder}/orders"}, f"{folder}/anew", "shop")
    daily.run_product(spark, fresh, "2", now=NOON)
    assert content(spark.table("shop.customer_order_summary")) == first


def test_unreadable_event_log_warns_and_does_not_block(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    os.makedirs(f"{folder}/tables/event_log/customers")
    with open(f"{folder}/tables/event_log/customers/part-0.parquet", "w") as out:
        out.write("not a table")
    daily.run_product(spark, product(folder), "1", now=NOON)
    assert job_rows(spark) == {"1": ("SUCCESS", None)} and spark.table("shop.customer_order_summary").count() == 5
    log = spark.table("shop.ops_pipeline_run_log").filter("run_id = '1-silver'").groupBy("check_type", "status").count()
    assert {tuple(r) for r in log.collect()} == {("direct", "PASS", 6), ("expectation", "WARN", 2)}


def test_tables_have_names_also_when_empty(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", "\n".join(ORDER_CSV.splitlines()[:3]) + "\n")
    daily.run_product(spark, product(folder), "1", now=NOON)
    counts = {name: spark.table(f"shop.{name}").count() for name in (
        "customers_bronze", "customers_silver", "customers_rejected", "orders_bronze", "orders_silver", "orders_rejected")}
    assert counts == {"customers_bronze": 7, "customers_silver": 5, "customers_rejected": 2, "orders_bronze": 2,
                      "orders_silver": 2, "orders_rejected": 0}
    _, sides = daily.domain_tables(spark, product(folder), daily.DOMAINS[1])
    assert spark.table("shop.orders_rejected").dtypes == sides.rejected.dtypes


@pytest.mark.parametrize("spelled", ["{}/", "file:{}", "file://{}//"])
def test_a_root_has_one_state_however_it_is_spelled(spark, folder, schema, spelled):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", now=NOON)
    land(folder, "orders", ORDER_CSV.replace("q0", "r0"))
    other = daily.Product(product(folder).sources, spelled.format(f"{folder}/tables"), "shop")
    daily.run_product(spark, other, "2", now=NOON)
    counts = {r.customer_id: r.order_count for r in spark.table("shop.customer_order_summary").collect()}
    assert counts == {"p01": 4, "p02": 6, "p03": 2, "p04": 2, "p05": 0}


def test_full_refresh_reads_everything_again(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", now=NOON)
    first = content(spark.table("shop.customer_order_summary"))
    daily.run_product(spark, product(folder), "2", now=NOON, full_refresh=True)
    assert content(spark.table("shop.customer_order_summary")) == first and spark.table("shop.orders_bronze").count() == 9
    land(folder, "orders", ORDER_CSV.replace("q0", "r0"))
    daily.run_product(spark, product(folder), "3", now=NOON)  # goes on in the new generation
    assert spark.table("shop.orders_bronze").count() == 18 and "generation=1" in state.active_root(spark, f"{folder}/tables")
    assert spark.read.parquet(f"{folder}/tables/orders/bronze").count() == 9  # the old one stays for its readers


def test_orders_without_known_state_stop_the_summary(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", now=NOON)
    os.rename(f"{folder}/tables/orders/_state", f"{folder}/tables/orders/_lost")
    with pytest.raises(RuntimeError, match="known to no state"):
        daily.update_totals(spark, product(folder))


def test_a_died_attempt_is_finished_without_counting_twice(spark, folder, schema, monkeypatch):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    daily.run_product(spark, product(folder), "1", now=NOON)
    before = {r.customer_id: r.order_count for r in product(folder).totals().state(spark).collect()}
    land(folder, "orders", ORDER_CSV.replace("q0", "r0"))
    put = state.put_mark

    def dies(spark, root, kind, number):
        if kind == state.APPLIED:
            raise KeyboardInterrupt
        put(spark, root, kind, number)

    monkeypatch.setattr(state, "put_mark", dies)
    with pytest.raises(KeyboardInterrupt):  # the totals are written, but the mark is not
        daily.run_product(spark, product(folder), "2", now=NOON)
    monkeypatch.setattr(state, "put_mark", put)
    land(folder, "orders", ORDER_CSV.replace("q0", "t0"))
    daily.run_product(spark, product(folder), "3", now=NOON)
    after = {r.customer_id: r.order_count for r in product(folder).totals().state(spark).collect()}
    assert after == {k: 3 * n for k, n in before.items()}


def test_views_are_there_also_after_a_failed_refinement(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    with pytest.raises(Exception, match="quality rule violated"):
        daily.run_product(spark, product(folder, mode="fail"), "1", now=NOON)
    assert spark.table("shop.customers_bronze").count() == 7 and spark.table("shop.customers_silver").count() == 0


def test_views_of_the_board_give_what_the_operators_give(spark, folder, schema):
    land(folder, "customers", CUSTOMER_CSV)
    land(folder, "orders", ORDER_CSV)
    now = datetime.now().replace(microsecond=0)
    daily.run_product(spark, product(folder, freshness_hours=9999), "1", now=now - timedelta(days=9))
    daily.run_product(spark, product(folder, freshness_hours=9999), "2", now=now)
    view = lambda name: content(spark.table(f"shop.{name}"))
    checks, contracts, runs = (spark.table(f"shop.{t}") for t in ("ops_pipeline_run_log", "ops_contract_check_log", "ops_job_run_log"))
    assert view("ops_latest_run_checks_v") == content(S.latest_run_checks(checks, day="log_day"))
    assert view("ops_latest_contract_checks_v") == content(S.latest_contract_checks(contracts)) and len(view("ops_latest_contract_checks_v")) == 4
    assert view("ops_direct_checks_v") == content(S.all_direct_checks(checks)) and len(view("ops_direct_checks_v")) == 20
    assert view("ops_last_success_v") == content(S.last_success(runs))
    assert view("ops_reliability_v") == content(S.reliability(runs, day="log_day")) == ["Row(reliability='1 / 1 runs succeeded')"]
    plan = spark.table("shop.ops_latest_contract_checks_v")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in plan


def test_check_rows_tell_full_table_names(spark, folder, schema):
    land(folder, "customers", "customer_id,name,email,country_code,phone\n")
    land(folder, "orders", ORDER_CSV)
    with pytest.raises(C.CheckFailed, match="spark_catalog.shop.customers_silver is empty"):
        daily.run_product(spark, product(folder), "1", now=NOON)
    land(folder, "customers", CUSTOMER_CSV)
    daily.run_product(spark, product(folder), "2", now=NOON)
    names = {r.table_name for r in spark.table("shop.ops_contract_check_log").collect()}
    assert names == {"spark_catalog.shop.customer_order_summary"}
