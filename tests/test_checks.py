from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayworks.operators import checks as C
from assayworks.operators.contract import Contract
from assayworks.plans import customer_orders as P
from assayworks.plans import daily
from tests.shapes import NOON, customers, orders


def run(df, *found):
    rows = C.run(df, list(found), run_id="r", pipeline="p", table="t", as_of=NOON).collect()
    return {r.check_name: (r.status, r.message, r.actual_value, r.expected_value) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, n int, _ingested_at timestamp")


def test_empty_table_fails_twice(spark):
    found = run(frame(spark, []), C.not_empty("t"), C.freshness("_ingested_at", 24))
    assert found["silver_not_empty"] == ("FAIL", "t is empty", "0", "> 0")
    assert found["silver_freshness"][:2] == ("FAIL", "_ingested_at is null")


@pytest.mark.parametrize("age, status, message", [
    (timedelta(hours=24), "PASS", "Most recent _ingested_at is 24.0h ago"),
    (timedelta(hours=24, seconds=1), "FAIL", "Most recent _ingested_at is 24.0h ago (threshold: 24h)"),
    (timedelta(hours=25, minutes=30), "FAIL", "Most recent _ingested_at is 25.5h ago (threshold: 24h)"),
    (timedelta(hours=-1), "PASS", "Most recent _ingested_at is -1.0h ago"),
])
def test_freshness_limit(spark, age, status, message):
    df = frame(spark, [("a", 1, NOON - age), ("b", 1, NOON - age - timedelta(days=9)), ("c", 1, None)])
    assert run(df, C.freshness("_ingested_at", 24))["silver_freshness"][:2] == (status, message)


@pytest.mark.parametrize("landed, bad, status, message", [
    (10, 3, "PASS", "3/10 rows rejected (30.0%, threshold: 30%)"),
    (1000, 301, "FAIL", "301/1000 rows rejected (30.1%, threshold: 30%)"),
    (12, 2, "PASS", "2/12 rows rejected (16.7%, threshold: 30%)"),
    (0, 0, "WARN", "bronze table is empty — skipping ratio check"),
    (5, 0, "PASS", "0/5 rows rejected (0.0%, threshold: 30%)"),
])
def test_rejection_ratio(spark, landed, bad, status, message):
    check = C.rejection_ratio(spark.range(landed), spark.range(bad), 0.30)
    assert run(spark.range(1), check)["rejection_ratio"][:2] == (status, message)


def test_value_checks(spark):
    bad = frame(spark, [(None, -1, NOON), ("a", -2, NOON), ("a", None, NOON)])
    good = frame(spark, [("a", 0, NOON), ("b", 5, NOON)])
    found = [C.column_not_null("id"), C.column_gte_zero("n"), C.unique_key(["id"]), C.nullability(["id", "n"])]
    assert run(bad, *found) == {
        "id_not_null": ("FAIL", "1 rows with null id", "1", "0"),
        "non_negative_n": ("FAIL", "2 rows with n < 0", "2", "0"),
        "unique_key": ("FAIL", "1 repeated keys (id)", "1", "0"),
        "non_nullable_columns": ("FAIL", "NULLs in id=1, n=1", "2", "0"),
    }
    assert run(good, *found) == {
        "id_not_null": ("PASS", "No null id rows", "0", "0"),
        "non_negative_n": ("PASS", "All n values >= 0", "0", "0"),
        "unique_key": ("PASS", "Every key is unique (id)", "0", "0"),
        "non_nullable_columns": ("PASS", "No NULLs in non-nullable columns", "0", "0"),
    }


def test_missing_columns_fail_without_an_error(spark):
    df = spark.range(3)
    found = run(df, C.required_columns(df, ["id", "z", "b"]), C.column_not_null("b"), C.not_empty("t"))
    assert found["required_columns"] == ("FAIL", "Missing columns: ['b', 'z']", "['id']", "['b', 'id', 'z']")
    assert found["b_not_null"][0] == "FAIL" and found["silver_not_empty"][0] == "PASS"


def test_types(spark):
    df = spark.createDataFrame([], "a bigint, b decimal(12,3), c timestamp_ntz, d int")
    same = run(df, C.column_types(df, {"a": "long", "b": "decimal", "c": "timestamp", "d": "int"}))
    assert same["column_types"][0] == "PASS"
    other = run(df, C.column_types(df, {"b": "decimal(10,2)", "e": "string", "a": "bigint"}))
    assert other["column_types"][:3] == (
        "FAIL", "Type differs: b decimal(12,3), e absent", "b decimal(12,3), e absent")


def test_orphans(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "id string")
    assert run(child, C.no_orphans(parent, ["id"]))["no_orphan_keys"][2] == "3"
    assert run(parent, C.no_orphans(parent, ["id"]))["no_orphan_keys"][0] == "PASS"


def test_shared_checks_scan_a_table_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    found = [C.not_empty("t"), C.freshness("o_orderdate", 1), C.column_not_null("o_custkey"),
             C.column_gte_zero("o_totalprice"), C.required_columns(df, ["o_orderkey"])]
    results = C.run(df, found, run_id="r", pipeline="p", table="t", as_of=NOON)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and results.count() == 5
    assert "o_orderpriority" not in plan.split("ReadSchema:")[1]
    assert [r.check_name for r in results.orderBy("position").collect()] == [c.name for c in found]


def test_tally_and_gate(spark):
    ok = C.run(spark.range(1), [C.not_empty("t")], run_id="a", pipeline="p", table="t", as_of=NOON)
    warn = C.run(spark.range(1), [C.rejection_ratio(spark.range(0), spark.range(0), 0.3)],
                 run_id="a", pipeline="p", table="t", as_of=NOON)
    bad = C.run(spark.range(0), [C.not_empty("t")], run_id="b", pipeline="p", table="t", as_of=NOON)
    rows = {r.run_id: tuple(r)[1:] for r in C.tally(ok.unionAll(warn).unionAll(bad)).collect()}
    assert rows == {"a": (1, 1, 0, "PASS"), "b": (0, 0, 1, "FAIL")}
    C.gate(ok.unionAll(warn))
    with pytest.raises(C.CheckFailed, match=r"1 check\(s\) failed\n\[p\] silver_not_empty: t is empty"):
        C.gate(ok.unionAll(bad))


def test_reconcile(spark):
    rows = C.reconcile({"a": spark.range(3), "b": spark.range(2)}, {"a": 3, "b": 5, "c": 1}).collect()
    assert {r.table_name: (r.actual_rows, r.status) for r in rows} == {
        "a": (3, "PASS"), "b": (2, "FAIL"), "c": (None, "FAIL")}


def test_contracts(spark, folder):
    silver = P.orders_silver(orders(spark, [("n1", "k", Decimal(1), NOON, "x")]))
    contract = P.ORDERS_CONTRACT
    found = run(silver, *contract.schema_checks(silver), *contract.checks(
        silver, bronze=silver, rejected=silver.limit(0)))
    assert {name: row[0] for name, row in found.items()} == {
        "column_types": "PASS", "non_nullable_columns": "PASS", "silver_not_empty": "PASS",
        "silver_freshness": "PASS", "rejection_ratio": "PASS"}
    assert [r.name for r in contract.rejection] == ["positive_amount"]
    assert [r.name for r in P.CUSTOMERS_CONTRACT.rejection] == ["valid_email_format"]
    with pytest.raises(ValueError):
        contract.checks(silver)
    text = ('{"table": "${schema}.t", "schema": [{"name": "id", "type": "long", "nullable": false}],'
            ' "quality_checks": [{"name": "k", "type": "unique_key", "columns": ["id"]}]}')
    for suffix in ("json", "yml"):
        with open(f"{folder}/c.{suffix}", "w") as out:
            out.write(text)
        loaded = Contract.from_file(f"{folder}/c.{suffix}", schema="dev")
        assert loaded.table == "dev.t" and run(spark.range(3), *loaded.checks(spark.range(3)))["k"][0] == "PASS"
    with pytest.raises(ValueError):
        Contract.from_dict({"table": "t", "schema": [], "quality_checks": [{"name": "x", "type": "other"}]}).checks(silver)


def test_summary_contract(spark):
    summary = P.customer_order_summary(
        P.customers_silver(customers(spark, [("k1", "a", "a@b.c", "NO", "1"), (None, "b", "b@b.c", "NO", "1")])),
        P.orders_silver(orders(spark, [("n1", "k1", Decimal(1), NOON, "x")])))
    rows = {r.check_name: r.status for r in daily.summary_results(summary, run_id="r", as_of=NOON).collect()}
    assert rows == {"gold_not_empty": "PASS", "required_columns": "PASS", "customer_id_not_null": "FAIL",
                    "non_negative_order_count": "PASS"}
    types = run(summary, *P.SUMMARY_CONTRACT.schema_checks(summary))
    assert types["column_types"][0] == "PASS" and types["non_nullable_columns"][0] == "FAIL"


def test_clock_defaults_to_now(spark):
    df = spark.range(1).select(F.current_timestamp().alias("t"))
    row = C.run(df, [C.freshness("t", 1)], run_id="r", pipeline="p", table="t").first()
    assert row.status == "PASS" and abs((row.checked_at - datetime.now()).total_seconds()) < 86400


@pytest.mark.parametrize("rows", [[("a", 1), ("b", 0)], [("a", 1), (None, None)], [("a", -1), (None, 2), ("c", -7)], []])
def test_footers_answer_as_the_rows_do(spark, folder, rows):
    spark.createDataFrame(rows, "k string, `a.n` long").write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    checks = [C.not_empty("t"), C.column_not_null("k"), C.column_gte_zero("a.n"), C.nullability(["k", "a.n"]), C.column_not_null("absent"),
              C.unique_key(["k"])]
    told = {"run_id": "r", "pipeline": "p", "table": "t", "as_of": "2024-01-01 00:00:00"}
    plain = C.run(df, checks, **told).orderBy("position").collect()
    assert C.run(df, checks, parquet=f"{folder}/t", **told).orderBy("position").collect() == plain


def test_counts_and_extremes_come_from_footers(spark, folder):
    spark.range(100).selectExpr("id", "if(id % 3 = 0, NULL, cast(id AS string)) AS s").write.parquet(f"{folder}/t")
    found = C.footer_aggregates(spark, f"{folder}/t", {"n": "count(1)", "set": "count(s)", "low": "min(id)"})
    assert "PushedAggregation: [COUNT(*), COUNT(s), MIN(id)]" in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(found.first()) == (100, 66, 0)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
