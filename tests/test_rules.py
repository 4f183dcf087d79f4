from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayworks.operators import routing as R
from assayworks.operators.rules import Rule, grade
from assayworks.plans import customer_orders as P
from tests.shapes import customer, customers, order, orders, values

CUSTOMER, ORDER = P.CUSTOMER_RULES, P.ORDER_RULES


def rule(rules, severity):
    return next(r for r in rules if r.severity == severity)


@pytest.mark.parametrize("name, expected", [
    ("  mary ann o'hara  ", "Mary Ann O'hara"), ("JEAN-LUC", "Jean-luc"), (None, None), ("\tx ", "\tx"),
])
def test_names(spark, name, expected):
    assert values(P.customers_silver(customer(spark, name=name)), "name_std") == [expected]


@pytest.mark.parametrize("email, expected", [("  A@B.COM ", "a@b.com"), (None, None), ("x", "x")])
def test_emails(spark, email, expected):
    assert values(P.customers_silver(customer(spark, email=email)), "email_std") == [expected]


@pytest.mark.parametrize("code, region", [
    ("NO", "Europe"), ("SE", "Europe"), ("DK", "Europe"), ("DE", "Europe"), ("GB", "Europe"),
    ("US", "North America"), ("CA", "North America"), ("ZZ", "Unknown"), ("no", "Unknown"), (None, "Unknown"),
])
def test_regions(spark, code, region):
    assert values(P.customers_silver(customer(spark, country_code=code)), "region") == [region]


@pytest.mark.parametrize("status, expected", [(" pending  ", "PENDING"), (None, None)])
def test_statuses(spark, status, expected):
    row = P.orders_silver(order(spark, status=status)).first()
    assert (row.status_std, row.amount) == (expected, Decimal("9.99"))


@pytest.mark.parametrize("shape, change, rule_name", [
    ("customer", {"customer_id": None}, "customer_id_not_null"),
    ("customer", {"email": "nobody"}, "valid_email_format"),
    ("customer", {"email": "nobody@home"}, "valid_email_format"),
    ("customer", {"phone": None}, "phone_not_null"),
    ("order", {"order_id": None}, "order_id_not_null"),
    ("order", {"customer_id": None}, "customer_id_not_null"),
    ("order", {"amount": Decimal("0.00")}, "positive_amount"),
    ("order", {"amount": Decimal("-1.00")}, "positive_amount"),
    ("order", {"status": None}, "status_not_null"),
])
def test_each_violation_is_found_by_its_rule_alone(spark, shape, change, rule_name):
    make, transform, rules = {
        "customer": (customer, P.customers_silver, CUSTOMER), "order": (order, P.orders_silver, ORDER)}[shape]
    silver = transform(make(spark, **change))
    assert [r.name for r in rules if R.violations(silver, r).count()] == [rule_name]
    assert not any(R.violations(transform(make(spark)), r).count() for r in rules)


def test_rejected_rows_name_rules_in_order(spark):
    rules = [Rule("b_rule", "amount > 0", "business_invalid"), Rule("w", "false", "warning"),
             Rule("a_rule", "status_std = 'PAID'", "business_invalid")]
    silver = P.orders_silver(orders(spark, [
        ("n1", "k", Decimal(1), None, "paid"), ("n2", "k", Decimal(-1), None, "open"), ("n3", "k", Decimal(1), None, "open"),
    ]))
    rows = {r.order_id: (r.rejection_reason, r.rejection_severity) for r in R.rejected(silver, rules).collect()}
    assert rows == {"n2": ("b_rule, a_rule", "business_invalid"), "n3": ("a_rule", "business_invalid")}
    assert values(R.tag(silver, rules), "_failed") == [["w"], ["b_rule", "w", "a_rule"], ["w", "a_rule"]]


def test_warnings_keep_rows(spark):
    sides = R.split(P.customers_silver(customer(spark, phone=None)), CUSTOMER)
    assert (sides.silver.count(), sides.rejected.count()) == (1, 0)


def test_without_dropping_rules_rejected_is_empty_with_the_same_schema(spark):
    silver = P.customers_silver(customer(spark))
    none, some = R.rejected(silver, CUSTOMER[:1]), R.rejected(silver, CUSTOMER)
    assert none.count() == 0
    assert [(f.name, f.dataType) for f in none.schema] == [(f.name, f.dataType) for f in some.schema]


@pytest.mark.parametrize("policy, kept, bad", [("pass", ["1", "2"], ["3"]), ("violation", ["1"], ["2", "3"])])
def test_null_policy(spark, policy, kept, bad):
    silver = P.orders_silver(orders(spark, [
        ("1", "k", Decimal(1), None, "x"), ("2", "k", None, None, "x"), ("3", "k", Decimal(-1), None, "x")]))
    sides = R.split(silver, ORDER, null_policy=policy)
    assert (values(sides.silver, "order_id"), values(sides.rejected, "order_id")) == (kept, bad)
    routed = R.routed_split(R.route(silver, ORDER, null_policy=policy))
    assert sorted(routed.silver.collect()) == sorted(sides.silver.collect())
    assert sorted(routed.rejected.collect()) == sorted(sides.rejected.collect())
    counts = R.rule_metrics(silver, ORDER, null_policy=policy).filter("rule = 'positive_amount'").first()
    assert (counts.passed, counts.failed) == (len(kept), len(bad))


def test_grading_by_mode():
    drop, fail = grade(ORDER, "drop"), grade(ORDER, "fail")
    assert [r.name for r in drop.abort] == ["order_id_not_null", "customer_id_not_null"]
    assert [r.name for r in drop.drop] == ["positive_amount"] and not fail.drop
    assert [r.name for r in fail.abort] == ["order_id_not_null", "customer_id_not_null", "positive_amount"]
    assert drop.observe == fail.observe == (rule(ORDER, "warning"),)
    with pytest.raises(ValueError):
        grade(ORDER, "other")
    with pytest.raises(ValueError):
        Rule("r", "true", "fatal")


def test_rules_compare_by_value():
    assert Rule("r", "a > 1", "warning") == Rule("r", "a > 1", "warning")


ACTIONS = {
    "count": lambda df: df.count(),
    "pruned": lambda df: df.select("status_std").collect(),
    "filtered": lambda df: df.filter("status_std = 'OPEN'").collect(),
    "key not null": lambda df: df.filter("customer_id IS NOT NULL").collect(),
    "aggregated": lambda df: df.groupBy("customer_id").count().collect(),
}


@pytest.mark.parametrize("action", ACTIONS)
def test_critical_violation_aborts_every_full_read(spark, folder, action):
    orders(spark, [("1", None, Decimal(1), None, "paid"), ("2", "k", Decimal(1), None, "open")]).write.parquet(f"{folder}/o")
    silver = R.split(P.orders_silver(spark.read.parquet(f"{folder}/o")), ORDER).silver
    with pytest.raises(Exception, match="quality rule violated: customer_id_not_null"):
        ACTIONS[action](silver)


def test_critical_violation_aborts_a_summary_although_the_join_ignores_null_keys(spark, folder):
    orders(spark, [("1", None, Decimal(1), None, "paid")]).write.parquet(f"{folder}/o")
    silver = R.split(P.orders_silver(spark.read.parquet(f"{folder}/o")), ORDER).silver
    with pytest.raises(Exception, match="customer_id_not_null"):
        P.customer_order_summary(P.customers_silver(customer(spark)), silver).collect()


def test_fail_mode_aborts_on_invalid_rows_and_writes_nothing(spark, folder):
    silver = P.orders_silver(orders(spark, [("1", "k", Decimal(1), None, "x"), ("2", "k", Decimal(-1), None, "x")]))
    assert R.split(silver, ORDER, "drop").silver.count() == 1
    with pytest.raises(Exception, match="positive_amount"):
        R.route(silver, ORDER, "fail").write.partitionBy(R.ROUTE).parquet(f"{folder}/out")
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/out").count()
    sides = R.split(silver, ORDER, "fail")
    assert values(sides.rejected, "order_id") == ["2"]  # the offenders can still be looked at
    with pytest.raises(Exception, match="positive_amount"):
        sides.silver.count()


def test_observed_counts_ride_on_a_write(spark):
    from pyspark.sql import Observation
    seen = Observation("q")
    silver = P.customers_silver(customers(spark, [("1", "a", "a@b.c", "NO", None), ("2", "a", "bad", "NO", "1")]))
    silver.observe(seen, *R.violation_counts(CUSTOMER)).write.format("noop").mode("overwrite").save()
    assert seen.get == {"customer_id_not_null": 0, "valid_email_format": 1, "phone_not_null": 1}


def test_split_covers_the_input_once(spark):
    for policy in ("pass", "violation"):
        events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
        rules = [Rule("v", "nullif(value, 6.55) > 5", "business_invalid"), Rule("t", "event_type <> 'error'", "business_invalid")]
        sides = R.split(events, rules, null_policy=policy)
        back = sides.silver.unionByName(sides.rejected.drop(R.REASON, R.SEVERITY))
        assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0


def test_simple_rules_reach_the_scan(spark, folder):
    orders(spark, [("1", "k", Decimal(1), None, "paid")]).write.parquet(f"{folder}/o")
    silver = P.orders_silver(spark.read.parquet(f"{folder}/o"))
    for frame, pushed in ((R.accepted(silver, ORDER), "Or(GreaterThan(amount,0.00),IsNull(amount))"),
                          (R.accepted(silver, ORDER, "violation"), "GreaterThan(amount,0.00)"),
                          (R.rejected(silver, ORDER), "LessThanOrEqual(amount,0.00)")):
        assert pushed in frame._jdf.queryExecution().executedPlan().toString().replace(", ", ",")


def test_metrics_by_group_are_one_aggregation(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rules = [Rule(f"r{i}", f"value > {i}", "warning") for i in range(20)]
    metrics = R.rule_metrics(events, rules, by=["event_type"])
    assert metrics.count() == 20 * events.select("event_type").distinct().count()
    assert metrics._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert metrics.agg(F.sum(F.col("passed") + F.col("failed"))).first()[0] == 20 * events.count()
