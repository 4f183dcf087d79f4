"""The customer and order data product: schemas, rules, transforms, summary and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType, TimestampType

from assayworks.functions.lookup import mapped
from assayworks.functions.text import lower_case, title_case, upper_case
from assayworks.operators.contract import Contract
from assayworks.operators.rules import Rule
from assayworks.operators.summary import aggregate, fold, summarise, with_measures
from assayworks.sources.buckets import Buckets
from assayworks.sources.landing import INGESTED_AT, SOURCE_FILE

# Landing columns, code table, rules and contract entries of the product.

CUSTOMERS_LANDING = (
    StructType()
    .add("customer_id", StringType()).add("name", StringType()).add("email", StringType())
    .add("country_code", StringType()).add("phone", StringType())
)
ORDERS_LANDING = (
    StructType()
    .add("order_id", StringType()).add("customer_id", StringType()).add("amount", DecimalType(10, 2))
    .add("order_date", TimestampType()).add("status", StringType())
)

REGIONS = {
    "NO": "Europe", "SE": "Europe", "DK": "Europe", "DE": "Europe", "GB": "Europe",
    "US": "North America", "CA": "North America",
}
UNKNOWN_REGION = "Unknown"

CUSTOMER_RULES = (
    Rule("customer_id_not_null", "customer_id IS NOT NULL", "critical"),
    Rule("valid_email_format", "email_std LIKE '%@%.%'", "business_invalid"),
    Rule("phone_not_null", "phone IS NOT NULL", "warning"),
)
ORDER_RULES = (
    Rule("order_id_not_null", "order_id IS NOT NULL", "critical"),
    Rule("customer_id_not_null", "customer_id IS NOT NULL", "critical"),
    Rule("positive_amount", "amount > 0", "business_invalid"),
    Rule("status_not_null", "status_std IS NOT NULL", "warning"),
)
REJECTION_LIMIT = 0.30
CONTRACT_FRESHNESS_HOURS = 24


def _column(name: str, kind: str, nullable: bool = True) -> dict:
    return {"name": name, "type": kind, "nullable": nullable}


_LINEAGE = [_column(SOURCE_FILE, "string"), _column(INGESTED_AT, "timestamp", nullable=False)]


def _silver_checks() -> list[dict]:
    return [
        {"name": "silver_not_empty", "type": "row_count_gt_zero"},
        {"name": "silver_freshness", "type": "freshness_hours", "column": INGESTED_AT,
         "threshold": CONTRACT_FRESHNESS_HOURS},
        {"name": "rejection_ratio", "type": "fraction_lt_threshold", "threshold": REJECTION_LIMIT},
    ]


def _rejection(rules: tuple[Rule, ...]) -> dict:
    return {
        "severity": "business_invalid",
        "rules": [{"name": r.name, "constraint": r.constraint}
                  for r in rules if r.severity == "business_invalid"],
    }


CUSTOMERS_CONTRACT = Contract.from_dict({
    "table": "customers_silver",
    "schema": [
        _column("customer_id", "string", nullable=False), _column("name_std", "string"),
        _column("email_std", "string"), _column("country_code", "string"),
        _column("region", "string"), _column("phone", "string"), *_LINEAGE,
    ],
    "quality_checks": _silver_checks(),
    "rejection": _rejection(CUSTOMER_RULES),
})
ORDERS_CONTRACT = Contract.from_dict({
    "table": "orders_silver",
    "schema": [
        _column("order_id", "string", nullable=False), _column("customer_id", "string", nullable=False),
        _column("amount", "decimal(10,2)"), _column("order_date", "timestamp"),
        _column("status_std", "string"), *_LINEAGE,
    ],
    "quality_checks": _silver_checks(),
    "rejection": _rejection(ORDER_RULES),
})
SUMMARY_COLUMNS = (
    "customer_id", "name_std", "email_std", "region", "order_count", "total_amount", "last_order_date",
)
SUMMARY_CONTRACT = Contract.from_dict({
    "table": "customer_order_summary",
    "schema": [
        _column("customer_id", "string", nullable=False), _column("name_std", "string"),
        _column("email_std", "string"), _column("region", "string"),
        _column("order_count", "long", nullable=False), _column("total_amount", "decimal"),
        _column("last_order_date", "timestamp"),
    ],
    "quality_checks": [
        {"name": "gold_not_empty", "type": "row_count_gt_zero"},
        {"name": "required_columns", "type": "columns_present", "columns": list(SUMMARY_COLUMNS)},
        {"name": "customer_id_not_null", "type": "column_not_null", "column": "customer_id"},
        {"name": "non_negative_order_count", "type": "column_gte_zero", "column": "order_count"},
    ],
})


def customers_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "customer_id",
        title_case("name").alias("name_std"),
        lower_case("email").alias("email_std"),
        "country_code",
        mapped("country_code", REGIONS, UNKNOWN_REGION).alias("region"),
        "phone", SOURCE_FILE, INGESTED_AT,
    )


def orders_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_id", "customer_id", "amount", "order_date",
        upper_case("status").alias("status_std"),
        SOURCE_FILE, INGESTED_AT,
    )


def order_measures() -> dict:
    return {
        "order_count": F.count("order_id"),
        "total_amount": F.sum("amount"),
        "last_order_date": F.max("order_date"),
    }


def merged_measures() -> dict:
    """Combines order measures of disjoint sets of orders."""
    return {
        "order_count": F.sum("order_count"),
        "total_amount": F.sum("total_amount").cast("decimal(20,2)"),
        "last_order_date": F.max("last_order_date"),
    }


def order_totals(orders: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Order measures per customer, added to those of earlier orders."""
    fresh = aggregate(orders, ["customer_id"], order_measures())
    return fresh if before is None else fold(before, fresh, ["customer_id"], merged_measures())


def order_buckets(path: str, count: int) -> Buckets:
    """Order totals per customer, kept in buckets of the customer."""
    kinds = "customer_id string, order_count bigint, total_amount decimal(20,2), last_order_date timestamp"
    return Buckets(path, ("customer_id",), count, StructType.fromDDL(kinds))


def summary_of_totals(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """The summary from order totals, one row per customer, instead of orders."""
    return with_measures(
        customers, totals, ["customer_id"], list(merged_measures()),
        carry=["name_std", "email_std", "region"], zero=["order_count"],
    )


def totals_with(totals: DataFrame, orders: DataFrame) -> DataFrame:
    """Totals after a batch of orders, for customers of the batch's buckets."""
    return order_totals(orders, totals)


def customer_order_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every silver customer with number, sum and last date of its silver orders."""
    return summarise(
        customers, orders, "customer_id", order_measures(),
        carry=["name_std", "email_std", "region"], zero=["order_count"],
    )
