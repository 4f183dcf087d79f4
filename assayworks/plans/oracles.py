"""The catalogue's queries as standalone SQL for an independent engine."""

from __future__ import annotations

CUSTOMERS_BRONZE = """
customers_bronze AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         '  ' || lower(c_mktsegment) || ' buyer  ' AS name,
         CASE WHEN c_custkey % 10 = 3 THEN 'not-an-email' WHEN c_custkey % 10 = 7 THEN NULL
              ELSE upper('user' || c_custkey || '@example.com') END AS email,
         (['NO', 'SE', 'DK', 'DE', 'GB', 'US', 'CA', 'ZZ'])[c_nationkey % 8 + 1] AS country_code,
         CASE WHEN c_custkey % 8 <> 0 THEN '+47' || c_custkey END AS phone,
         'landing/customers' AS _source_file,
         TIMESTAMP '2001-08-01 12:00:00' AS _ingested_at
  FROM customer)"""

CUSTOMERS = CUSTOMERS_BRONZE + """,
customers_candidates AS (
  SELECT customer_id,
         array_to_string(list_transform(string_split(lower(trim(name)), ' '),
                                        lambda w: upper(w[1:1]) || w[2:]), ' ') AS name_std,
         lower(trim(email)) AS email_std, country_code,
         CASE WHEN country_code IN ('NO', 'SE', 'DK', 'DE', 'GB') THEN 'Europe'
              WHEN country_code IN ('US', 'CA') THEN 'North America' ELSE 'Unknown' END AS region,
         phone, _source_file, _ingested_at
  FROM customers_bronze),
customers_kept AS (SELECT * FROM customers_candidates WHERE email_std IS NULL OR email_std LIKE '%@%.%'),
customers_bad AS (
  SELECT *, 'valid_email_format' AS rejection_reason, 'business_invalid' AS rejection_severity
  FROM customers_candidates WHERE email_std NOT LIKE '%@%.%')"""

ORDERS_BRONZE = """
orders_bronze AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(CASE WHEN o_custkey % 20 = 0 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 50 = 11 THEN NULL
              WHEN o_orderkey % 15 = 9 THEN -CAST(o_totalprice AS DECIMAL(10,2))
              ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS amount,
         o_orderdate AS order_date,
         CASE WHEN o_orderkey % 15 <> 10 THEN ' ' || lower(o_orderstatus) || ' ' END AS status,
         'landing/orders' AS _source_file, o_orderdate AS _ingested_at
  FROM orders)"""

ORDERS = ORDERS_BRONZE + """,
orders_candidates AS (
  SELECT order_id, customer_id, amount, order_date, upper(trim(status)) AS status_std,
         _source_file, _ingested_at
  FROM orders_bronze),
orders_kept AS (SELECT * FROM orders_candidates WHERE amount IS NULL OR amount > 0),
orders_bad AS (
  SELECT *, 'positive_amount' AS rejection_reason, 'business_invalid' AS rejection_severity
  FROM orders_candidates WHERE amount <= 0)"""

GAPS = ORDERS + """,
gaps AS (
  SELECT CASE WHEN CAST(order_id AS BIGINT) % 40 <> 7 THEN order_id END AS order_id,
         CASE WHEN CAST(order_id AS BIGINT) % 60 <> 13 THEN customer_id END AS customer_id,
         amount, order_date, status_std, _source_file, _ingested_at
  FROM orders_candidates)"""


def _summary_sql(customers: str, orders: str) -> str:
    return f"""
summary AS (
  SELECT c.customer_id, c.name_std, c.email_std, c.region,
         coalesce(t.order_count, 0) AS order_count, t.total_amount, t.last_order_date
  FROM {customers} c LEFT JOIN (
    SELECT customer_id, count(order_id) AS order_count,
           CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, max(order_date) AS last_order_date
    FROM {orders} GROUP BY customer_id) t ON c.customer_id = t.customer_id)"""


SUMMARY = CUSTOMERS + "," + ORDERS + "," + _summary_sql("customers_kept", "orders_kept")

CHANGES = "changes AS (SELECT user_id, ts, event_id, event_type, value FROM events)"

CHECK_LOG = """
check_log AS (
  SELECT CAST(event_id // 10 AS VARCHAR) AS run_id, 'pipeline_' || (user_id % 3) AS pipeline_name,
         event_type AS check_name,
         CASE WHEN event_id % 3 = 0 THEN 'expectation' ELSE 'direct' END AS check_type,
         CASE WHEN event_type = 'error' THEN 'FAIL'
              WHEN event_type = 'signup' AND event_id % 25 = 4 THEN 'WARN' ELSE 'PASS' END AS status,
         'event ' || event_id AS message, ts AS checked_at
  FROM events)"""

CONTRACT_LOG = """
contract_log AS (
  SELECT CAST(event_id // 10 AS VARCHAR) AS run_id, 'table_' || (user_id % 3) AS table_name,
         event_type AS check_name, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS status,
         CAST(event_id % 5 AS VARCHAR) AS actual_value, '> 0' AS expected_value,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS checked_at
  FROM events)"""

RUNS = CHECK_LOG + """,
job_runs AS (
  SELECT CAST(run AS VARCHAR) AS job_run_id, last_at + to_seconds(run % 3600) AS recorded_at,
         'shop' AS catalog_name, (['dev', 'pr', 'prod'])[run % 3 + 1] AS schema_name,
         (['dev', 'pr', 'prod'])[run % 3 + 1] AS bundle_target,
         CASE WHEN run % 9 <> 0 THEN substr(md5(CAST(run AS VARCHAR)), 1, 7) END AS git_sha,
         started_at, 'https://jobs.example/runs/' || run AS job_run_url
  FROM (SELECT event_id // 4 AS run, min(ts) AS started_at, max(ts) AS last_at FROM events GROUP BY 1)),
tasks AS (
  SELECT CAST(event_id // 4 AS VARCHAR) AS job_run_id, event_id % 4 AS ord,
         (['run_customers', 'run_orders', 'run_gold', 'finalize_ops_status'])[event_id % 4 + 1] AS task_key,
         event_type = 'error' AS failed,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE substr(repeat('x', event_id % 600) || props, 1, 500) END AS msg
  FROM events WHERE (event_id // 4) % 50 <> 0),
outcomes AS (
  SELECT job_run_id, arg_min(task_key, ord) FILTER (failed AND task_key <> 'finalize_ops_status') AS failed_task_key,
         arg_min(msg, ord) FILTER (failed AND task_key <> 'finalize_ops_status') AS msg
  FROM tasks GROUP BY job_run_id),
runs AS (
  SELECT r.job_run_id, r.recorded_at, r.catalog_name, r.schema_name, r.bundle_target,
         coalesce(r.git_sha, 'unknown') AS git_sha,
         CASE WHEN o.job_run_id IS NULL THEN 'UNKNOWN' WHEN o.failed_task_key IS NOT NULL THEN 'FAILED'
              WHEN EXISTS (SELECT 1 FROM check_log w WHERE w.status = 'WARN' AND w.check_type = 'direct'
                           AND w.checked_at >= r.started_at AND w.checked_at <= r.recorded_at) THEN 'WARNING'
              ELSE 'SUCCESS' END AS overall_status,
         o.failed_task_key, nullif(o.msg, '') AS failure_message, r.started_at,
         r.recorded_at AS completed_at,
         CAST(floor(epoch(r.recorded_at)) - floor(epoch(r.started_at)) AS BIGINT) AS duration_seconds, r.job_run_url
  FROM job_runs r LEFT JOIN outcomes o ON r.job_run_id = o.job_run_id)"""

BOARD = """
CASE WHEN overall_status IN ('FAILED', 'WARNING') THEN overall_status
     WHEN overall_status = 'SUCCESS' AND (epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(completed_at))) / 3600 > 48
     THEN 'STALE' WHEN overall_status = 'SUCCESS' THEN 'HEALTHY' ELSE 'UNKNOWN' END AS dashboard_status,
TIMESTAMP '2024-01-31 12:00:00' AS view_refreshed_at"""

EVENT_LOG = """
event_log AS (
  SELECT 'pipeline_' || (user_id % 3) AS pipeline_name, ts,
         event_type = 'signup' AND user_id % 3 <> 2 AS is_update,
         'u' || (user_id % 7) AS update_id, 'flow_' || (user_id % 2) AS flow_name,
         event_type, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
latest AS (
  SELECT pipeline_name, arg_max(update_id, (ts, update_id)) AS update_id
  FROM event_log WHERE is_update GROUP BY pipeline_name),
progress AS (
  SELECT e.* FROM event_log e JOIN latest USING (pipeline_name, update_id)
  WHERE NOT is_update AND event_type IN ('click', 'purchase')),
results AS (
  SELECT pipeline_name, flow_name, 'amount_ok' AS expectation_name, k AS passed, event_id % 3 AS failed FROM progress
  UNION ALL SELECT pipeline_name, flow_name, 'id_ok', event_id % 11, 0 FROM progress
  UNION ALL SELECT pipeline_name, flow_name, 'unmeasured', 1, NULL FROM progress),
totals AS (
  SELECT pipeline_name, flow_name, expectation_name, CAST(sum(passed) AS BIGINT) AS total_passed,
         CAST(sum(failed) AS BIGINT) AS total_failed
  FROM results GROUP BY ALL)"""

VERSIONS = CHANGES + """,
versions AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS "__END_AT", ts AS "__START_AT"
  FROM changes)"""

REASONS = """concat_ws(', ', CASE WHEN value <= 5 THEN 'value_over_five' END,
                     CASE WHEN event_type = 'error' THEN 'no_errors' END)"""


def _silver_log(table: str, kept: str, bad: str, bronze: str, hours: int, pipeline: str) -> str:
    return f"""
m AS (SELECT (SELECT count(*) FROM {kept}) AS n,
             (SELECT (epoch(TIMESTAMP '2001-08-01 18:00:00') - floor(epoch(max(_ingested_at)))) / 3600 FROM {kept}) AS age,
             (SELECT count(*) FROM {bronze}) AS b, (SELECT count(*) FROM {bad}) AS r),
silver_log AS (
  SELECT 'r1' AS run_id, '{pipeline}' AS pipeline_name, t.*, TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM (
    SELECT 'silver_not_empty' AS check_name, 'direct' AS check_type,
           CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN n = 0 THEN '{table} is empty' ELSE n || ' rows' END AS message,
           CAST(n AS VARCHAR) AS actual_value, '> 0' AS expected_value FROM m
    UNION ALL
    SELECT 'silver_freshness', 'direct', CASE WHEN age <= {hours} THEN 'PASS' ELSE 'FAIL' END,
           'Most recent _ingested_at is ' || printf('%.1f', age) || 'h ago'
             || CASE WHEN age > {hours} THEN ' (threshold: {hours}h)' ELSE '' END,
           printf('%.1f', age), '<= {hours}' FROM m
    UNION ALL
    SELECT 'rejection_ratio', 'direct', CASE WHEN r / b > 0.3 THEN 'FAIL' ELSE 'PASS' END,
           r || '/' || b || ' rows rejected (' || printf('%.1f%%', 100.0 * r / b) || ', threshold: 30%)',
           printf('%.1f%%', 100.0 * r / b), '<= 30%' FROM m) t)"""


CUSTOMERS_AUDIT = CUSTOMERS + "," + _silver_log(
    "customers_silver", "customers_kept", "customers_bad", "customers_bronze", 168, "customers_pipeline")
ORDERS_AUDIT = ORDERS + "," + _silver_log(
    "orders_silver", "orders_kept", "orders_bad", "orders_bronze", 12, "orders_pipeline")
ORDERS_CONTRACT_AUDIT = ORDERS + "," + _silver_log(
    "orders_silver", "orders_kept", "orders_bad", "orders_bronze", 24, "orders_pipeline")

SUMMARY_AUDIT = SUMMARY + """,
g AS (SELECT count(*) AS n, count(*) FILTER (customer_id IS NULL) AS nulls,
             count(*) FILTER (order_count < 0) AS negatives FROM summary),
summary_log AS (
  SELECT 'r2' AS run_id, 'gold_pipeline' AS pipeline_name, 'customer_order_summary' AS table_name,
         'direct' AS check_type, t.*, TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM (
    SELECT 'gold_not_empty' AS check_name, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           n || ' rows' AS message, CAST(n AS VARCHAR) AS actual_value, '> 0' AS expected_value FROM g
    UNION ALL SELECT 'required_columns', 'PASS', 'All expected columns present', cols, cols FROM (SELECT
      '[''customer_id'', ''email_std'', ''last_order_date'', ''name_std'', ''order_count'', ''region'', ''total_amount'']' AS cols)
    UNION ALL SELECT 'customer_id_not_null', CASE WHEN nulls > 0 THEN 'FAIL' ELSE 'PASS' END,
      CASE WHEN nulls > 0 THEN nulls || ' rows with null customer_id' ELSE 'No null customer_id rows' END,
      CAST(nulls AS VARCHAR), '0' FROM g
    UNION ALL SELECT 'non_negative_order_count', CASE WHEN negatives > 0 THEN 'FAIL' ELSE 'PASS' END,
      CASE WHEN negatives > 0 THEN negatives || ' rows with order_count < 0' ELSE 'All order_count values >= 0' END,
      CAST(negatives AS VARCHAR), '0' FROM g) t)"""

RUN_LOG = "run_id, pipeline_name, check_name, check_type, status, message, checked_at"
CONTRACT_ROWS = "run_id, table_name, check_name, status, actual_value, expected_value, checked_at"

_METRICS = """
SELECT {by} rule, severity, n - failed AS passed, failed FROM (
  {parts})"""


def _metrics(source: str, rules: list[tuple[str, str, str]], by: str = "") -> str:
    key, group = (f"{by},", f"GROUP BY {by}") if by else ("", "")
    parts = " UNION ALL ".join(
        f"SELECT {key} '{name}' AS rule, '{severity}' AS severity, count(*) AS n, "
        f"count(*) FILTER (NOT ({constraint})) AS failed FROM {source} {group}"
        for name, constraint, severity in rules
    )
    return _METRICS.format(by=key, parts=parts)


ORDER_RULES = [
    ("order_id_not_null", "order_id IS NOT NULL", "critical"),
    ("customer_id_not_null", "customer_id IS NOT NULL", "critical"),
    ("positive_amount", "amount > 0", "business_invalid"),
    ("status_not_null", "status_std IS NOT NULL", "warning"),
]
EVENT_RULES = [
    ("known_user", "user_id IS NOT NULL", "critical"),
    ("value_over_five", "value > 5", "business_invalid"),
    ("no_errors", "event_type <> 'error'", "business_invalid"),
    ("value_under_300", "value < 300", "warning"),
]

ORDERS_LANDED = f"""WITH {ORDERS_BRONZE}
SELECT order_id, customer_id, amount, order_date, status, 'orders_landing' AS _source_file,
       TIMESTAMP '2001-08-01 18:00:00' AS _ingested_at FROM orders_bronze"""

LATEST_STATE = f"""WITH {CHANGES}
SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

SNAPSHOTS = """
before AS (SELECT CASE WHEN o_orderkey % 17 = 3 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey,
                  CASE WHEN o_orderkey % 13 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                  CASE WHEN o_orderkey % 29 <> 6 THEN o_totalprice END AS o_totalprice FROM orders),
between_ AS (SELECT CASE WHEN o_orderkey % 23 = 7 THEN -o_orderkey - 2 ELSE o_orderkey END AS o_orderkey, o_custkey,
                    CASE WHEN o_orderkey % 31 = 4 THEN 'Y' ELSE o_orderstatus END AS o_orderstatus,
                    CASE WHEN o_orderkey % 29 <> 5 THEN o_totalprice END AS o_totalprice FROM orders),
after AS (SELECT CASE WHEN o_orderkey % 19 = 5 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey,
                 o_orderstatus, o_totalprice FROM orders)"""


def _one_hour(column: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + ({column} - date_trunc('hour', {column})))"


HOUR_RECORDED = _one_hour("(last_at + to_seconds(run % 3600))") + " AS recorded_at"
HOUR_STARTED = _one_hour("(last_at + to_seconds(run % 3600))") + " - INTERVAL 2 SECOND"

ORACLES: dict[str, str] = {
    "bronze_orders_projection": """
        SELECT *, 'orders.parquet' AS _source_file, TIMESTAMP '2001-08-01 18:00:00' AS _ingested_at FROM orders""",
    "customers_silver": f"WITH {CUSTOMERS} SELECT * FROM customers_candidates",
    "orders_silver": f"WITH {ORDERS} SELECT * FROM orders_candidates",
    "region_lookup_join": """
        SELECT c_custkey, CAST(c_nationkey + 4 AS BIGINT) AS nation_code, coalesce(r_name, 'Unknown') AS region FROM customer
        LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
          ON c_nationkey + 4 = n_nationkey""",
    "customers_rejected": f"WITH {CUSTOMERS} SELECT * FROM customers_bad",
    "orders_rejected": f"WITH {ORDERS} SELECT * FROM orders_bad",
    "orders_rejected_null_violation": f"""WITH {ORDERS}
        SELECT *, 'positive_amount' AS rejection_reason, 'business_invalid' AS rejection_severity
        FROM orders_candidates WHERE NOT coalesce(amount > 0, false)""",
    "rejected_no_rules": f"""WITH {ORDERS}
        SELECT *, CAST(NULL AS VARCHAR) AS rejection_reason, CAST(NULL AS VARCHAR) AS rejection_severity,
               'silver' AS _route FROM orders_candidates""",
    "split_no_rules": """
        SELECT 'silver' AS destination, count(*) AS n_rows, count(o_orderkey) AS n_ids FROM orders
        UNION ALL SELECT 'rejected', 0, 0""",
    "events_rejected": f"""WITH {CHANGES}
        SELECT *, {REASONS} AS rejection_reason, 'business_invalid' AS rejection_severity
        FROM changes WHERE value <= 5 OR event_type = 'error'""",
    "orders_routed": f"""WITH {ORDERS}
        SELECT *, CASE WHEN amount <= 0 THEN 'positive_amount' END AS rejection_reason,
               CASE WHEN amount <= 0 THEN 'business_invalid' END AS rejection_severity,
               CASE WHEN amount <= 0 THEN 'rejected' ELSE 'silver' END AS _route FROM orders_candidates""",
    "events_tagged": f"""WITH {CHANGES}
        SELECT *, concat_ws('+', CASE WHEN user_id IS NULL THEN 'known_user' END,
                            CASE WHEN value <= 5 THEN 'value_over_five' END,
                            CASE WHEN event_type = 'error' THEN 'no_errors' END,
                            CASE WHEN value >= 300 THEN 'value_under_300' END) AS failed FROM changes""",
    "split_partition_counts": f"""WITH {CUSTOMERS}
        SELECT CASE WHEN coalesce(email_std LIKE '%@%.%', false) THEN 'silver' ELSE 'rejected' END AS destination,
               count(*) AS n_rows FROM customers_candidates GROUP BY 1""",
    "warning_violations": f"WITH {CUSTOMERS} SELECT * FROM customers_candidates WHERE phone IS NULL",
    "rule_metrics": f"WITH {GAPS} " + _metrics("gaps", ORDER_RULES),
    "rule_metrics_by_event_type": f"WITH {CHANGES} " + _metrics("changes", EVENT_RULES, "event_type"),
    "enforce_fail_clean": f"WITH {ORDERS} SELECT status_std, count(*) AS n_rows FROM orders_candidates GROUP BY 1",
    "customer_order_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "customer_order_summary_null_violation": f"""WITH {CUSTOMERS}, {ORDERS},
        strict_customers AS (SELECT * FROM customers_candidates WHERE email_std LIKE '%@%.%'),
        strict_orders AS (SELECT * FROM orders_candidates WHERE amount > 0),
        {_summary_sql("strict_customers", "strict_orders")} SELECT * FROM summary""",
    "part_supplier_summary": """
        SELECT s_suppkey AS supplier_id, s_name, coalesce(line_count, 0) AS line_count, returned_value, last_ship_date
        FROM supplier LEFT JOIN (
          SELECT l_suppkey, count(l_orderkey) AS line_count,
                 CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END)
                      AS DECIMAL(22,2)) AS returned_value,
                 max(l_shipdate) AS last_ship_date
          FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey""",
    "order_totals_incremental": f"""WITH {ORDERS}
        SELECT customer_id, count(order_id) AS order_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount,
               max(order_date) AS last_order_date FROM orders_candidates GROUP BY 1""",
    "audit_silver_customers": f"WITH {CUSTOMERS_AUDIT} SELECT {RUN_LOG} FROM silver_log",
    "audit_silver_orders": f"WITH {ORDERS_AUDIT} SELECT {RUN_LOG} FROM silver_log",
    "audit_contract_orders": f"""WITH {ORDERS_CONTRACT_AUDIT}
        SELECT run_id, 'orders_silver' AS table_name, check_name, status, actual_value, expected_value, checked_at
        FROM silver_log""",
    "audit_gold": f"WITH {SUMMARY_AUDIT} SELECT {CONTRACT_ROWS} FROM summary_log",
    "audit_gold_from_footers": f"WITH {SUMMARY_AUDIT} SELECT {CONTRACT_ROWS} FROM summary_log",
    "audit_gold_run_log": f"WITH {SUMMARY_AUDIT} SELECT {RUN_LOG} FROM summary_log",
    "audit_contract_schema": f"""WITH {GAPS}
        SELECT 'r3' AS run_id, 'orders_silver' AS table_name, t.*, TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM (
          SELECT 'column_types' AS check_name, 'PASS' AS status, declared AS actual_value, declared AS expected_value
          FROM (SELECT 'order_id string, customer_id string, amount decimal(10,2), order_date timestamp, '
                       || 'status_std string, _source_file string, _ingested_at timestamp' AS declared)
          UNION ALL SELECT 'non_nullable_columns', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS VARCHAR), '0'
          FROM (SELECT count(*) FILTER (order_id IS NULL) + count(*) FILTER (customer_id IS NULL)
                       + count(*) FILTER (_ingested_at IS NULL) AS n FROM gaps)) t""",
    "audit_contract_violations": """
        SELECT 'r4' AS run_id, 'lineitem' AS table_name, t.*, TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM (
          SELECT 'columns' AS check_name, 'FAIL' AS status,
                 '[' || (SELECT string_agg('''' || column_name || '''', ', ' ORDER BY column_name)
                         FROM (DESCRIBE lineitem)) || ']' AS actual_value,
                 '[''l_batch'', ''l_orderkey'']' AS expected_value
          UNION ALL SELECT 'batch_set', 'FAIL', 'absent', 'present'
          UNION ALL SELECT 'discount_sign', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS VARCHAR), '0'
          FROM (SELECT count(*) FILTER (l_discount - 0.05::DOUBLE < 0) AS n FROM lineitem)
          UNION ALL SELECT 'one_line_per_order', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CAST(n AS VARCHAR), '0'
          FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))
          UNION ALL SELECT 'column_types', 'FAIL', 'l_orderkey bigint', 'l_orderkey int, l_shipdate timestamp') t""",
    "audit_orphans": f"""WITH {CUSTOMERS}, {ORDERS}
        SELECT 'r5' AS run_id, 'orders_silver' AS table_name, check_name,
               CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(n AS VARCHAR) AS actual_value,
               '0' AS expected_value, TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM (
          SELECT 'no_orphan_keys' AS check_name, count(*) AS n FROM orders_kept o
          WHERE NOT EXISTS (SELECT 1 FROM customers_kept c WHERE c.customer_id = o.customer_id)
          UNION ALL SELECT 'unique_key', count(*) FROM
            (SELECT 1 FROM orders_kept GROUP BY order_id HAVING count(*) > 1))""",
    "audit_summary": f"""WITH {SUMMARY_AUDIT}, c AS (
          WITH {CUSTOMERS_AUDIT} SELECT run_id, status FROM silver_log),
        o AS (WITH {ORDERS_AUDIT} SELECT run_id, status FROM silver_log)
        SELECT run_id, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warned,
               count(*) FILTER (status = 'FAIL') AS failed,
               CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall
        FROM (SELECT run_id, status FROM summary_log UNION ALL SELECT * FROM c UNION ALL SELECT * FROM o) GROUP BY 1""",
    "reconcile_counts": f"""WITH {CUSTOMERS}, {ORDERS}
        SELECT table_name, expected_rows, actual_rows,
               CASE WHEN expected_rows = actual_rows THEN 'PASS' ELSE 'FAIL' END AS status FROM (
          SELECT 'customers_silver' AS table_name, (SELECT count(*) FROM customer WHERE c_custkey % 10 <> 3) AS expected_rows,
                 (SELECT count(*) FROM customers_kept) AS actual_rows
          UNION ALL SELECT 'customers_rejected', (SELECT count(*) FROM customer WHERE c_custkey % 10 = 3),
                           (SELECT count(*) FROM customers_bad)
          UNION ALL SELECT 'orders_silver', (SELECT count(*) FROM orders WHERE NOT (o_orderkey % 15 = 9 AND o_orderkey % 50 <> 11)),
                           (SELECT count(*) FROM orders_kept)
          UNION ALL SELECT 'orders_rejected', (SELECT count(*) FROM orders WHERE o_orderkey % 15 = 9 AND o_orderkey % 50 <> 11),
                           (SELECT count(*) FROM orders_bad))""",
    "event_log_latest_updates": f"WITH {EVENT_LOG} SELECT * FROM latest",
    "event_log_totals": f"WITH {EVENT_LOG} SELECT * FROM totals",
    "event_log_expectations": f"""WITH {EVENT_LOG}
        SELECT 'r6' AS run_id, pipeline_name, expectation_name AS check_name, 'expectation' AS check_type,
               CASE WHEN total_failed = 0 THEN 'PASS' ELSE 'WARN' END AS status,
               'flow=' || flow_name || ' passed=' || coalesce(CAST(total_passed AS VARCHAR), 'None')
                 || ' failed=' || coalesce(CAST(total_failed AS VARCHAR), 'None') AS message,
               TIMESTAMP '2024-01-31 12:00:00' AS checked_at FROM totals
        UNION ALL
        SELECT 'r6', pipeline_name, 'event_log_enrichment', 'expectation', 'WARN',
               'No update found in event_log — pipeline may not have run yet', TIMESTAMP '2024-01-31 12:00:00'
        FROM (SELECT DISTINCT pipeline_name FROM event_log) WHERE pipeline_name NOT IN (SELECT pipeline_name FROM latest)""",
    "run_outcome": f"WITH {RUNS} SELECT * FROM runs",
    "current_status": f"WITH {RUNS} SELECT *, {BOARD} FROM runs ORDER BY recorded_at DESC, job_run_id DESC LIMIT 1",
    "current_status_by_day": f"""WITH {RUNS} SELECT *, {BOARD} FROM runs
        QUALIFY row_number() OVER (PARTITION BY schema_name, CAST(recorded_at AS DATE)
                                   ORDER BY recorded_at DESC, job_run_id DESC) = 1""",
    "run_history": f"WITH {RUNS} SELECT * FROM runs",
    "check_history": f"WITH {CHECK_LOG} SELECT * FROM check_log",
    "contract_history": f"WITH {CONTRACT_LOG} SELECT * FROM contract_log",
    "latest_run_checks": f"""WITH {CHECK_LOG} SELECT pipeline_name, check_name, status, message, checked_at FROM check_log
        WHERE check_type = 'direct' AND run_id = (SELECT arg_max(run_id, (checked_at, run_id)) FROM check_log)""",
    "latest_run_checks_lexicographic": f"""WITH {CHECK_LOG}
        SELECT pipeline_name, check_name, status, message, checked_at FROM check_log
        WHERE check_type = 'direct' AND run_id = (SELECT max(run_id) FROM check_log)""",
    "latest_contract_checks": f"""WITH {CONTRACT_LOG}
        SELECT table_name, check_name, status, actual_value, expected_value, checked_at FROM contract_log
        WHERE checked_at = (SELECT max(checked_at) FROM contract_log)""",
    "all_direct_checks": f"""WITH {CHECK_LOG}
        SELECT pipeline_name, check_name, status, message, checked_at, run_id FROM check_log WHERE check_type = 'direct'""",
    "reliability_7d": f"""WITH {RUNS}
        SELECT count(*) FILTER (overall_status = 'SUCCESS') || ' / ' || count(*) || ' runs succeeded' AS reliability
        FROM runs WHERE started_at >= TIMESTAMP '2024-01-24 00:00:00'""",
    "last_success": f"""WITH {RUNS} SELECT max(completed_at) AS last_success_at FROM runs
        WHERE overall_status = 'SUCCESS' HAVING count(*) > 0""",
    "run_duration_series": f"""WITH {RUNS}
        SELECT completed_at, CAST(sum(duration_seconds) AS BIGINT) AS duration_seconds FROM runs GROUP BY 1""",
    "dataset_count": f'WITH {RUNS} SELECT count(*) AS "count" FROM runs',
    "quality_trend": f"""WITH {CHECK_LOG}
        SELECT CAST(checked_at AS DATE) AS day, check_name, count(*) FILTER (status = 'PASS') AS passed,
               count(*) FILTER (status = 'WARN') AS warned, count(*) FILTER (status = 'FAIL') AS failed
        FROM check_log GROUP BY 1, 2""",
    "backfill_dedup": f"""WITH {CHANGES}
        SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value FROM changes""",
    "backfill_drop_duplicates": f"WITH {CHANGES} SELECT * FROM changes",
    "scd1_events": f"SELECT * FROM ({LATEST_STATE}) WHERE event_type <> 'error'",
    "scd1_incremental": f"SELECT * FROM ({LATEST_STATE}) WHERE event_type <> 'error'",
    "scd2_events": f"WITH {VERSIONS} SELECT * FROM versions WHERE event_type <> 'error'",
    "scd2_hot_key": """
        WITH changes AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS user_id,
                                ts, event_id, event_type, value FROM events)
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS "__END_AT", ts AS "__START_AT" FROM changes""",
    "scd2_active": f"""WITH {VERSIONS} SELECT * FROM versions WHERE event_type <> 'error' AND "__END_AT" IS NULL""",
    "snapshot_diff": """
        WITH before AS (SELECT CASE WHEN o_orderkey % 17 = 3 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 4 THEN 'X' ELSE o_orderstatus END AS st,
                               CASE WHEN o_orderkey % 29 <> 6 THEN o_totalprice END AS price
                        FROM orders),
        after AS (SELECT CASE WHEN o_orderkey % 19 = 5 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey,
                         o_orderstatus AS st, o_totalprice AS price FROM orders)
        SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'I' WHEN a.o_orderkey IS NULL THEN 'D'
                    WHEN b.o_custkey IS DISTINCT FROM a.o_custkey OR b.st IS DISTINCT FROM a.st
                      OR b.price IS DISTINCT FROM a.price THEN 'U' ELSE 'N' END AS change
        FROM before b FULL JOIN after a ON b.o_orderkey = a.o_orderkey""",
    "cdc_quality_split": """
        SELECT user_id, ts, event_id, event_type, value FROM events WHERE value > 5 AND event_type <> 'error'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "additive_schema": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "fixed_schema": "SELECT o_orderkey, o_orderstatus FROM orders",
    "orphan_orders": f"""WITH {CUSTOMERS}, {ORDERS}
        SELECT customer_id, count(*) AS order_rows FROM orders_kept
        WHERE customer_id NOT IN (SELECT customer_id FROM customers_kept) GROUP BY 1""",
    "column_rename_window": f"""WITH {SUMMARY}
        SELECT *, total_amount AS order_value, region AS sales_region FROM summary""",
    "stream_orders_medallion": f"""WITH {ORDERS}
        SELECT *, CASE WHEN amount <= 0 THEN 'positive_amount' END AS rejection_reason,
               CASE WHEN amount <= 0 THEN 'business_invalid' END AS rejection_severity,
               CASE WHEN amount <= 0 THEN 'rejected' ELSE 'silver' END AS destination FROM orders_candidates""",
    "stream_csv_ingest": ORDERS_LANDED,
    "batch_csv_ingest": ORDERS_LANDED,
    "summary_versioned_refresh": f"WITH {SUMMARY} SELECT * FROM summary",
    "summary_full_refresh": f"WITH {SUMMARY} SELECT * FROM summary",
    "run_outcome_one_hour": f"""WITH {RUNS.replace("last_at + to_seconds(run % 3600) AS recorded_at", HOUR_RECORDED).replace(
        "         started_at, 'https", f"         {HOUR_STARTED} AS started_at, 'https").replace(
        "'event ' || event_id AS message, ts AS checked_at", "'event ' || event_id AS message, " + _one_hour("ts") + " AS checked_at")}
        SELECT * FROM runs""",
    "latest_run_checks_by_day": f"""WITH {CHECK_LOG}
        SELECT pipeline_name, check_name, status, message, checked_at FROM check_log
        WHERE check_type = 'direct' AND date_trunc('hour', checked_at) = (SELECT date_trunc('hour', max(checked_at)) FROM check_log)""",
    "latest_contract_checks_by_day": f"""WITH {CONTRACT_LOG}
        SELECT table_name, check_name, status, actual_value, expected_value, checked_at FROM contract_log
        WHERE checked_at = (SELECT max(checked_at) FROM contract_log)""",
    "reliability_7d_by_day": f"""WITH {RUNS}
        SELECT count(*) FILTER (overall_status = 'SUCCESS') || ' / ' || count(*) || ' runs succeeded' AS reliability
        FROM runs WHERE started_at >= TIMESTAMP '2024-01-24 00:00:00'""",
    "log_roundtrip": f"WITH {CHECK_LOG} SELECT * FROM check_log WHERE status <> 'FAIL'",
    "gate_decision": f"""WITH {CHECK_LOG}
        SELECT run_id, count(*) FILTER (status = 'FAIL') = 0 AS passes, count(*) FILTER (status = 'FAIL') AS failed
        FROM check_log WHERE check_type = 'direct' GROUP BY 1""",
    "board_from_views": f"""WITH {RUNS}
        SELECT *, CASE WHEN overall_status IN ('FAILED', 'WARNING') THEN overall_status
                       WHEN overall_status = 'SUCCESS' THEN 'STALE' ELSE 'UNKNOWN' END AS dashboard_status
        FROM runs ORDER BY recorded_at DESC, job_run_id DESC LIMIT 1""",
    "latest_run_checks_view": f"""WITH {CHECK_LOG}
        SELECT pipeline_name, check_name, status, message, checked_at FROM check_log
        WHERE check_type = 'direct' AND date_trunc('hour', checked_at) = (SELECT date_trunc('hour', max(checked_at)) FROM check_log)""",
    "latest_contract_checks_view": f"""WITH {CONTRACT_LOG}
        SELECT table_name, check_name, status, actual_value, expected_value, checked_at FROM contract_log
        WHERE checked_at = (SELECT max(checked_at) FROM contract_log)""",
    "direct_checks_view": f"""WITH {CHECK_LOG}
        SELECT pipeline_name, check_name, status, message, checked_at, run_id FROM check_log WHERE check_type = 'direct'""",
    "last_success_view": f"""WITH {RUNS} SELECT max(completed_at) AS last_success_at FROM runs
        WHERE overall_status = 'SUCCESS' HAVING count(*) > 0""",
    "published_silver": f"""WITH {ORDERS}
        SELECT *, CAST(NULL AS VARCHAR) AS rejection_reason, CAST(NULL AS VARCHAR) AS rejection_severity, 'orders_silver' AS table_name
        FROM orders_kept UNION ALL SELECT *, 'orders_rejected' FROM orders_bad""",
    "event_times_from_millis": "SELECT event_id, date_trunc('millisecond', ts) AS at FROM events",
    "scd2_hot_time": """
        WITH changes AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS user_id,
                                CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-01-10 00:00:00' ELSE ts END AS ts,
                                event_id, event_type, value FROM events)
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS "__END_AT", ts AS "__START_AT" FROM changes""",
    "scd2_incremental": f"WITH {VERSIONS} SELECT * FROM versions WHERE event_type <> 'error'",
    "scd1_buckets": f"SELECT * FROM ({LATEST_STATE}) WHERE event_type <> 'error'",
    "snapshot_delta": f"""WITH {SNAPSHOTS}
        SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, a.o_custkey, a.o_orderstatus, a.o_totalprice,
               CASE WHEN b.o_orderkey IS NULL THEN 'I' WHEN a.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS change
        FROM before b FULL JOIN after a ON b.o_orderkey = a.o_orderkey
        WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR (b.o_custkey, b.o_orderstatus, b.o_totalprice)
              IS DISTINCT FROM (a.o_custkey, a.o_orderstatus, a.o_totalprice)""",
    "snapshot_apply": f"WITH {SNAPSHOTS} SELECT * FROM after",
    "snapshot_as_of": f"WITH {SNAPSHOTS} SELECT * FROM between_",
    "merged_schema_read": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN o_custkey + 0.5::DOUBLE ELSE o_custkey::DOUBLE END AS o_custkey,
               CAST(CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_totalprice AS DECIMAL(14,4))
                         ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS DECIMAL(14,4)) AS price,
               CASE WHEN o_orderkey % 3 = 2 THEN o_orderdate ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS ordered,
               CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "landing_path_ingest": ORDERS_LANDED.replace("'orders_landing' AS", "'shop/dev/orders_raw' AS"),
    "stream_two_deliveries": f"""WITH {ORDERS}
        SELECT order_id, customer_id, amount, CAST(1 + CAST(order_id AS BIGINT) % 2 AS INTEGER) AS delivery,
               CASE WHEN amount <= 0 THEN 'rejected' ELSE 'silver' END AS destination FROM orders_candidates""",
    "event_log_from_stream": f"""WITH {ORDERS},
        late AS (SELECT * FROM orders_candidates WHERE CAST(order_id AS BIGINT) % 2 = 1),
        counted AS ({_metrics("late", ORDER_RULES)})
        SELECT 'r7' AS run_id, 'orders_pipeline' AS pipeline_name, rule AS check_name, 'expectation' AS check_type,
               CASE WHEN failed = 0 THEN 'PASS' ELSE 'WARN' END AS status,
               'flow=orders_silver passed=' || passed || ' failed=' || failed AS message,
               TIMESTAMP '2001-08-01 18:00:00' AS checked_at FROM counted""",
}
