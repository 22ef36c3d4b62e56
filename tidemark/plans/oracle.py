"""DuckDB oracle SQL for the registered queries.

Each entry is a complete query over the driver's tables: a shared prelude re-states the
test-data adapter and the derived tables as CTEs (DuckDB inlines the ones a query does not
use), then a final SELECT gives the expected result with the same column names and types.

Exactness notes: money sums are cast to DECIMAL(20,2) (Spark's SUM type); integer sums to
BIGINT; decimal averages use integer cents with explicit half-up rounding, because DuckDB
divides decimals in DOUBLE.
"""

from __future__ import annotations

from tidemark.functions import rules
from tidemark.functions.exprs import slot_pick_sql
from tidemark.operators.analytics import FEEDS
from tidemark.sources import testdata as td

NOW = "2024-01-31 00:00:00"


def avg_half_up(total: str, count: str, precision: int = 20) -> str:
    """CAST(total / count AS DECIMAL(p,2)) with HALF_UP, computed on integer cents."""
    cents = f"CAST(({total}) * 100 AS BIGINT)"
    return (f"CAST(CAST((2 * {cents} + ({count})) // (2 * ({count})) AS DECIMAL(18,0)) * 0.01 "
            f"AS DECIMAL({precision},2))")


def pct_half_up(part: str, count: str) -> str:
    """CAST(part / count * 100 AS DECIMAL(5,2)) with HALF_UP."""
    return (f"CAST(CAST((20000 * ({part}) + ({count})) // (2 * ({count})) AS DECIMAL(18,0)) "
            f"* 0.01 AS DECIMAL(5,2))")


def _tier_sql(col: str) -> str:
    return slot_pick_sql(f"{col} % 10", [("BRONZE", 4), ("SILVER", 3), ("GOLD", 2), ("PLATINUM", 1)])


def bucket(width: str, col: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width}', {col})"


def revenue_cte(width: str) -> str:
    b = bucket(width, "o.event_time")
    return f"""
  SELECT strftime({b}, '%Y%m%d') AS window_day, {b} AS window_start,
         {b} + INTERVAL '{width}' AS window_end, p.category,
         COUNT(*) AS total_orders, CAST(SUM(o.order_amount) AS DECIMAL(20,2)) AS total_revenue,
         CAST(SUM(CASE WHEN o.payment_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_payments,
         {avg_half_up('SUM(o.order_amount)', 'COUNT(*)')} AS avg_order_value
  FROM orders_raw o LEFT JOIN product_catalog p ON o.product_id = p.product_id
  GROUP BY 1, 2, 3, 4"""


def prelude() -> str:
    r = rules
    return f"""
WITH ev AS (SELECT * FROM events),
orders_raw AS (
  SELECT strftime(date_trunc('milliseconds', ts), '%Y%m%d') AS event_day,
         printf('ORD-%010d', event_id) AS order_id,
         CASE WHEN event_id % {td.CUSTOMER_MISS} = 0 THEN printf('CUS-X%08d', user_id) ELSE printf('CUS-%08d', user_id) END AS customer_id,
         CASE WHEN event_id % {td.PRODUCT_MISS} = 0 THEN printf('SKU-X%06d', event_id // {td.ORDERS_PER_PRODUCT})
              ELSE printf('SKU-%06d', event_id // {td.ORDERS_PER_PRODUCT}) END AS product_id,
         CAST(CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(10,0)) * {td.AMOUNT_FACTOR} AS DECIMAL(10,2)) AS order_amount,
         CAST(1 + event_id % 3 AS INTEGER) AS quantity,
         {slot_pick_sql('event_id % 12', r.PAYMENT_STATUS)} AS payment_status,
         {slot_pick_sql('(event_id // 5) % 10', r.ORDER_STATUS)} AS order_status,
         {slot_pick_sql('(event_id // 7) % 20', r.PAYMENT_METHOD)} AS payment_method,
         {slot_pick_sql('(event_id // 12) % 10', r.DEVICE_TYPE)} AS device_type,
         {slot_pick_sql('(event_id // 3) % 20', r.ORDER_CITY)} AS city,
         date_trunc('milliseconds', ts) AS event_time
  FROM ev),
product_catalog AS (
  SELECT printf('SKU-%06d', p_partkey) AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(p_size * 10 AS INTEGER) AS inventory_count,
         TIMESTAMP '{r.PRODUCT_UPDATED_AT}' AS updated_at
  FROM part),
customer_profile AS (
  SELECT printf('CUS-%08d', c_custkey) AS customer_id, c_name AS customer_name,
         {slot_pick_sql('c_custkey % 20', r.ORDER_CITY)} AS city,
         {_tier_sql('c_custkey')} AS loyalty_tier,
         CAST(DATE '{td.SIGNUP_BASE}' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         CAST(DATE '{td.SIGNUP_BASE}' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) + INTERVAL '10 hours 30 minutes' AS updated_at
  FROM customer),
orders_enriched AS (
  SELECT o.event_day, o.order_id, o.customer_id, c.customer_name, c.loyalty_tier, o.product_id,
         p.product_name, p.brand, p.category, o.city, o.order_amount, o.quantity, o.payment_status,
         o.order_status, o.payment_method, o.device_type, o.event_time
  FROM orders_raw o LEFT JOIN customer_profile c ON o.customer_id = c.customer_id
  LEFT JOIN product_catalog p ON o.product_id = p.product_id),
revenue_5min AS ({revenue_cte('5 minutes')}),
city_revenue_5min AS (
  SELECT strftime({bucket('5 minutes')}, '%Y%m%d') AS window_day, {bucket('5 minutes')} AS window_start,
         {bucket('5 minutes')} + INTERVAL '5 minutes' AS window_end, city,
         COUNT(*) AS total_orders, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_revenue
  FROM orders_raw GROUP BY 1, 2, 3, 4),
kpi_agg AS (
  SELECT {bucket('1 minute')} + INTERVAL '1 minute' AS updated_at, COUNT(*) AS n,
         SUM(order_amount) AS s, SUM(CASE WHEN payment_status = 'FAILED' THEN 1 ELSE 0 END) AS f
  FROM orders_raw GROUP BY 1),
kpis_1min AS (
  SELECT 'total_orders_1min' AS metric_key, CAST(n AS DOUBLE) AS metric_value, updated_at FROM kpi_agg
  UNION ALL SELECT 'total_revenue_1min', CAST(s AS DOUBLE), updated_at FROM kpi_agg
  UNION ALL SELECT 'failed_payments_1min', CAST(f AS DOUBLE), updated_at FROM kpi_agg
  UNION ALL SELECT 'avg_order_value_1min', CAST(s AS DOUBLE) / n, updated_at FROM kpi_agg
  UNION ALL SELECT 'events_per_second', CAST(n AS DOUBLE) / 60.0, updated_at FROM kpi_agg),
high_value_orders AS (
  SELECT order_id, customer_id, customer_name, loyalty_tier, order_amount, city, category, event_time
  FROM orders_enriched WHERE order_amount >= {r.HIGH_VALUE_THRESHOLD}),
suspicious_orders AS (
  SELECT order_id, customer_id, order_amount, payment_status, payment_method, device_type, city,
         CASE {' '.join(f"WHEN {c} THEN '{lbl}'" for c, lbl in r.SUSPICIOUS_RULES)} END AS reason,
         event_time
  FROM orders_enriched WHERE {' OR '.join(f'({c})' for c, _ in r.SUSPICIOUS_RULES)})
"""


def _q(body: str) -> str:
    return prelude() + body


def _by_key(key: str) -> str:
    return f"""
SELECT {key}, COUNT(*) AS total_orders, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_revenue,
       {avg_half_up('SUM(order_amount)', 'COUNT(*)', 10)} AS avg_order_value
FROM orders_enriched GROUP BY {key}"""


def _rev_orders(key: str, table: str = "orders_enriched") -> str:
    return f"""
SELECT {key}, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS revenue, COUNT(order_amount) AS orders
FROM {table} GROUP BY {key}"""


def _rollup(key: str, table: str) -> str:
    return f"""
SELECT {key}, CAST(SUM(total_revenue) AS DECIMAL(20,2)) AS revenue,
       CAST(SUM(total_orders) AS BIGINT) AS orders FROM {table} GROUP BY {key}"""


def _counts(key: str, table: str) -> str:
    return f"SELECT {key}, COUNT(*) AS orders FROM {table} GROUP BY {key}"


TIER_RANK_SQL = ("CASE " + " ".join(f"WHEN loyalty_tier = '{t}' THEN {i}"
                                    for i, t in enumerate(rules.TIER_ORDER, start=1))
                 + f" ELSE {len(rules.TIER_ORDER) + 1} END")

LATEST_COLS = ("order_id, customer_name, product_name, category, city, order_amount, "
               "payment_status, payment_method, device_type, loyalty_tier, event_time")

ORACLE: dict[str, str] = {
    "orders_raw": _q("SELECT * FROM orders_raw"),
    "orders_enriched": _q("SELECT * FROM orders_enriched"),
    "enriched_unknown": _q("""
SELECT event_day, order_id, customer_id, coalesce(customer_name, 'UNKNOWN') AS customer_name,
       coalesce(loyalty_tier, 'UNKNOWN') AS loyalty_tier, product_id,
       coalesce(product_name, 'UNKNOWN') AS product_name, coalesce(brand, 'UNKNOWN') AS brand,
       coalesce(category, 'UNKNOWN') AS category, city, order_amount, quantity, payment_status,
       order_status, payment_method, device_type, event_time
FROM orders_enriched"""),
    "revenue_5min": _q("SELECT * FROM revenue_5min"),
    "city_revenue_5min": _q("SELECT * FROM city_revenue_5min"),
    "revenue_15min": _q(f"SELECT * FROM ({revenue_cte('15 minutes')})"),
    "kpis_1min": _q("SELECT * FROM kpis_1min"),
    "high_value_orders": _q("SELECT * FROM high_value_orders"),
    "suspicious_orders": _q("SELECT * FROM suspicious_orders"),
    "fraud_reasons": _q(_counts("reason", "suspicious_orders")),
    "failed_payments": _q("""
SELECT order_id, customer_name, order_amount, payment_method, device_type, city, event_time
FROM orders_enriched WHERE payment_status = 'FAILED'"""),
    "latest_orders": _q(f"""
SELECT {LATEST_COLS} FROM orders_enriched ORDER BY event_time DESC, order_id LIMIT 50"""),
    "latest_category_windows": _q("""
SELECT window_start, window_end, category, total_orders, total_revenue, failed_payments, avg_order_value
FROM revenue_5min ORDER BY window_end DESC, total_revenue DESC, category ASC NULLS FIRST LIMIT 30"""),
    "latest_city_windows": _q("""
SELECT window_start, window_end, city, total_orders, total_revenue
FROM city_revenue_5min ORDER BY window_end DESC, total_revenue DESC, city ASC NULLS FIRST LIMIT 30"""),
    "revenue_by_tier": _q(_by_key("loyalty_tier")),
    "revenue_by_device": _q(_by_key("device_type")),
    "tier_ordered": _q(f"SELECT *, {TIER_RANK_SQL} AS tier_rank FROM ({_rev_orders('loyalty_tier')})"),
    "top_products": _q("""
SELECT product_name, brand, category, COUNT(*) AS units_sold,
       CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_revenue
FROM orders_enriched GROUP BY product_name, brand, category
ORDER BY total_revenue DESC, product_name ASC NULLS FIRST, brand ASC NULLS FIRST,
         category ASC NULLS FIRST LIMIT 15"""),
    "top_products_panel": _q("""
SELECT product_name, category, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS revenue,
       COUNT(order_amount) AS orders
FROM orders_enriched GROUP BY product_name, category
ORDER BY revenue DESC, product_name ASC NULLS FIRST, category ASC NULLS FIRST LIMIT 15"""),
    "failure_rate": _q(f"""
SELECT payment_method, COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN payment_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
       {pct_half_up("SUM(CASE WHEN payment_status = 'FAILED' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS failure_rate_pct
FROM orders_enriched GROUP BY payment_method"""),
    "revenue_by_payment": _q(_rev_orders("payment_method")),
    "inventory_risk": _q("""
SELECT product_id, product_name, category, brand, inventory_count
FROM product_catalog WHERE inventory_count < 100"""),
    "inventory_board": _q("""
SELECT product_id, product_name, category, brand, unit_price, inventory_count,
       inventory_count < 100 AS low_stock
FROM product_catalog ORDER BY inventory_count, product_id LIMIT 50"""),
    "customer_history": _q(f"""
SELECT customer_id, customer_name, loyalty_tier, city, COUNT(*) AS total_orders,
       CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_spent,
       {avg_half_up('SUM(order_amount)', 'COUNT(*)', 10)} AS avg_order_value
FROM orders_enriched GROUP BY customer_id, customer_name, loyalty_tier, city
ORDER BY total_spent DESC, customer_id ASC NULLS FIRST, customer_name ASC NULLS FIRST,
         loyalty_tier ASC NULLS FIRST, city ASC NULLS FIRST LIMIT 20"""),
    "table_counts": _q("""
SELECT 'orders_raw' AS table_name, COUNT(*) AS row_count FROM orders_raw
UNION ALL SELECT 'orders_enriched', COUNT(*) FROM orders_enriched
UNION ALL SELECT 'high_value_orders', COUNT(*) FROM high_value_orders
UNION ALL SELECT 'suspicious_orders', COUNT(*) FROM suspicious_orders
UNION ALL SELECT 'customer_profile', COUNT(*) FROM customer_profile
UNION ALL SELECT 'product_catalog', COUNT(*) FROM product_catalog"""),
    "category_rollup": _q(_rollup("category", "revenue_5min")),
    "city_rollup": _q(_rollup("city", "city_revenue_5min")),
    "payment_status_counts": _q(_counts("payment_status", "orders_enriched")),
    "device_counts": _q(_counts("device_type", "orders_enriched")),
    "city_since": _q(f"""
SELECT city, CAST(SUM(total_revenue) AS DECIMAL(20,2)) AS total_revenue,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders
FROM city_revenue_5min WHERE window_start >= TIMESTAMP '{NOW}' - INTERVAL '7 days' GROUP BY city"""),
    "daily_revenue": _q("""
SELECT CAST(event_time AS DATE) AS order_date, category, COUNT(*) AS total_orders,
       CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_revenue
FROM orders_enriched GROUP BY 1, 2"""),
    "recent_windows": _q(f"""
SELECT * FROM revenue_5min WHERE window_start >= TIMESTAMP '{NOW}' - INTERVAL '6 hours'"""),
    "raw_range": _q("""
SELECT * FROM orders_raw
WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-12 12:00:00'"""),
    "point_lookup": _q("SELECT * FROM orders_enriched WHERE order_id = 'ORD-0000000042'"),
    "top_alerts": _q("""
SELECT * FROM high_value_orders ORDER BY order_amount DESC, order_id LIMIT 30"""),
    "timeline": _q("SELECT window_start, category, total_revenue FROM revenue_5min"),
    "recent_raw": _q("SELECT * FROM orders_raw ORDER BY event_time DESC, order_id LIMIT 100"),
    "unknown_products": _q("""
SELECT product_id, COUNT(*) AS missing_orders FROM orders_raw o
WHERE NOT EXISTS (SELECT 1 FROM product_catalog p WHERE p.product_id = o.product_id)
GROUP BY product_id"""),
    "city_vs_category": _q("""
SELECT c.window_start, c.window_end, c.city, c.total_revenue AS city_revenue,
       c.total_orders AS city_orders, w.window_revenue, w.window_orders, w.categories,
       CAST(c.total_revenue AS DOUBLE) / CAST(w.window_revenue AS DOUBLE) AS city_share
FROM city_revenue_5min c JOIN (
  SELECT window_start, window_end, CAST(SUM(total_revenue) AS DECIMAL(20,2)) AS window_revenue,
         CAST(SUM(total_orders) AS BIGINT) AS window_orders, COUNT(*) AS categories
  FROM revenue_5min GROUP BY 1, 2) w
ON c.window_start = w.window_start AND c.window_end = w.window_end"""),
    "failed_rate": _q("""
SELECT category, CAST(SUM(failed_payments) AS BIGINT) AS failed_payments,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(failed_payments) AS DOUBLE) / CAST(SUM(total_orders) AS DOUBLE) AS failed_rate
FROM revenue_5min GROUP BY category"""),
    "alert_rate": _q(f"""
SELECT {bucket('5 minutes')} AS window_start, {bucket('5 minutes')} + INTERVAL '5 minutes' AS window_end,
       alert_type, COUNT(*) AS alerts
FROM (SELECT 'high_value_orders' AS alert_type, event_time FROM high_value_orders
      UNION ALL SELECT 'suspicious_orders', event_time FROM suspicious_orders)
GROUP BY 1, 2, 3"""),
    "tier_distribution": _q("SELECT loyalty_tier, COUNT(*) AS customers FROM customer_profile GROUP BY 1"),
    "signup_trend": _q("""
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS signup_month, COUNT(*) AS customers
FROM customer_profile GROUP BY 1"""),
    "series": _q("""
SELECT window_start, category, avg_order_value,
       CAST(failed_payments AS DOUBLE) / CAST(total_orders AS DOUBLE) AS failed_rate
FROM revenue_5min"""),
}


# --- upsert fold, KPI board, quality, lifecycle, observability ------------------------------

DQ_CUTOFF = "2024-01-30 00:00:00"   # NOW - 1 day
RAW_COLS = ["event_day", "order_id", "customer_id", "product_id", "order_amount", "quantity",
            "payment_status", "order_status", "payment_method", "device_type", "city", "event_time"]
_statuses = ", ".join(f"'{s}'" for s in rules.VALID_PAYMENT_STATUS)
TAGGED = f"""
, tagged AS (
  SELECT *, CASE WHEN NOT coalesce(order_amount > 0, false) THEN 'INVALID_AMOUNT'
                 WHEN NOT coalesce(event_time > TIMESTAMP '{DQ_CUTOFF}', false) THEN 'STALE_EVENT'
                 WHEN NOT coalesce(payment_status IN ({_statuses}), false) THEN 'INVALID_PAYMENT_STATUS'
            END AS error_type,
            CASE WHEN NOT coalesce(order_amount > 0, false) THEN 'order_amount missing or not > 0'
                 WHEN NOT coalesce(event_time > TIMESTAMP '{DQ_CUTOFF}', false) THEN 'event_time not within 1 day of processing time'
                 WHEN NOT coalesce(payment_status IN ({_statuses}), false) THEN 'payment_status not in ({", ".join(rules.VALID_PAYMENT_STATUS)})'
            END AS error_message
  FROM orders_raw)
"""


def _payload_sql() -> str:
    parts = []
    for c in RAW_COLS:
        v = "strftime(event_time, '%Y-%m-%d %H:%M:%S.%g')" if c == "event_time" else f"CAST({c} AS VARCHAR)"
        parts.append(f"'{c}', {v}")
    return f"json_object({', '.join(parts)})"


SAMPLES = """
, samples AS (
  SELECT 'ingestion_latency' AS metric, event_time AS ts,
         CAST(epoch_us(time_bucket(INTERVAL '5 seconds', event_time) + INTERVAL '5 seconds')
                    - epoch_us(event_time) AS DOUBLE) / 1000000.0 AS value
  FROM orders_raw)
"""

FAILED_RATE_ALERTS = f"""
, pw AS (SELECT window_start, window_end,
                CAST(SUM(failed_payments) AS DOUBLE) / CAST(SUM(total_orders) AS DOUBLE) AS failed_rate
         FROM revenue_5min GROUP BY 1, 2)
SELECT a.window_start, a.window_end, a.failed_rate FROM pw a
JOIN pw b ON b.window_start = a.window_start - INTERVAL '5 minutes'
WHERE a.failed_rate > {rules.FAILED_RATE_ALERT} AND b.failed_rate > {rules.FAILED_RATE_ALERT}"""

SPIKE_ALERTS = f"""
, c AS (SELECT {bucket('5 minutes')} AS window_start, {bucket('5 minutes')} + INTERVAL '5 minutes' AS window_end,
               COUNT(*) AS alerts FROM suspicious_orders GROUP BY 1, 2),
b AS (SELECT c.window_start, CAST(SUM(p.alerts) AS DOUBLE) / CAST({rules.SPIKE_BASELINE_WINDOWS} AS DOUBLE) AS baseline
      FROM c JOIN c p ON p.window_start >= c.window_start - INTERVAL '{5 * rules.SPIKE_BASELINE_WINDOWS} minutes'
                     AND p.window_start < c.window_start
      GROUP BY 1)
SELECT c.window_start, c.window_end, c.alerts, b.baseline FROM c JOIN b ON c.window_start = b.window_start
WHERE b.baseline > 0 AND c.alerts > {rules.SPIKE_FACTOR} * b.baseline"""

_KEYS_VALUES = ", ".join(f"('{k}')" for k in [*rules.KPI_KEYS, "high_value_alerts", "suspicious_alerts"])
LATEST_KPIS = """
, latest_kpis AS (
  SELECT k.* FROM kpis_1min k JOIN (SELECT metric_key, MAX(updated_at) AS m FROM kpis_1min GROUP BY 1) x
  ON k.metric_key = x.metric_key AND k.updated_at = x.m)
"""

ORACLE.update({
    "kpis_latest": _q(LATEST_KPIS + "SELECT * FROM latest_kpis"),
    "kpi_board": _q(LATEST_KPIS + f"""
SELECT b.metric_key, coalesce(v.metric_value, 0.0) AS metric_value
FROM (VALUES {_KEYS_VALUES}) b(metric_key) LEFT JOIN (
  SELECT metric_key, metric_value FROM latest_kpis
  UNION ALL SELECT 'high_value_alerts', CAST(COUNT(*) AS DOUBLE) FROM high_value_orders
  UNION ALL SELECT 'suspicious_alerts', CAST(COUNT(*) AS DOUBLE) FROM suspicious_orders) v
ON b.metric_key = v.metric_key"""),
    "dedup_orders": _q("SELECT * FROM orders_raw"),
    "dq_valid": _q(TAGGED + f"""
SELECT {", ".join("CAST(least(greatest(quantity, 1), 100) AS INTEGER) AS quantity" if c == "quantity" else c for c in RAW_COLS)}
FROM tagged WHERE error_type IS NULL"""),
    "dq_errors": _q(TAGGED + f"""
SELECT order_id AS original_order_id, error_type, error_message, {_payload_sql()} AS raw_payload,
       TIMESTAMP '{NOW}' AS failed_at
FROM tagged WHERE error_type IS NOT NULL"""),
    "rejection_rate": _q(TAGGED + """
SELECT COUNT(*) AS total_rows, COUNT(error_type) AS rejected,
       CAST(SUM(CASE WHEN error_type = 'INVALID_AMOUNT' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_amount,
       CAST(SUM(CASE WHEN error_type = 'STALE_EVENT' THEN 1 ELSE 0 END) AS BIGINT) AS stale_event,
       CAST(SUM(CASE WHEN error_type = 'INVALID_PAYMENT_STATUS' THEN 1 ELSE 0 END) AS BIGINT) AS invalid_payment_status,
       CAST(COUNT(error_type) AS DOUBLE) / COUNT(*) AS rejection_rate
FROM tagged"""),
    "join_miss_rate": _q("""
SELECT COUNT(*) AS total_orders,
       CAST(SUM(CASE WHEN customer_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customer_misses,
       CAST(SUM(CASE WHEN product_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS product_misses,
       CAST(SUM(CASE WHEN customer_name IS NULL OR product_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS any_misses,
       CAST(SUM(CASE WHEN customer_name IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS customer_miss_rate,
       CAST(SUM(CASE WHEN product_name IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS product_miss_rate,
       CAST(SUM(CASE WHEN customer_name IS NULL OR product_name IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS join_miss_rate
FROM orders_enriched"""),
    "invariants": _q(f"""
SELECT check_name, violations, violations = 0 AS passed FROM (
  SELECT 'enriched_names_present' AS check_name,
         CAST(COUNT(*) FILTER (WHERE customer_name IS NULL OR product_name IS NULL) AS BIGINT) AS violations
  FROM orders_enriched
  UNION ALL SELECT 'high_value_threshold', CAST(COUNT(*) FILTER (WHERE order_amount < {rules.HIGH_VALUE_THRESHOLD}) AS BIGINT)
  FROM high_value_orders
  UNION ALL SELECT 'suspicious_reason_present', CAST(COUNT(*) FILTER (WHERE reason IS NULL) AS BIGINT)
  FROM suspicious_orders
  UNION ALL SELECT 'avg_electronics_gt_grocery',
         CAST(CASE WHEN avg(order_amount) FILTER (WHERE category = 'electronics') >
                        avg(order_amount) FILTER (WHERE category = 'grocery') THEN 0 ELSE 1 END AS BIGINT)
  FROM orders_enriched)"""),
    "masked_orders": _q("""
SELECT event_day, order_id, sha256(customer_id) AS customer_id,
       CASE WHEN customer_name IS NOT NULL THEN substr(customer_name, 1, 1) || '***' END AS customer_name,
       loyalty_tier, product_id, product_name, brand, category, city, order_amount, quantity,
       payment_status, order_status, payment_method, device_type, event_time
FROM orders_enriched"""),
    "retention_keep": _q("""
SELECT event_day, COUNT(*) AS row_count FROM orders_raw WHERE event_day >= '20240123' GROUP BY 1"""),
    "union_read": _q("""
SELECT category, COUNT(*) AS total_orders, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS total_revenue
FROM orders_enriched GROUP BY 1"""),
    "cold_read": _q("SELECT * FROM orders_raw WHERE event_day < '20240115'"),
    "cold_trend": _q("""
SELECT * FROM revenue_5min WHERE window_day < '20240115'
ORDER BY window_start, category ASC NULLS FIRST LIMIT 100"""),
    "purge_keep": _q("SELECT * FROM orders_enriched WHERE customer_id IS DISTINCT FROM 'CUS-00000007'"),
    "export_month": _q("SELECT * FROM revenue_5min WHERE strftime(window_start, '%Y-%m') = '2024-01'"),
    "alert_failed_rate": _q(FAILED_RATE_ALERTS),
    "alert_spike": _q(SPIKE_ALERTS),
    "input_rate": _q(f"""
SELECT {bucket('1 minute')} AS window_start, {bucket('1 minute')} + INTERVAL '1 minute' AS window_end,
       COUNT(*) AS events, CAST(COUNT(*) AS DOUBLE) / 60.0 AS events_per_second
FROM orders_raw GROUP BY 1, 2"""),
    "lag_seconds": _q(f"""
SELECT 'orders_raw' AS table_name, date_sub('second', MAX(event_time), TIMESTAMP '{NOW}') AS lag_seconds FROM orders_raw
UNION ALL SELECT 'orders_enriched', date_sub('second', MAX(event_time), TIMESTAMP '{NOW}') FROM orders_enriched
UNION ALL SELECT 'high_value_orders', date_sub('second', MAX(event_time), TIMESTAMP '{NOW}') FROM high_value_orders
UNION ALL SELECT 'suspicious_orders', date_sub('second', MAX(event_time), TIMESTAMP '{NOW}') FROM suspicious_orders"""),
    "freshness_seconds": _q(f"""
SELECT 'revenue_5min' AS table_name, date_sub('second', MAX(window_end), TIMESTAMP '{NOW}') AS freshness_seconds FROM revenue_5min
UNION ALL SELECT 'city_revenue_5min', date_sub('second', MAX(window_end), TIMESTAMP '{NOW}') FROM city_revenue_5min"""),
    "throughput_timeline": _q(f"""
SELECT {bucket('1 hour')} AS interval_start,
       date_sub('second', TIMESTAMP '2024-01-01 00:00:00', {bucket('1 hour')}) AS elapsed_seconds,
       COUNT(*) AS records, CAST(COUNT(*) AS DOUBLE) / 3600.0 AS events_per_second,
       CAST(SUM(COUNT(*)) OVER (ORDER BY {bucket('1 hour')} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_records
FROM orders_raw WHERE event_time >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2"""),
    "slo_report": _q(SAMPLES + f"""
, hist AS (SELECT metric, value, COUNT(*) AS n FROM samples GROUP BY 1, 2),
cum AS (SELECT *, SUM(n) OVER (PARTITION BY metric ORDER BY value ROWS UNBOUNDED PRECEDING) AS c,
               SUM(n) OVER (PARTITION BY metric) AS total FROM hist),
pct AS (SELECT metric, MIN(value) AS p_value FROM cum
        WHERE c >= CEIL(CAST(total AS DOUBLE) * CAST({rules.SLO_PERCENTILE} AS DOUBLE)) GROUP BY 1),
summ AS (SELECT metric, CAST(SUM(n) AS BIGINT) AS samples,
                CAST(SUM(CASE WHEN value < {rules.SLO_BURN[0][1]} THEN n ELSE 0 END) AS BIGINT) AS within,
                CAST({rules.SLO_BURN[0][1]} AS DOUBLE) AS objective FROM hist GROUP BY 1)
SELECT s.metric, s.samples, s.within, s.objective, p.p_value,
       CAST(s.within AS DOUBLE) / s.samples AS compliance, p.p_value < s.objective AS met
FROM summ s JOIN pct p ON s.metric = p.metric"""),
    "burn_rate": _q(SAMPLES + "".join(f"""
{'UNION ALL ' if i else ''}SELECT '{label}' AS burn_window, time_bucket(INTERVAL '{width}', ts) AS window_start,
       time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end, COUNT(*) AS samples,
       CAST(SUM(CASE WHEN value > {rules.SLO_BURN[0][1]} THEN 1 ELSE 0 END) AS BIGINT) AS bad,
       CAST(SUM(CASE WHEN value > {rules.SLO_BURN[0][1]} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS bad_share,
       CAST({limit} AS DOUBLE) AS threshold,
       CAST(SUM(CASE WHEN value > {rules.SLO_BURN[0][1]} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) > {limit} AS alert
FROM samples WHERE metric = 'ingestion_latency' GROUP BY 1, 2, 3"""
        for i, (label, width, limit) in enumerate([("fast_1h", "1 hour", rules.SLO_BURN[0][2]),
                                                   ("slow_6h", "6 hours", rules.SLO_BURN[0][3])]))),
    "validate_run": _q(f"""
, cnt AS (SELECT (SELECT COUNT(*) FROM orders_raw) AS r, (SELECT COUNT(*) FROM orders_enriched) AS e,
                 (SELECT COUNT(*) FROM high_value_orders) AS h, (SELECT COUNT(*) FROM suspicious_orders) AS s,
                 (SELECT date_sub('second', MIN(event_time), MAX(event_time)) FROM orders_raw) AS secs)
SELECT check_name, value, threshold,
       CASE WHEN check_name = 'enriched_ratio' THEN value > threshold ELSE value >= threshold END AS passed
FROM (
  SELECT 'throughput_events_per_second' AS check_name, CAST(r AS DOUBLE) / CAST(secs AS DOUBLE) AS value,
         CAST({rules.RUN_MIN_THROUGHPUT} AS DOUBLE) AS threshold FROM cnt
  UNION ALL SELECT 'enriched_ratio', CAST(e AS DOUBLE) / CAST(r AS DOUBLE), {rules.RUN_MIN_ENRICHED_RATIO} FROM cnt
  UNION ALL SELECT 'orders_raw_count', CAST(r AS DOUBLE), 1.0 FROM cnt
  UNION ALL SELECT 'orders_enriched_count', CAST(e AS DOUBLE), 1.0 FROM cnt
  UNION ALL SELECT 'high_value_orders_count', CAST(h AS DOUBLE), 1.0 FROM cnt
  UNION ALL SELECT 'suspicious_orders_count', CAST(s AS DOUBLE), 1.0 FROM cnt)"""),
})


# --- streaming (closed windows only: end <= max(event_time) - watermark) --------------------

CLOSED = "(SELECT MAX(event_time) - INTERVAL '5 seconds' FROM orders_raw)"

ORACLE.update({
    "stream_revenue_5min": _q(f"SELECT * FROM revenue_5min WHERE window_end <= {CLOSED}"),
    "stream_city_revenue_5min": _q(f"SELECT * FROM city_revenue_5min WHERE window_end <= {CLOSED}"),
    "stream_alerts": _q("""
SELECT 'high_value' AS alert_type, order_id, customer_id, order_amount, city, event_time,
       CAST(NULL AS VARCHAR) AS reason FROM high_value_orders
UNION ALL
SELECT 'suspicious', order_id, customer_id, order_amount, city, event_time, reason FROM suspicious_orders"""),
    "stream_kpis": _q(f"""
, closed AS (SELECT * FROM kpis_1min WHERE updated_at <= {CLOSED})
SELECT k.* FROM closed k JOIN (SELECT metric_key, MAX(updated_at) AS m FROM closed GROUP BY 1) x
ON k.metric_key = x.metric_key AND k.updated_at = x.m"""),
})

# --- chained windows: the wide or sliding window has to be closed -----------------------------

ORACLE.update({
    "stream_city_rollup": _q(f"""
SELECT {bucket('1 hour', 'window_start')} AS window_start, {bucket('1 hour', 'window_start')} + INTERVAL '1 hour' AS window_end, city,
       CAST(SUM(total_revenue) AS DECIMAL(20,2)) AS revenue, CAST(SUM(total_orders) AS BIGINT) AS orders, COUNT(*) AS windows
FROM city_revenue_5min WHERE {bucket('1 hour', 'window_start')} + INTERVAL '1 hour' <= {CLOSED} GROUP BY 1, 2, 3"""),
    "stream_category_rollup": _q(f"""
SELECT {bucket('1 hour', 'window_start')} AS window_start, {bucket('1 hour', 'window_start')} + INTERVAL '1 hour' AS window_end, category,
       CAST(SUM(total_revenue) AS DECIMAL(20,2)) AS revenue, CAST(SUM(total_orders) AS BIGINT) AS orders, COUNT(*) AS windows
FROM revenue_5min WHERE {bucket('1 hour', 'window_start')} + INTERVAL '1 hour' <= {CLOSED} GROUP BY 1, 2, 3"""),
    "stream_alert_rate": _q(f"""
, narrow AS (
  SELECT {bucket('1 minute')} AS m, 'high_value_orders' AS alert_type, COUNT(*) AS n FROM high_value_orders GROUP BY 1
  UNION ALL SELECT {bucket('1 minute')}, 'suspicious_orders', COUNT(*) FROM suspicious_orders GROUP BY 1)
SELECT {bucket('5 minutes', 'm')} AS window_start, {bucket('5 minutes', 'm')} + INTERVAL '5 minutes' AS window_end, alert_type,
       CAST(SUM(n) AS BIGINT) AS alerts, MAX(n) AS most
FROM narrow WHERE {bucket('5 minutes', 'm')} + INTERVAL '5 minutes' <= {CLOSED} GROUP BY 1, 2, 3"""),
    "stream_failed_rate_alerts": _q(f"{FAILED_RATE_ALERTS} AND a.window_end <= {CLOSED}"),
    "stream_spike_alerts": _q(f"{SPIKE_ALERTS} AND c.window_end <= {CLOSED}"),
})

ORACLE.update({
    "stored_lookup": ORACLE["point_lookup"],
    "live_purge": _q("""
SELECT event_day, COUNT(*) AS orders, COUNT(customer_id) AS with_customer
FROM orders_raw WHERE customer_id IS DISTINCT FROM 'CUS-00000007' GROUP BY 1"""),
})

ORACLE["stream_late_rows"] = _q(f"""
SELECT window_start, window_end, city, total_orders AS orders FROM city_revenue_5min WHERE window_end <= {CLOSED}""")

ORACLE["stream_dedup"] = _q("""
SELECT event_day, COUNT(*) AS orders, CAST(SUM(order_amount) AS DECIMAL(20,2)) AS revenue FROM orders_raw GROUP BY 1""")

_FEED = "SELECT {cols} FROM {table} ORDER BY {order} LIMIT {n}"

ORACLE.update({
    "log_range": ORACLE["raw_range"],
    "stored_recent_windows": ORACLE["recent_windows"],
    "stored_city_since": ORACLE["city_since"],
    "known_products": _q("""
SELECT event_day, COUNT(*) AS orders FROM orders_raw o
WHERE EXISTS (SELECT 1 FROM product_catalog p WHERE p.product_id = o.product_id) GROUP BY 1"""),
    "dq_rules": _q(f"""
, numbered AS (SELECT *, CAST(substr(order_id, 5) AS BIGINT) AS n FROM orders_raw),
faulty AS (
  SELECT event_time, CASE WHEN n % 11 = 0 THEN NULL WHEN n % 13 = 0 THEN 0 WHEN n % 17 = 0 THEN -order_amount ELSE order_amount END AS amount,
         CASE WHEN n % 7 = 0 THEN 'REFUNDED' WHEN n % 19 = 0 THEN NULL ELSE payment_status END AS status,
         CASE WHEN n % 3 = 0 THEN 500 WHEN n % 5 = 0 THEN -2 ELSE quantity END AS quantity
  FROM numbered),
judged AS (
  SELECT CASE WHEN amount IS NULL OR NOT amount > 0 THEN 'INVALID_AMOUNT'
              WHEN event_time IS NULL OR NOT event_time > TIMESTAMP '{NOW}' - INTERVAL '20 days' THEN 'STALE_EVENT'
              WHEN status IS NULL OR status NOT IN ('SUCCESS', 'FAILED', 'PENDING') THEN 'INVALID_PAYMENT_STATUS' END AS error_type,
         CAST(least(greatest(quantity, 1), 100) AS INTEGER) AS quantity
  FROM faulty)
SELECT error_type, COUNT(*) AS rows, CAST(SUM(quantity) AS BIGINT) AS units, MIN(quantity) AS least, MAX(quantity) AS most FROM judged GROUP BY 1"""),
    **{f"feed_{kind}": _q(_FEED.format(cols=", ".join(FEEDS[kind][0]), table=table, n=FEEDS[kind][1],
                                       order="event_time DESC, order_id" if "event_time" in FEEDS[kind][0] else FEEDS[kind][0][0]))
       for kind, table in (("orders", "orders_enriched"), ("high_value", "high_value_orders"), ("suspicious", "suspicious_orders"),
                           ("products", "product_catalog"))},
})

ORACLE.update({
    "sustained_input": _q(f"""
, slots AS (SELECT {bucket('5 minutes')} AS window_start, COUNT(*) AS events FROM orders_raw GROUP BY 1),
hot AS (SELECT window_start FROM slots WHERE events > 1)
SELECT a.window_start FROM hot a JOIN hot b ON b.window_start = a.window_start - INTERVAL '5 minutes'
JOIN hot c ON c.window_start = a.window_start - INTERVAL '10 minutes'"""),
    "capacity_levels": _q(f"""
, load AS (SELECT {bucket('1 minute')} AS m, (CAST(COUNT(*) AS DOUBLE) / 60.0) / (3.0 / 60.0) AS u FROM orders_raw GROUP BY 1)
SELECT CASE WHEN u >= 0.9 THEN 'CRITICAL' WHEN u >= 0.7 THEN 'WARNING' ELSE 'OK' END AS level, COUNT(*) AS minutes FROM load GROUP BY 1"""),
})
