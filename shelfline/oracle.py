"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is written against the generic test tables, with the same
fixture mappings as ``sources.fixtures`` expressed as CTEs. Results are
typed to match Spark's: money sums and averages are exact DECIMALs (the
average is rounded half-up at scale + 4, computed in integer arithmetic
because DuckDB divides decimals as doubles), integer sums are BIGINT and
HOUR() is INTEGER.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------
LOAD_TS = "TIMESTAMP '2025-01-01 00:00:00'"

RAW_SALES = f"""raw_sales AS (
  SELECT CAST(l_suppkey + 1 AS INTEGER) AS Store,
         CAST(l_partkey % 20 + 1 AS INTEGER) AS Dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS Date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS Weekly_Sales,
         l_returnflag = 'R' AS IsHoliday,
         {LOAD_TS} AS ingestion_ts
  FROM lineitem)"""

SALES_FIRST = """sales_first AS (
  SELECT CAST(l_suppkey + 1 AS INTEGER) AS Store,
         CAST(l_partkey % 20 + 1 AS INTEGER) AS Dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS Date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS Weekly_Sales,
         l_returnflag = 'R' AS IsHoliday
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01 00:00:00')"""

SALES_SECOND = """sales_second AS (
  SELECT CAST(l_suppkey + 1 AS INTEGER) AS Store,
         CAST(l_partkey % 20 + 1 AS INTEGER) AS Dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS Date,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS Weekly_Sales,
         l_returnflag = 'R' AS IsHoliday
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')"""

RAW_STORES = f"""raw_stores AS (
  SELECT CAST(s_suppkey + 6 AS INTEGER) AS Store,
         CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS Type,
         CAST(30000 + (s_suppkey * 7919) % 190000 AS INTEGER) AS Size,
         {LOAD_TS} AS ingestion_ts
  FROM supplier)"""

RAW_FEATURES = f"""raw_features AS (
  SELECT Store, Date,
         CAST(max_p * CAST(0.0002 AS DECIMAL(5,4)) AS DECIMAL(10,2)) AS Temperature,
         CAST(min_p * CAST(0.00001 AS DECIMAL(6,5)) AS DECIMAL(10,3)) AS Fuel_Price,
         CASE WHEN n > 1 THEN max_pd / 10 END AS MarkDown1,
         CASE WHEN first_key % 3 = 0 THEN min_pd END AS MarkDown2,
         CASE WHEN any_f THEN max_pd - min_pd END AS MarkDown3,
         CAST(n AS DOUBLE) * 100.0 AS MarkDown4,
         CASE WHEN n >= 3 THEN min_pd / 4 END AS MarkDown5,
         200.5 + CAST(Store % 20 AS DOUBLE) AS CPI,
         CASE WHEN Store % 7 <> 0 THEN CAST(Store % 10 AS DOUBLE) + 0.25 END AS Unemployment,
         urgent AS IsHoliday,
         {LOAD_TS} AS ingestion_ts
  FROM (
    SELECT CAST(o_custkey // 15 + 1 AS INTEGER) AS Store,
           CAST(date_trunc('week', o_orderdate) AS DATE) AS Date,
           MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS max_p,
           MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS min_p,
           MAX(o_totalprice) AS max_pd, MIN(o_totalprice) AS min_pd,
           COUNT(*) AS n, MIN(o_orderkey) AS first_key,
           bool_or(o_orderstatus = 'F') AS any_f,
           bool_or(o_orderpriority = '1-URGENT') AS urgent
    FROM orders GROUP BY 1, 2) g)"""

_EVENT_BASE = """ev_base AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(ts AS TIMESTAMP) AS event_time,
         CAST(user_id % 45 + 1 AS INTEGER) AS store_id,
         CAST(CAST(regexp_extract(props, '"k"\\s*:\\s*(-?[0-9]+)', 1) AS INTEGER) % 10 + 1 AS INTEGER) AS dept_id,
         CAST(regexp_extract(props, '"k"\\s*:\\s*(-?[0-9]+)', 1) AS INTEGER) AS k,
         user_id, event_type AS raw_type, value, event_id AS raw_event_id
  FROM events),
ev AS (
  SELECT *, CAST(store_id AS VARCHAR) || '_' || CAST(dept_id AS VARCHAR) || '_' || CAST(k % 3 AS VARCHAR) AS product_id
  FROM ev_base)"""

SALES_EVENTS = _EVENT_BASE + """,
stream_sales_events AS (
  SELECT event_id, event_time, store_id, dept_id, product_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         CAST(k % 5 + 1 AS INTEGER) AS quantity,
         CAST(value AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(value AS DECIMAL(10,2)) * CAST(k % 5 + 1 AS INTEGER) AS DECIMAL(10,2)) AS total_amount,
         CASE raw_type WHEN 'signup' THEN 'RETURN' WHEN 'error' THEN 'EXCHANGE' ELSE 'SALE' END AS transaction_type,
         CASE k % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'CASH' ELSE 'MOBILE' END AS payment_method,
         k % 2 = 0 AS promotion_applied,
         event_time AS processed_at
  FROM ev)"""

# The spoiled messages, by event id modulo 97.
DIRTY_EVENTS = SALES_EVENTS + """,
dirty_wire AS (
  SELECT CASE WHEN m <> 0 THEN event_id END AS event_id,
         CASE WHEN m NOT IN (0, 2) THEN event_time END AS event_time,
         CASE WHEN m <> 0 THEN store_id END AS store_id, CASE WHEN m <> 0 THEN dept_id END AS dept_id,
         CASE WHEN m <> 0 THEN product_id END AS product_id, CASE WHEN m <> 0 THEN customer_id END AS customer_id,
         CASE WHEN m NOT IN (0, 1) THEN quantity END AS quantity,
         CASE WHEN m <> 0 THEN CAST(unit_price AS DOUBLE) END AS unit_price,
         CASE m WHEN 0 THEN NULL WHEN 3 THEN 0.0 WHEN 5 THEN 1e9 ELSE CAST(total_amount AS DOUBLE) END AS total_amount,
         CASE m WHEN 0 THEN NULL WHEN 4 THEN 'GIFT' ELSE transaction_type END AS transaction_type,
         CASE WHEN m <> 0 THEN payment_method END AS payment_method,
         CASE WHEN m <> 0 THEN promotion_applied END AS promotion_applied
  FROM (SELECT *, CAST(event_id AS BIGINT) % 97 AS m FROM stream_sales_events) s),
dirty_events AS (
  SELECT * REPLACE (CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
                    TRY_CAST(total_amount AS DECIMAL(10,2)) AS total_amount), event_time AS processed_at
  FROM dirty_wire)"""

EVENTS_V1 = _EVENT_BASE + """,
events_v1 AS (
  SELECT CAST(raw_event_id AS INTEGER) AS event_id, event_time, k AS product_id,
         CAST(k % 5 + 1 AS INTEGER) AS quantity, CAST(value AS DECIMAL(10,2)) AS price
  FROM ev)"""

INVENTORY_EVENTS = _EVENT_BASE + """,
stream_inventory_events AS (
  SELECT event_id, event_time, store_id, dept_id, product_id,
         CASE WHEN raw_type IN ('purchase', 'click') THEN 'SALE' WHEN raw_type = 'view' THEN 'RESTOCK'
              WHEN raw_type = 'signup' THEN 'WASTE' ELSE 'TRANSFER' END AS event_type,
         CASE WHEN raw_type = 'view' THEN CAST(k % 5 + 1 AS INTEGER) ELSE -CAST(k % 5 + 1 AS INTEGER) END AS quantity_change,
         CAST(k % 40 AS INTEGER) AS current_stock,
         10 AS reorder_point,
         CASE WHEN k % 7 <> 0 THEN CAST(k % 7 AS VARCHAR) END AS supplier_id,
         event_time AS processed_at
  FROM ev)"""

AS_OF = "(SELECT MAX(CAST(ts AS TIMESTAMP)) FROM events)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def avg_dec(expr: str, in_scale: int, out_prec: int, out_scale: int) -> str:
    """Exact AVG of a DECIMAL(*, in_scale) column, rounded half away from
    zero to ``out_scale`` and typed DECIMAL(out_prec, out_scale)."""
    units = f"CAST(SUM({expr}) * {10 ** in_scale} AS HUGEINT)"
    return avg_from_units(units, f"COUNT({expr})", in_scale, out_prec, out_scale)


def avg_from_units(units: str, n: str, in_scale: int, out_prec: int, out_scale: int) -> str:
    factor = 2 * 10 ** (out_scale - in_scale)
    nn = f"NULLIF({n}, 0)"
    q = (f"(CASE WHEN {units} >= 0 THEN ({units} * {factor} + {nn}) // (2 * {nn}) "
         f"ELSE -((-{units} * {factor} + {nn}) // (2 * {nn})) END)")
    unit = "0." + "0" * (out_scale - 1) + "1"
    return (f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({out_scale + 1},{out_scale})) "
            f"AS DECIMAL({out_prec},{out_scale}))")


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
Q: dict[str, str] = {}

Q["stg_sales"] = with_(RAW_SALES) + "SELECT Store, Dept, Date, Weekly_Sales, IsHoliday FROM raw_sales"
Q["stg_stores"] = with_(RAW_STORES) + "SELECT Store, Type, Size FROM raw_stores"
Q["stg_features"] = with_(RAW_FEATURES) + """SELECT Store, Date, Temperature, Fuel_Price, MarkDown1, MarkDown2,
  MarkDown3, MarkDown4, MarkDown5, CPI, Unemployment, IsHoliday FROM raw_features"""

Q["sales_stores_join"] = with_(RAW_SALES, RAW_STORES) + """
SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday, st.Type AS Store_Type, st.Size AS Store_Size
FROM raw_sales s LEFT JOIN raw_stores st ON s.Store = st.Store"""

Q["sales_features_join"] = with_(RAW_SALES, RAW_FEATURES) + """
SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday, f.Temperature, f.Fuel_Price,
       f.IsHoliday AS Feature_IsHoliday
FROM raw_sales s LEFT JOIN raw_features f ON s.Store = f.Store AND s.Date = f.Date"""

Q["sales_enriched"] = with_(RAW_SALES, RAW_STORES, RAW_FEATURES) + """
SELECT s.Store, s.Date, s.Weekly_Sales, st.Type AS Store_Type, st.Size AS Store_Size,
       f.Temperature, f.Fuel_Price, f.IsHoliday
FROM raw_sales s
LEFT JOIN raw_stores st ON s.Store = st.Store
LEFT JOIN raw_features f ON s.Store = f.Store AND s.Date = f.Date"""

Q["store_performance"] = with_(RAW_SALES, RAW_STORES, RAW_FEATURES) + f"""
, store_sales AS (
  SELECT s.Store, s.Date, s.Weekly_Sales, st.Type AS Store_Type, st.Size AS Store_Size,
         f.Temperature, f.Fuel_Price
  FROM raw_sales s
  LEFT JOIN raw_stores st ON s.Store = st.Store
  LEFT JOIN raw_features f ON s.Store = f.Store AND s.Date = f.Date)
SELECT Store, Store_Type, Store_Size,
       COUNT(*) AS total_weeks,
       {avg_dec('Weekly_Sales', 2, 22, 6)} AS avg_weekly_sales,
       CAST(SUM(Weekly_Sales) AS DECIMAL(28,2)) AS total_sales,
       {avg_dec('Temperature', 2, 14, 6)} AS avg_temperature,
       {avg_dec('Fuel_Price', 3, 14, 7)} AS avg_fuel_price
FROM store_sales GROUP BY Store, Store_Type, Store_Size"""

Q["daily_sales"] = with_(RAW_SALES) + """
SELECT Date AS sale_date, CAST(SUM(Weekly_Sales) AS DECIMAL(28,2)) AS total_sales,
       COUNT(*) AS total_transactions
FROM raw_sales GROUP BY Date"""
Q["sales_summary"] = Q["daily_sales"]

Q["dedupe_rows"] = with_(SALES_FIRST, SALES_SECOND) + """
SELECT DISTINCT * FROM (SELECT * FROM sales_first UNION ALL SELECT * FROM sales_second) u"""

Q["key_unique_check"] = with_(RAW_SALES) + """
SELECT Store, Dept, Date, COUNT(*) AS row_count FROM raw_sales
GROUP BY Store, Dept, Date HAVING COUNT(*) > 1"""

# --- events -----------------------------------------------------------------
_AVG_AMT = avg_dec("total_amount", 2, 14, 6)

Q["parse_event_json"] = with_(DIRTY_EVENTS) + """
SELECT * FROM dirty_wire"""

Q["validate_event"] = with_(DIRTY_EVENTS) + """
SELECT * FROM dirty_events
WHERE quantity > 0 AND unit_price > 0 AND total_amount > 0
  AND store_id IS NOT NULL AND dept_id IS NOT NULL"""

_NN = ["event_id", "event_time", "store_id", "dept_id", "product_id", "customer_id",
       "quantity", "unit_price", "total_amount", "transaction_type", "payment_method"]
_RULES = ([f"CASE WHEN {c} IS NULL THEN 'not_null:{c}' END" for c in _NN] + [
    "CASE WHEN NOT (quantity > 0) THEN 'quantity_positive' END",
    "CASE WHEN NOT (unit_price > 0) THEN 'unit_price_positive' END",
    "CASE WHEN NOT (total_amount > 0) THEN 'total_amount_positive' END",
    "CASE WHEN NOT (length(event_id) <= 36) THEN 'event_id_length' END",
    "CASE WHEN NOT (length(product_id) <= 50) THEN 'product_id_length' END",
    "CASE WHEN NOT (length(customer_id) <= 36) THEN 'customer_id_length' END",
    "CASE WHEN NOT (transaction_type IN ('SALE', 'RETURN', 'EXCHANGE')) THEN 'enum:transaction_type' END",
    "CASE WHEN NOT (payment_method IN ('CASH', 'CARD', 'MOBILE')) THEN 'enum:payment_method' END",
])
Q["contract_check"] = with_(DIRTY_EVENTS) + f"""
SELECT event_id, failed_rules, failed_rules = '' AS is_valid FROM (
  SELECT event_id, concat_ws(',', {', '.join(_RULES)}) AS failed_rules FROM dirty_events) t"""

Q["event_id_dedupe"] = with_(SALES_EVENTS) + "SELECT DISTINCT * FROM stream_sales_events"

Q["event_store_enrich"] = with_(SALES_EVENTS, RAW_STORES) + """
SELECT e.*, COALESCE(s.t, 'C') AS store_type
FROM stream_sales_events e
LEFT JOIN (SELECT Store, MAX(Type) AS t FROM raw_stores GROUP BY Store) s ON e.store_id = s.Store"""

Q["streaming_sales_hourly"] = with_(EVENTS_V1) + """
SELECT strftime(event_time, '%Y-%m-%d %H:00:00') AS hour_bucket,
       CAST(SUM(price * quantity) AS DECIMAL(31,2)) AS sales,
       CAST(SUM(quantity) AS BIGINT) AS qty
FROM events_v1 GROUP BY 1"""

_HOURLY = f"""
       COUNT(*) AS transaction_count,
       CAST(SUM(total_amount) AS DECIMAL(20,2)) AS total_sales,
       {_AVG_AMT} AS avg_transaction_value,
       CAST(SUM(CASE WHEN transaction_type = 'SALE' THEN 1 ELSE 0 END) AS BIGINT) AS sale_count,
       CAST(SUM(CASE WHEN transaction_type = 'RETURN' THEN 1 ELSE 0 END) AS BIGINT) AS return_count,
       CAST(SUM(CASE WHEN transaction_type = 'EXCHANGE' THEN 1 ELSE 0 END) AS BIGINT) AS exchange_count,
       CAST(SUM(CASE WHEN promotion_applied THEN 1 ELSE 0 END) AS BIGINT) AS promotional_transactions,
       MAX(event_time) AS latest_transaction_time"""

Q["rt_sales_summary"] = with_(SALES_EVENTS) + f"""
SELECT store_id, dept_id, CAST(event_time AS DATE) AS sale_date,
       CAST(hour(event_time) AS INTEGER) AS sale_hour, {_HOURLY},
       {AS_OF} AS last_updated
FROM stream_sales_events
WHERE event_time >= {AS_OF} - INTERVAL 24 HOUR
GROUP BY store_id, dept_id, CAST(event_time AS DATE), CAST(hour(event_time) AS INTEGER)"""

Q["hourly_sales_rollup"] = with_(SALES_EVENTS) + f"""
SELECT store_id, dept_id, CAST(event_time AS DATE) AS sale_date,
       CAST(hour(event_time) AS INTEGER) AS sale_hour,
       CAST(COUNT(*) AS INTEGER) AS transaction_count,
       CAST(SUM(total_amount) AS DECIMAL(12,2)) AS total_sales,
       CAST({_AVG_AMT} AS DECIMAL(10,2)) AS avg_transaction_value,
       MAX(event_time) AS last_updated
FROM stream_sales_events
GROUP BY store_id, dept_id, CAST(event_time AS DATE), CAST(hour(event_time) AS INTEGER)"""


def _velocity(interval: str) -> str:
    return f"""velocity AS (
  SELECT store_id, dept_id, product_id,
         COUNT(*) AS transactions_last_hour,
         CAST(SUM(quantity) AS BIGINT) AS units_sold_last_hour,
         CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue_last_hour,
         {_AVG_AMT} AS avg_transaction_value,
         MAX(event_time) AS last_sale_time
  FROM stream_sales_events
  WHERE event_time >= {AS_OF} - INTERVAL {interval} AND transaction_type = 'SALE'
  GROUP BY store_id, dept_id, product_id)"""


Q["product_velocity"] = with_(SALES_EVENTS, _velocity("1 HOUR")) + "SELECT * FROM velocity"

Q["inventory_alerts"] = with_(SALES_EVENTS, _velocity("7 DAY")) + f"""
SELECT * FROM (
  SELECT store_id, dept_id, product_id, transactions_last_hour, units_sold_last_hour,
         revenue_last_hour, avg_transaction_value,
         CASE WHEN units_sold_last_hour >= 20 THEN 'HIGH_VELOCITY'
              WHEN units_sold_last_hour >= 10 THEN 'MEDIUM_VELOCITY'
              WHEN units_sold_last_hour >= 5 THEN 'NORMAL_VELOCITY'
              ELSE 'LOW_VELOCITY' END AS velocity_category,
         CASE WHEN units_sold_last_hour >= 20 THEN 'URGENT_RESTOCK'
              WHEN units_sold_last_hour >= 10 THEN 'MONITOR_STOCK'
              ELSE 'NO_ACTION' END AS alert_level,
         last_sale_time, {AS_OF} AS alert_generated_at
  FROM velocity) a
WHERE alert_level IN ('URGENT_RESTOCK', 'MONITOR_STOCK')"""

_CUSTOMER_METRICS = f"""customer_metrics AS (
  SELECT customer_id, store_id,
         COUNT(*) AS transactions_today,
         CAST(SUM(total_amount) AS DECIMAL(20,2)) AS total_spent_today,
         {_AVG_AMT} AS avg_transaction_value,
         CAST(SUM(quantity) AS BIGINT) AS total_items_purchased,
         COUNT(DISTINCT dept_id) AS departments_visited,
         COUNT(DISTINCT product_id) AS unique_products_bought,
         CAST(SUM(CASE WHEN promotion_applied THEN 1 ELSE 0 END) AS BIGINT) AS promotional_transactions,
         MIN(event_time) AS first_transaction_today,
         MAX(event_time) AS last_transaction_today,
         date_sub('minute', MIN(event_time), MAX(event_time)) AS session_duration_minutes
  FROM stream_sales_events
  WHERE CAST(event_time AS DATE) = CAST({AS_OF} AS DATE) AND transaction_type = 'SALE'
  GROUP BY customer_id, store_id)"""

Q["customer_metrics"] = with_(SALES_EVENTS, _CUSTOMER_METRICS) + "SELECT * FROM customer_metrics"

Q["customer_analytics"] = with_(SALES_EVENTS, _CUSTOMER_METRICS) + f"""
SELECT customer_id, store_id, transactions_today, total_spent_today, avg_transaction_value,
       total_items_purchased, departments_visited, unique_products_bought, promotional_transactions,
       CASE WHEN total_spent_today >= 500 THEN 'HIGH_VALUE'
            WHEN total_spent_today >= 200 THEN 'MEDIUM_VALUE'
            WHEN total_spent_today >= 50 THEN 'REGULAR_VALUE'
            ELSE 'LOW_VALUE' END AS value_segment,
       CASE WHEN transactions_today >= 5 THEN 'FREQUENT_BUYER'
            WHEN transactions_today >= 3 THEN 'REGULAR_BUYER'
            ELSE 'OCCASIONAL_BUYER' END AS frequency_segment,
       CASE WHEN departments_visited >= 5 THEN 'CROSS_SHOPPER'
            WHEN departments_visited >= 3 THEN 'MULTI_CATEGORY'
            ELSE 'FOCUSED_SHOPPER' END AS shopping_behavior,
       session_duration_minutes, first_transaction_today, last_transaction_today,
       {AS_OF} AS analysis_timestamp
FROM customer_metrics"""

Q["stream_health"] = with_(SALES_EVENTS) + f"""
SELECT *, CASE WHEN recent_records > 0 THEN 'fresh' ELSE 'stale' END AS data_freshness,
          CASE WHEN recent_records > 0 THEN 'healthy' ELSE 'warning' END AS validation_status
FROM (
  SELECT COUNT(*) AS total_records,
         COUNT(CASE WHEN event_time >= {AS_OF} - INTERVAL 5 MINUTE THEN 1 END) AS recent_records,
         MAX(event_time) AS latest_record, MIN(event_time) AS earliest_record,
         COUNT(DISTINCT store_id) AS unique_stores, COUNT(DISTINCT dept_id) AS unique_departments
  FROM stream_sales_events) h"""

Q["stream_health_stale"] = with_(SALES_EVENTS) + f"""
SELECT *, CASE WHEN recent_records > 0 THEN 'fresh' ELSE 'stale' END AS data_freshness,
          CASE WHEN recent_records > 0 THEN 'healthy' ELSE 'warning' END AS validation_status
FROM (
  SELECT COUNT(*) AS total_records,
         COUNT(CASE WHEN event_time >= {AS_OF} + INTERVAL 1 HOUR - INTERVAL 5 MINUTE THEN 1 END) AS recent_records,
         MAX(event_time) AS latest_record, MIN(event_time) AS earliest_record,
         COUNT(DISTINCT store_id) AS unique_stores, COUNT(DISTINCT dept_id) AS unique_departments
  FROM stream_sales_events) h"""

Q["hourly_performance"] = with_(SALES_EVENTS) + f"""
SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day, COUNT(*) AS transactions,
       CAST(SUM(total_amount) AS DECIMAL(20,2)) AS total_revenue,
       {_AVG_AMT} AS avg_transaction_value
FROM stream_sales_events
WHERE CAST(event_time AS DATE) = CAST({AS_OF} AS DATE)
GROUP BY 1 ORDER BY hour_of_day DESC LIMIT 5"""

Q["top_stores"] = with_(SALES_EVENTS) + f"""
SELECT store_id, COUNT(*) AS transactions,
       CAST(SUM(total_amount) AS DECIMAL(20,2)) AS total_revenue,
       {_AVG_AMT} AS avg_transaction_value
FROM stream_sales_events
WHERE event_time >= {AS_OF} - INTERVAL 1 HOUR
GROUP BY store_id ORDER BY total_revenue DESC, store_id LIMIT 5"""

Q["streaming_metrics"] = with_(SALES_EVENTS) + f"""
, g AS (
  SELECT date_trunc('hour', event_time) AS metric_time, store_id, dept_id,
         CAST(COUNT(*) AS DECIMAL(15,4)) AS transaction_count,
         CAST(SUM(total_amount) AS DECIMAL(15,4)) AS total_sales,
         CAST({_AVG_AMT} AS DECIMAL(15,4)) AS avg_transaction_value,
         CAST(SUM(quantity) AS DECIMAL(15,4)) AS units_sold
  FROM stream_sales_events GROUP BY 1, 2, 3)
SELECT metric_time, 'transaction_count' AS metric_name, transaction_count AS metric_value, store_id, dept_id FROM g
UNION ALL SELECT metric_time, 'total_sales', total_sales, store_id, dept_id FROM g
UNION ALL SELECT metric_time, 'avg_transaction_value', avg_transaction_value, store_id, dept_id FROM g
UNION ALL SELECT metric_time, 'units_sold', units_sold, store_id, dept_id FROM g"""

_STOCK_CASE = """CASE WHEN current_stock <= 0 THEN 'OUT_OF_STOCK'
            WHEN current_stock <= reorder_point THEN 'LOW_STOCK'
            ELSE 'NORMAL' END"""

Q["stock_status"] = with_(INVENTORY_EVENTS) + f"""
SELECT event_id, current_stock, reorder_point, {_STOCK_CASE} AS stock_status
FROM stream_inventory_events"""

Q["inventory_status"] = with_(INVENTORY_EVENTS) + f"""
SELECT store_id, dept_id, product_id, current_stock, reorder_point, {_STOCK_CASE} AS stock_status,
       event_time AS last_updated
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id
                                   ORDER BY event_time DESC, event_id DESC) AS rn
      FROM stream_inventory_events) t
WHERE rn = 1"""

Q["business_hours_flag"] = with_(SALES_EVENTS) + """
SELECT event_id, event_time,
       CASE WHEN isodow(event_time) >= 6 THEN hour(event_time) BETWEEN 8 AND 23
            ELSE hour(event_time) BETWEEN 6 AND 22 END AS is_business_hours
FROM stream_sales_events"""

Q["daypart"] = with_(SALES_EVENTS, RAW_STORES) + """
SELECT store_type, daypart, COUNT(*) AS transactions,
       CAST(SUM(total_amount) AS DECIMAL(20,2)) AS total_revenue,
       CAST(SUM(quantity) AS BIGINT) AS units
FROM (
  SELECT COALESCE(s.t, 'C') AS store_type,
         CASE WHEN hour(e.event_time) BETWEEN 11 AND 13 OR hour(e.event_time) BETWEEN 17 AND 19 THEN 'RUSH'
              WHEN hour(e.event_time) BETWEEN 20 AND 22 THEN 'EVENING'
              ELSE 'NORMAL' END AS daypart,
         e.total_amount, e.quantity
  FROM stream_sales_events e
  LEFT JOIN (SELECT Store, MAX(Type) AS t FROM raw_stores GROUP BY Store) s ON e.store_id = s.Store) x
GROUP BY store_type, daypart"""

# --- loading ----------------------------------------------------------------
_FIRST_LOADED = """first_loaded AS (
  SELECT Store, Dept, Date, Weekly_Sales, IsHoliday, TIMESTAMP '2025-01-01 00:00:00' AS ingestion_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept, Date
                                     ORDER BY Weekly_Sales DESC, IsHoliday DESC) AS rn
        FROM sales_first) t WHERE rn = 1)"""
_SECOND_LAST = """second_last AS (
  SELECT Store, Dept, Date, Weekly_Sales, IsHoliday
  FROM (SELECT *, row_number() OVER (PARTITION BY Store, Dept, Date
                                     ORDER BY Weekly_Sales DESC, IsHoliday DESC) AS rn
        FROM sales_second) t WHERE rn = 1)"""

Q["keyed_upsert"] = with_(SALES_FIRST, SALES_SECOND, _FIRST_LOADED, _SECOND_LAST) + """
SELECT COALESCE(s.Store, f.Store) AS Store, COALESCE(s.Dept, f.Dept) AS Dept,
       COALESCE(s.Date, f.Date) AS Date,
       CASE WHEN s.Store IS NOT NULL THEN s.Weekly_Sales ELSE f.Weekly_Sales END AS Weekly_Sales,
       CASE WHEN s.Store IS NOT NULL THEN s.IsHoliday ELSE f.IsHoliday END AS IsHoliday,
       CASE WHEN s.Store IS NOT NULL THEN TIMESTAMP '2025-01-08 00:00:00' ELSE f.ingestion_ts END AS ingestion_ts
FROM first_loaded f
FULL OUTER JOIN second_last s ON f.Store = s.Store AND f.Dept = s.Dept AND f.Date = s.Date"""

Q["load_report"] = with_(SALES_FIRST, SALES_SECOND, _FIRST_LOADED, _SECOND_LAST) + """
SELECT (SELECT COUNT(*) FROM first_loaded) AS initial_count,
       COUNT(*) AS final_count,
       COUNT(CASE WHEN f.Store IS NULL THEN 1 END) AS new_records,
       COUNT(CASE WHEN f.Store IS NOT NULL AND s.Store IS NOT NULL
                   AND (f.Weekly_Sales, f.IsHoliday) IS DISTINCT FROM (s.Weekly_Sales, s.IsHoliday) THEN 1 END) AS updated_records,
       COUNT(CASE WHEN f.Store IS NOT NULL AND s.Store IS NOT NULL
                   AND (f.Weekly_Sales, f.IsHoliday) IS NOT DISTINCT FROM (s.Weekly_Sales, s.IsHoliday) THEN 1 END) AS unchanged_records,
       'sales.csv' AS file_processed
FROM first_loaded f
FULL OUTER JOIN second_last s ON f.Store = s.Store AND f.Dept = s.Dept AND f.Date = s.Date"""

Q["csv_source"] = with_(RAW_FEATURES) + """SELECT Store, Date, Temperature, Fuel_Price, MarkDown1, MarkDown2,
  MarkDown3, MarkDown4, MarkDown5, CPI, Unemployment, IsHoliday FROM raw_features"""

Q["json_flatten"] = """
SELECT p_partkey AS id, p_name AS title, p_retailprice AS price,
       p_brand AS "details.brand", p_type AS "details.category",
       CAST(p_size AS BIGINT) AS "details.dimensions.size"
FROM part"""

_SPLIT = f"({AS_OF} - INTERVAL 12 HOUR)"
_HW = f"(SELECT MAX(event_time) FROM stream_sales_events WHERE event_time >= {_SPLIT} - INTERVAL 24 HOUR AND event_time <= {_SPLIT})"
_KEYS_SQL = "store_id, dept_id, CAST(event_time AS DATE) AS sale_date, CAST(hour(event_time) AS INTEGER) AS sale_hour"
_GROUP_SQL = "GROUP BY store_id, dept_id, CAST(event_time AS DATE), CAST(hour(event_time) AS INTEGER)"

Q["sales_summary_incremental"] = with_(SALES_EVENTS) + f"""
SELECT {_KEYS_SQL}, {_HOURLY},
       CASE WHEN MAX(event_time) > {_HW} THEN {AS_OF} ELSE {_SPLIT} END AS last_updated
FROM stream_sales_events
WHERE event_time >= {_SPLIT} - INTERVAL 24 HOUR
{_GROUP_SQL}"""

Q["sales_summary_incremental_replace"] = with_(SALES_EVENTS) + f"""
, run1 AS (
  SELECT {_KEYS_SQL}, {_HOURLY}, {_SPLIT} AS last_updated
  FROM stream_sales_events
  WHERE event_time >= {_SPLIT} - INTERVAL 24 HOUR AND event_time <= {_SPLIT}
  {_GROUP_SQL}),
run2 AS (
  SELECT {_KEYS_SQL}, {_HOURLY}, {AS_OF} AS last_updated
  FROM stream_sales_events WHERE event_time > {_HW}
  {_GROUP_SQL})
SELECT * FROM run2
UNION ALL
SELECT * FROM run1 WHERE NOT EXISTS (
  SELECT 1 FROM run2 WHERE run2.store_id = run1.store_id AND run2.dept_id = run1.dept_id
    AND run2.sale_date = run1.sale_date AND run2.sale_hour = run1.sale_hour)"""

Q["sales_summary_incremental_recompute"] = with_(SALES_EVENTS) + f"""
, run1 AS (
  SELECT {_KEYS_SQL}, {_HOURLY}, {_SPLIT} AS last_updated
  FROM stream_sales_events
  WHERE event_time >= {_SPLIT} - INTERVAL 24 HOUR AND event_time <= {_SPLIT}
  {_GROUP_SQL}),
run2 AS (
  SELECT {_KEYS_SQL}, {_HOURLY}, {AS_OF} AS last_updated
  FROM stream_sales_events e
  WHERE EXISTS (SELECT 1 FROM stream_sales_events n WHERE n.event_time > {_SPLIT}
    AND n.store_id = e.store_id AND n.dept_id = e.dept_id
    AND date_trunc('hour', n.event_time) = date_trunc('hour', e.event_time))
  {_GROUP_SQL})
SELECT * FROM run2
UNION ALL
SELECT * FROM run1 WHERE NOT EXISTS (
  SELECT 1 FROM run2 WHERE run2.store_id = run1.store_id AND run2.dept_id = run1.dept_id
    AND run2.sale_date = run1.sale_date AND run2.sale_hour = run1.sale_hour)"""

# --- streaming ----------------------------------------------------------------
Q["stream_ingest"] = with_(DIRTY_EVENTS) + f"""
SELECT event_id, event_time, store_id, dept_id, product_id, customer_id, quantity, unit_price,
       total_amount, transaction_type, payment_method, promotion_applied
FROM (SELECT *, concat_ws(',', {', '.join(_RULES)}) AS failed FROM dirty_events) c
WHERE failed = ''"""

Q["stream_quarantine"] = with_(DIRTY_EVENTS) + f"""
SELECT event_id, failed AS failed_rules, true AS has_raw
FROM (SELECT *, concat_ws(',', {', '.join(_RULES)}) AS failed FROM dirty_events) c
WHERE failed <> ''"""

Q["stream_hourly_sales"] = with_(SALES_EVENTS) + f"""
SELECT date_trunc('hour', event_time) AS window_start,
       date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
       store_id, dept_id, {_HOURLY}
FROM stream_sales_events
GROUP BY date_trunc('hour', event_time), store_id, dept_id"""

Q["stream_inventory_alerts"] = with_(SALES_EVENTS) + f"""
, slid AS (
  SELECT e.*, time_bucket(INTERVAL 5 MINUTE, e.event_time) - i * INTERVAL 5 MINUTE AS window_start
  FROM stream_sales_events e, UNNEST(range(12)) AS r(i)
  WHERE e.transaction_type = 'SALE'),
g AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, store_id, dept_id, product_id,
         COUNT(*) AS transactions_last_hour,
         CAST(SUM(quantity) AS BIGINT) AS units_sold_last_hour,
         CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue_last_hour,
         {_AVG_AMT} AS avg_transaction_value,
         MAX(event_time) AS last_sale_time
  FROM slid GROUP BY window_start, store_id, dept_id, product_id)
SELECT * FROM (
  SELECT window_start, window_end, store_id, dept_id, product_id, transactions_last_hour,
         units_sold_last_hour, revenue_last_hour, avg_transaction_value, last_sale_time,
         CASE WHEN units_sold_last_hour >= 20 THEN 'HIGH_VELOCITY'
              WHEN units_sold_last_hour >= 10 THEN 'MEDIUM_VELOCITY'
              WHEN units_sold_last_hour >= 5 THEN 'NORMAL_VELOCITY'
              ELSE 'LOW_VELOCITY' END AS velocity_category,
         CASE WHEN units_sold_last_hour >= 20 THEN 'URGENT_RESTOCK'
              WHEN units_sold_last_hour >= 10 THEN 'MONITOR_STOCK'
              ELSE 'NO_ACTION' END AS alert_level
  FROM g) a
WHERE alert_level IN ('URGENT_RESTOCK', 'MONITOR_STOCK')"""

Q["parse_event_json_v1"] = with_(EVENTS_V1) + """
SELECT event_id, event_time, product_id, quantity, CAST(price AS DOUBLE) AS price FROM events_v1"""

Q["load_sales_table"] = Q["keyed_upsert"]

Q["stream_summary"] = with_(SALES_EVENTS) + f"""
SELECT {_KEYS_SQL}, {_HOURLY}, MAX(event_time) AS last_updated
FROM stream_sales_events
WHERE quantity > 0 AND unit_price > 0 AND total_amount > 0
  AND store_id IS NOT NULL AND dept_id IS NOT NULL
{_GROUP_SQL}"""

Q["inventory_status_stream"] = Q["inventory_status"]

Q["csv_upsert_partial_columns"] = with_(RAW_STORES) + """
SELECT Store, Type, CAST(CASE WHEN Store % 2 = 0 THEN Size + 1 ELSE Size END AS INTEGER) AS Size,
       CASE WHEN Store % 2 = 0 THEN TIMESTAMP '2025-01-08 00:00:00' ELSE TIMESTAMP '2025-01-01 00:00:00' END AS ingestion_ts
FROM raw_stores"""

# Stored forms of queries above: the same rows, kept by another way.
Q["load_sales_by_week"] = Q["keyed_upsert"]
Q["stored_sales_summary"] = Q["sales_summary_incremental"]
Q["stream_late_events"] = Q["stream_hourly_sales"]
Q["stream_alert_panes"] = Q["stream_inventory_alerts"]
Q["stream_customer_analytics"] = Q["customer_analytics"]
Q["stream_v1_hourly"] = Q["streaming_sales_hourly"]
Q["stream_mixed_events"] = Q["stream_ingest"]
Q["stream_compacted"] = Q["stream_ingest"]

Q["inventory_alerts_ordered"] = f"""
SELECT units_sold_last_hour, revenue_last_hour FROM ({Q["inventory_alerts"]}) a
ORDER BY units_sold_last_hour DESC, revenue_last_hour DESC LIMIT 10"""

Q["customer_analytics_ordered"] = f"""
SELECT total_spent_today, transactions_today FROM ({Q["customer_analytics"]}) a
ORDER BY total_spent_today DESC, transactions_today DESC LIMIT 10"""

_NO_TYPE = [r for r in _RULES if "enum:" not in r and "'not_null:transaction_type'" not in r and "'not_null:payment_method'" not in r]
Q["contract_defaults"] = with_(DIRTY_EVENTS) + f"""
SELECT event_id, event_time, store_id, dept_id, product_id, customer_id, quantity, unit_price,
       total_amount, 'SALE' AS transaction_type, 'CARD' AS payment_method, false AS promotion_applied
FROM (SELECT *, concat_ws(',', {', '.join(_NO_TYPE)}) AS failed FROM dirty_events) c
WHERE failed = ''"""

Q["json_flatten_drift"] = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title,
       CASE WHEN p_partkey % 2 = 1 THEN p_retailprice END AS price,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS "details.brand",
       CASE WHEN p_partkey % 2 = 1 THEN p_type END AS "details.category",
       CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS "details.dimensions.size",
       CASE WHEN p_partkey % 2 = 1 THEN 'cm' END AS "details.dimensions.unit"
FROM part"""

Q["csv_routing"] = with_(RAW_STORES, RAW_FEATURES) + """
SELECT 'raw_features' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT Store) AS n_stores FROM raw_features
UNION ALL SELECT 'raw_stores', COUNT(*), COUNT(DISTINCT Store) FROM raw_stores"""
