"""DuckDB SQL for every query, written from the definitions and not from the Spark code.

The sales fact here always joins all four dimensions, so a Spark query that leaves one out is
checked against one that does not.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

D2 = "DECIMAL(18, 2)"
AS_OF = "DATE '2001-08-02'"


def _round(value: str, digits: int) -> str:
    """Half-up on the shortest text of the double; text has 17 digits at most."""
    text = f"CAST(CAST({value} AS DOUBLE) AS VARCHAR)"
    return f"CAST(ROUND(CAST({text} AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _ratio(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))"


def _percent(part: str, whole: str, digits: int = 2) -> str:
    return _round(f"{_ratio(part, whole)} * 100", digits)


def _doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _initcap(value: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({value})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


_RAW_CUSTOMERS = """raw_customers AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         ' ' || lower(replace(c_name, '#', ' ')) || ' ' AS full_name,
         '  ' || upper(c_name) || '@EMAIL.com ' AS email,
         '+1-' || split_part(c_name, '#', 2) AS phone,
         n_name AS city, r_name AS state,
         ' ' || lower(n_name) || ' ' AS country,
         CAST(18 + c_custkey % 58 AS INT) AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Bronze' WHEN 'BUILDING' THEN 'Silver'
              WHEN 'MACHINERY' THEN 'Gold' WHEN 'HOUSEHOLD' THEN 'Platinum'
              WHEN 'FURNITURE' THEN 'Unclassified' END AS loyalty_tier,
         DATE '1995-01-01' + CAST(c_custkey % 2191 AS INT) AS join_date,
         CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

_CUSTOMERS = f"""{_RAW_CUSTOMERS},
customers AS (
  SELECT customer_id, first_name, last_name,
         {_initcap("full_name")} AS full_name,
         lower(trim(email)) AS email, phone, city, state,
         upper(trim(country)) AS country, age, gender, loyalty_tier, join_date,
         is_active = 'Y' AS is_active,
         CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
              WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_band,
         {_round(f"datediff('day', join_date, {AS_OF}) / 365.25", 1)} AS tenure_years
  FROM raw_customers)"""

_ITEMS = f"""raw_items AS (
  SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category,
         p_brand AS sub_category, p_brand AS brand, p_size,
         CAST((CAST(p_retailprice AS {D2}) - 900) * 4 + 10 AS {D2}) AS unit_price,
         CAST(p_size AS DOUBLE) AS weight_kg,
         DATE '1995-01-01' + CAST(p_partkey % 1827 AS INT) AS launch_date,
         1 + p_partkey % 20 AS supplier_id
  FROM part),
costed_items AS (
  SELECT *, CAST(ROUND(unit_price * (CAST(0.45 AS DECIMAL(9, 4))
                 + p_size * CAST(0.012 AS DECIMAL(9, 4))), 2) AS {D2}) AS cost_price
  FROM raw_items),
items AS (
  SELECT item_id, item_name, category, sub_category, brand, unit_price, cost_price, weight_kg,
         TRUE AS is_available, launch_date, supplier_id,
         {_percent("(unit_price - cost_price)", "unit_price")} AS margin_pct,
         CASE WHEN unit_price < 25 THEN 'Budget' WHEN unit_price < 100 THEN 'Mid-Range'
              WHEN unit_price < 300 THEN 'Premium' ELSE 'Luxury' END AS price_band
  FROM costed_items)"""

_STORES = f"""stores AS (
  SELECT *, {_round(f"datediff('day', open_date, {AS_OF}) / 365.25", 1)} AS store_age_years
  FROM (
    SELECT s_suppkey AS store_id, s_name AS store_name,
           CASE s_suppkey % 4 WHEN 0 THEN 'Flagship' WHEN 1 THEN 'Express'
                WHEN 2 THEN 'Standard' ELSE 'Premium' END AS store_type,
           n_name AS city, r_name AS state, upper(n_name) AS country, r_name AS region,
           CAST(2000 + (s_suppkey * 37) % 18001 AS INT) AS sq_footage,
           DATE '1990-01-01' + CAST(s_suppkey % 3653 AS INT) AS open_date,
           'Manager ' || split_part(s_name, '#', 2) AS manager_name,
           '+1-' || split_part(s_name, '#', 2) AS phone,
           TRUE AS is_active
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey))"""


def _calendar(first: str, last: str) -> str:
    return f"""calendar AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date,
         CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
         CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
         CAST(weekofyear(d) AS INT) AS week_of_year, CAST(isodow(d) AS INT) AS day_of_week,
         dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
         (month(d) = 12 AND day(d) = 25) OR (month(d) = 1 AND day(d) = 1) AS is_holiday,
         'FY' || year(d) || 'Q' || quarter(d) AS fiscal_quarter
  FROM (SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d))"""


_CALENDAR = _calendar(
    "(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)",
    "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)",
)


def _txns(tax_rate: str = "CAST(l_tax AS DECIMAL(9, 4))", cost_factor: str = "0.55") -> str:
    # The unit price is rounded half-up in whole ten-thousandths.
    return f"""lines AS (
  SELECT l_orderkey AS transaction_id, o_custkey AS customer_id, l_partkey AS item_id,
         l_suppkey AS store_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_id,
         l_linenumber AS line, CAST(l_quantity AS INT) AS quantity,
         CAST(CAST((200 * CAST(ROUND(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
              // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(18, 0))
              * CAST(0.0001 AS DECIMAL(5, 4)) AS DECIMAL(18, 4)) AS unit_price,
         CAST(l_discount AS DECIMAL(9, 4)) AS discount_pct,
         {tax_rate} AS tax_rate,
         o_orderpriority AS payment_method,
         CASE l_linenumber % 3 WHEN 0 THEN 'In-Store' WHEN 1 THEN 'Online'
              ELSE 'Mobile App' END AS channel,
         l_returnflag = 'R' AS return_flag,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending'
              WHEN 'P' THEN 'Refunded' END AS transaction_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
grossed AS (
  SELECT *, CAST(ROUND(unit_price * quantity, 2) AS {D2}) AS gross_amount FROM lines),
discounted AS (
  SELECT *, CAST(ROUND(gross_amount * discount_pct, 2) AS {D2}) AS discount_amount FROM grossed),
netted AS (
  SELECT *, CAST(gross_amount - discount_amount AS {D2}) AS net_amount FROM discounted),
taxed AS (
  SELECT *, CAST(ROUND(net_amount * tax_rate, 2) AS {D2}) AS tax_amount FROM netted),
txns AS (
  SELECT *, CAST(net_amount + tax_amount AS {D2}) AS total_amount,
         CAST(ROUND(net_amount - quantity * unit_price
              * CAST({cost_factor} AS DECIMAL(9, 4)), 2) AS {D2}) AS profit_amount
  FROM taxed)"""


_TXNS = _txns()
_STAR = ",\n".join([_CUSTOMERS, _ITEMS, _STORES, _CALENDAR, _TXNS])
_FACT = f"""{_STAR},
fact AS (
  SELECT t.transaction_id, t.customer_id, t.item_id, t.store_id, t.date_id,
         c.full_name, c.city, c.state, c.loyalty_tier, c.age_band, c.gender,
         i.item_name, i.category, i.sub_category, i.price_band,
         s.store_name, s.store_type, s.region,
         d.full_date, d.day_name, d.month_name, d.month, d.quarter, d.year,
         d.is_weekend, d.is_holiday,
         t.quantity, t.unit_price, t.discount_pct, t.discount_amount, t.gross_amount,
         t.net_amount, t.tax_amount, t.total_amount, t.profit_amount,
         t.payment_method, t.channel, t.return_flag, t.transaction_status
  FROM txns t
  LEFT JOIN customers c ON t.customer_id = c.customer_id
  LEFT JOIN items i ON t.item_id = i.item_id
  LEFT JOIN stores s ON t.store_id = s.store_id
  LEFT JOIN calendar d ON t.date_id = d.date_id)"""

_AMOUNTS = (
    "unit_price", "discount_pct", "discount_amount", "gross_amount", "net_amount", "tax_amount",
    "total_amount", "profit_amount",
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _replace_doubles(table: str, columns: tuple[str, ...], extra: str = "") -> str:
    return f"SELECT * {extra} REPLACE ({_doubles(*columns)}) FROM {table}"


# Measures.
_REV = "CAST(SUM(total_amount) AS DOUBLE)"
_PROFIT = "CAST(SUM(profit_amount) AS DOUBLE)"
_UNITS = "CAST(SUM(quantity) AS BIGINT)"
_RETURNS = "CAST(SUM(CAST(return_flag AS INT)) AS BIGINT)"
_AVG_SALE = _round(_ratio("SUM(total_amount)", "COUNT(total_amount)"), 2)
_AVG_DISCOUNT = _round(_ratio("SUM(discount_pct)", "COUNT(discount_pct)") + " * 100", 1)
_MARGIN = _percent("SUM(profit_amount)", "SUM(total_amount)")
_SALES = "COUNT(DISTINCT transaction_id)"
_BUYERS = "COUNT(DISTINCT customer_id)"

_KPIS = f"""SELECT {_SALES} AS total_transactions, {_BUYERS} AS unique_customers,
       {_REV} AS total_revenue, {_PROFIT} AS total_profit, {_AVG_SALE} AS avg_order_value,
       {_UNITS} AS total_units_sold, {_MARGIN} AS profit_margin_pct,
       {_RETURNS} AS total_returns, {_percent(_RETURNS, "COUNT(*)")} AS return_rate_pct
FROM fact"""
_BY_CATEGORY = f"""SELECT category, {_REV} AS total_revenue, {_PROFIT} AS total_profit,
       {_UNITS} AS units_sold, {_SALES} AS transactions, {_BUYERS} AS unique_customers,
       {_AVG_DISCOUNT} AS avg_discount_pct, {_MARGIN} AS margin_pct
FROM fact GROUP BY category"""
_TREND = f"""SELECT year, month, month_name, {_REV} AS monthly_revenue, {_PROFIT} AS monthly_profit,
       {_SALES} AS order_count, {_BUYERS} AS active_customers, {_AVG_SALE} AS avg_order_value,
       {_UNITS} AS units_sold
FROM fact GROUP BY year, month, month_name"""
_DAILY = f"""SELECT full_date, year, month, month_name, quarter, is_weekend,
       COUNT(transaction_id) AS transaction_count, {_REV} AS total_revenue,
       {_PROFIT} AS total_profit, {_UNITS} AS total_units_sold,
       {_ratio("SUM(total_amount)", "COUNT(total_amount)")} AS avg_order_value,
       {_BUYERS} AS unique_customers, {_RETURNS} AS return_count,
       CAST(SUM(discount_amount) AS DOUBLE) AS total_discounts,
       {_MARGIN} AS profit_margin_pct,
       {_percent(_RETURNS, "COUNT(transaction_id)")} AS return_rate_pct
FROM fact GROUP BY full_date, year, month, month_name, quarter, is_weekend"""
_CATEGORY = f"""SELECT *, RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank FROM (
  SELECT category, sub_category, price_band, {_REV} AS total_revenue, {_PROFIT} AS total_profit,
         {_UNITS} AS units_sold, COUNT(transaction_id) AS transaction_count,
         {_ratio("SUM(total_amount)", "COUNT(total_amount)")} AS avg_order_value,
         {_ratio("SUM(discount_pct)", "COUNT(discount_pct)")} AS avg_discount_pct,
         {_BUYERS} AS unique_customers, {_MARGIN} AS profit_margin_pct
  FROM fact GROUP BY category, sub_category, price_band)"""
_SUMMARY = f"""SELECT *,
       CASE WHEN total_orders >= 45 AND total_spend >= 2500000 THEN 'Champion'
            WHEN total_orders >= 30 AND days_since_purchase <= 60 THEN 'Loyal'
            WHEN days_since_purchase > 180 THEN 'At Risk'
            ELSE 'Regular' END AS rfm_segment
FROM (
  SELECT customer_id, full_name, city, state, loyalty_tier, age_band, gender,
         COUNT(transaction_id) AS total_orders, {_REV} AS total_spend,
         {_ratio("SUM(total_amount)", "COUNT(total_amount)")} AS avg_order_value,
         MAX(full_date) AS last_purchase_date, MIN(full_date) AS first_purchase_date,
         {_UNITS} AS total_units, {_RETURNS} AS total_returns,
         COUNT(DISTINCT category) AS categories_bought,
         CAST(datediff('day', MAX(full_date), {AS_OF}) AS INT) AS days_since_purchase,
         CAST(datediff('day', MIN(full_date), MAX(full_date)) AS INT) AS customer_tenure_days,
         {_percent(_RETURNS, "COUNT(transaction_id)")} AS return_rate_pct
  FROM fact GROUP BY customer_id, full_name, city, state, loyalty_tier, age_band, gender)"""


def _check(check: str, table: str, failing: str, where: str = "") -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST({failing} AS BIGINT) AS failing, "
        f"COUNT(*) AS total FROM {table} {where}"
    )


def _broken(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _surplus(key: str, table: str) -> str:
    return f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {table}))"


def _orphans(key: str, parent: str) -> str:
    return _broken(f"{key} IS NULL OR {key} NOT IN (SELECT {key} FROM {parent})")


_CHECKS = {
    "not_null": [
        _check("customer_id not null", "customers", _broken("customer_id IS NULL")),
        _check("email not null", "customers", _broken("email IS NULL")),
        _check("category not null", "items", _broken("category IS NULL")),
    ],
    "unique": [
        _check("customer_id unique", "customers", _surplus("customer_id", "customers")),
        _check("item_id unique", "items", _surplus("item_id", "items")),
        _check("transaction_id unique", "txns", _surplus("transaction_id", "txns")),
    ],
    "range": [
        _check("age between 18 and 100", "customers", _broken("age < 18 OR age > 100")),
        _check("discount_pct between 0-1", "txns", _broken("discount_pct < 0 OR discount_pct > 1")),
    ],
    "domain": [
        _check("loyalty_tier valid values", "customers",
               _broken("loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')")),
    ],
    "positive": [
        _check("unit_price > 0", "items", _broken("unit_price <= 0")),
        _check("total_amount > 0", "txns", _broken("total_amount <= 0")),
        _check("quantity > 0", "txns", _broken("quantity <= 0")),
    ],
    "compare": [
        _check("cost_price < unit_price", "items", _broken("cost_price >= unit_price")),
    ],
    "reference": [
        _check("customer_id ref integrity", "txns", _orphans("customer_id", "customers")),
        _check("item_id ref integrity", "txns", _orphans("item_id", "items")),
        _check("store_id ref integrity", "txns", _orphans("store_id", "stores")),
    ],
}


_MORE_CHECKS = [
    _check("store_id unique", "stores", _surplus("store_id", "stores")),
    _check("date_id unique", "calendar", _surplus("date_id", "calendar")),
    _check("month between 1 and 12", "calendar", _broken("month < 1 OR month > 12")),
    _check("date_id ref integrity", "txns", _orphans("date_id", "calendar")),
]


def _report(*groups: str, more: Sequence[str] = ()) -> str:
    checks = [c for g in groups for c in _CHECKS[g]] + list(more)
    union = "\nUNION ALL ".join(checks)
    passing = _round("(1 - CAST(failing AS DOUBLE) / total) * 100", 1)
    return f"""SELECT "check", "table", CASE WHEN failing = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       failing, total, CASE WHEN total > 0 THEN {passing} ELSE 100.0 END AS pass_pct
FROM ({union})"""


_FULL_REPORT = _report(*_CHECKS)

ORACLE: dict[str, str] = {
    # Sources and sinks.
    "src_csv_roundtrip": _with(_TXNS, f"""SELECT transaction_id, customer_id, item_id, store_id,
       date_id, quantity, {_doubles(*_AMOUNTS[:-1])}, payment_method, channel,
       CASE WHEN return_flag THEN 'Y' ELSE 'N' END AS return_flag, transaction_status
FROM txns"""),
    "bronze_stamp": """SELECT c_custkey AS customer_id, 'customer_dim.csv' AS _source_file,
       '2001-08-02 02:00:00' AS _ingested_at, DATE '2001-08-02' AS _batch_date
FROM customer""",
    "bronze_load": ("WITH " + _CALENDAR + """, counts AS (
  SELECT 'bronze_customer_dim' AS table_name, COUNT(*) AS row_count FROM customer
  UNION ALL SELECT 'bronze_item_dim', COUNT(*) FROM part
  UNION ALL SELECT 'bronze_store_dim', COUNT(*) FROM supplier
  UNION ALL SELECT 'bronze_time_dim', COUNT(*) FROM calendar
  UNION ALL SELECT 'bronze_transactions', COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT * FROM counts
UNION ALL SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM counts"""),
    "sink_overwrite": _with(_CUSTOMERS, "SELECT * FROM customers"),
    "sink_append": """SELECT d AS _batch_date, s_suppkey AS store_id, s_name AS store_name,
       'store_dim.csv' AS _source_file
FROM supplier JOIN (VALUES (DATE '2001-08-02'), (DATE '2001-08-03')) AS days(d) ON TRUE""",
    "audit_counts": ("WITH " + _CALENDAR + """, counts AS (
  SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM customer
  UNION ALL SELECT 'items', COUNT(*) FROM part
  UNION ALL SELECT 'stores', COUNT(*) FROM supplier
  UNION ALL SELECT 'calendar', COUNT(*) FROM calendar
  UNION ALL SELECT 'txns', COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT * FROM counts
UNION ALL SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM counts"""),
    "preview_top_categories": _with(_FACT, f"""SELECT category, total_revenue, profit_margin_pct,
       units_sold
FROM ({_CATEGORY})
ORDER BY revenue_rank, category, sub_category, price_band LIMIT 5"""),
    "preview_transactions": _with(_TXNS, f"""SELECT transaction_id, item_id, store_id,
       {_doubles("total_amount")}, quantity, channel
FROM txns ORDER BY transaction_id, item_id, store_id, txns.total_amount LIMIT 5"""),
    "dim_calendar": _with(_CALENDAR, """SELECT * REPLACE (
       CASE WHEN is_weekend THEN 'Y' ELSE 'N' END AS is_weekend,
       CASE WHEN is_holiday THEN 'Y' ELSE 'N' END AS is_holiday)
FROM calendar"""),
    "dim_calendar_between": _with(
        _calendar("DATE '1996-01-01'", "DATE '1997-12-31'"),
        """SELECT date_id, full_date, fiscal_quarter,
       CASE WHEN is_holiday THEN 'Y' ELSE 'N' END AS is_holiday, orders
FROM calendar LEFT JOIN (
  SELECT CAST(o_orderdate AS DATE) AS full_date, COUNT(*) AS orders FROM orders GROUP BY 1
) USING (full_date)"""),
    "txn_pricing": _with(_txns(tax_rate="CAST(0.08 AS DECIMAL(9, 4))"), f"""SELECT transaction_id,
       item_id, line, quantity, {_doubles(*_AMOUNTS[:-1])}
FROM txns"""),
    # Projections and scalar functions.
    "silver_casts": _with(_TXNS, f"""SELECT transaction_id, customer_id, item_id, store_id,
       date_id, quantity, {_doubles(*_AMOUNTS[:-1])}, payment_method, channel, return_flag,
       transaction_status
FROM txns"""),
    "fn_string_clean": _with(_CUSTOMERS, "SELECT customer_id, full_name, email, country FROM customers"),
    "fn_dates": f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_id,
       CAST(datediff('day', CAST(o_orderdate AS DATE), {AS_OF}) AS INT) AS days_ago,
       CAST(isodow(o_orderdate) AS INT) AS iso_weekday
FROM orders""",
    "fn_margin": _with(_ITEMS, f"""SELECT item_id, {_doubles("unit_price", "cost_price")},
       margin_pct
FROM items"""),
    "fn_age_band": _with(_CUSTOMERS, "SELECT customer_id, age, age_band FROM customers"),
    "fn_price_band": _with(_ITEMS, f"SELECT item_id, {_doubles('unit_price')}, price_band FROM items"),
    "fn_rfm_segment": f"""SELECT customer_id, orders, CAST(spend AS DOUBLE) AS spend, recency_days,
       CASE WHEN orders >= 12 AND spend >= 3000000 THEN 'Champion'
            WHEN orders >= 8 AND recency_days <= 60 THEN 'Loyal'
            WHEN recency_days > 180 THEN 'At Risk' ELSE 'Regular' END AS rfm_segment
FROM (
  SELECT o_custkey AS customer_id, COUNT(*) AS orders,
         SUM(CAST(o_totalprice AS {D2})) AS spend,
         CAST(datediff('day', CAST(MAX(o_orderdate) AS DATE), {AS_OF}) AS INT) AS recency_days
  FROM orders GROUP BY o_custkey)""",
    "fn_boolean_flags": """SELECT c_custkey AS customer_id, c_acctbal >= 0 AS is_active,
       CAST(c_acctbal >= 0 AS INT) AS active_int
FROM customer""",
    "fn_profit": _with(_txns(cost_factor="0.6"), f"""SELECT transaction_id, item_id,
       {_doubles("net_amount", "profit_amount")}
FROM txns"""),
    "fn_tenure_years": _with(_CUSTOMERS, "SELECT customer_id, join_date, tenure_years FROM customers"),
    "fn_name_email": """SELECT c_custkey AS customer_id, replace(c_name, '#', ' ') AS full_name,
       lower(replace(c_name, '#', '.')) || c_custkey || '@email.com' AS email
FROM customer""",
    # Joins.
    "join_left_customer": _with(_FACT, f"""SELECT transaction_id, customer_id, full_name, city, state,
       loyalty_tier, age_band, gender, {_doubles("total_amount")}
FROM fact"""),
    "join_left_item": _with(_FACT, f"""SELECT transaction_id, item_id, item_name, category,
       sub_category, price_band, {_doubles("total_amount")}
FROM fact"""),
    "join_left_store": _with(_FACT, f"""SELECT transaction_id, store_id, store_name, store_type,
       region, {_doubles("total_amount")}
FROM fact"""),
    "join_left_calendar": _with(_FACT, f"""SELECT transaction_id, date_id, full_date, day_name,
       month_name, month, quarter, year, is_weekend, is_holiday, {_doubles("total_amount")}
FROM fact"""),
    "join_anti_orphans": _with(_TXNS, f"""SELECT transaction_id, customer_id, item_id,
       {_doubles("total_amount")}
FROM txns
WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_custkey = customer_id AND c_acctbal >= 0)"""),
    # Aggregates and windows.
    "agg_global": _with(_TXNS, f"""SELECT COUNT(*) AS lines, {_REV} AS total_revenue,
       {_ratio("SUM(total_amount)", "COUNT(total_amount)")} AS avg_order_value, {_UNITS} AS units
FROM txns"""),
    "agg_grouped": _with(_TXNS, f"""SELECT payment_method, channel, transaction_status,
       COUNT(transaction_id) AS lines, {_REV} AS total_revenue, {_PROFIT} AS total_profit,
       {_ratio("SUM(discount_pct)", "COUNT(discount_pct)")} AS avg_discount_pct
FROM txns GROUP BY payment_method, channel, transaction_status"""),
    "agg_count_distinct": _with(_TXNS, f"""SELECT channel, {_SALES} AS transactions,
       {_BUYERS} AS customers
FROM txns GROUP BY channel"""),
    "agg_conditional_count": _with(_TXNS, f"""SELECT store_id, {_RETURNS} AS returns,
       COUNT(*) AS lines
FROM txns GROUP BY store_id"""),
    "agg_min_max_date": """SELECT o_custkey AS customer_id,
       CAST(MIN(o_orderdate) AS DATE) AS first_purchase_date,
       CAST(MAX(o_orderdate) AS DATE) AS last_purchase_date
FROM orders GROUP BY o_custkey""",
    "agg_safe_ratio": _with(_TXNS, f"""SELECT item_id, channel,
       CAST(SUM(discount_amount) AS DOUBLE) AS discount, CAST(SUM(tax_amount) AS DOUBLE) AS tax,
       {_percent("SUM(discount_amount)", "SUM(tax_amount)")} AS discount_per_tax_pct
FROM txns GROUP BY item_id, channel"""),
    "distinct_keys": """SELECT DISTINCT o_custkey AS customer_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "dedup_latest": _with(_TXNS, f"""SELECT transaction_id, date_id, {_doubles("total_amount")},
       item_id, store_id, quantity
FROM txns
QUALIFY ROW_NUMBER() OVER (
  PARTITION BY transaction_id
  ORDER BY date_id DESC, total_amount DESC, item_id DESC, store_id DESC, quantity DESC) = 1"""),
    "win_rank_category": _with(_FACT, f"""SELECT category, sub_category, price_band, total_revenue,
       CAST(revenue_rank AS INT) AS revenue_rank
FROM ({_CATEGORY})"""),
    # Silver and gold tables.
    "silver_customer": _with(_CUSTOMERS, "SELECT * FROM customers"),
    "silver_item": _with(_ITEMS, _replace_doubles("items", ("unit_price", "cost_price"))),
    "silver_store": _with(_STORES, "SELECT * FROM stores"),
    "silver_calendar": _with(_CALENDAR, "SELECT * FROM calendar"),
    "silver_transactions": _with(
        _TXNS, _replace_doubles("txns", _AMOUNTS, "EXCLUDE (line, tax_rate)")),
    "gold_fact_sales": _with(_FACT, _replace_doubles("fact", _AMOUNTS)),
    "gold_sales_daily": _with(_FACT, _DAILY),
    "gold_sales_by_category": _with(
        _FACT, f"SELECT * REPLACE (CAST(revenue_rank AS INT) AS revenue_rank) FROM ({_CATEGORY})"),
    "gold_customer_summary": _with(_FACT, _SUMMARY),
    # Views and analytics queries.
    "v1_executive_kpis": _with(_FACT, _KPIS),
    "v2_revenue_by_category": _with(_FACT, _BY_CATEGORY),
    "v3_monthly_trend": _with(_FACT, _TREND),
    "v4_top_customers": _with(_FACT, f"""SELECT customer_id, full_name, city, state, loyalty_tier,
       age_band, {_REV} AS total_spend, {_SALES} AS total_orders, {_AVG_SALE} AS avg_order_value,
       MAX(full_date) AS last_purchase_date
FROM fact GROUP BY customer_id, full_name, city, state, loyalty_tier, age_band
ORDER BY total_spend DESC, customer_id LIMIT 50"""),
    "v5_store_performance": _with(_FACT, f"""SELECT store_id, store_name, store_type, region,
       {_REV} AS total_revenue, {_PROFIT} AS total_profit, {_SALES} AS transaction_count,
       {_BUYERS} AS unique_customers, {_AVG_SALE} AS avg_order_value, {_MARGIN} AS margin_pct
FROM fact GROUP BY store_id, store_name, store_type, region"""),
    "q1_kpi_summary": _with(_FACT, _KPIS),
    "q2_top_categories": _with(_FACT, f"""SELECT category, total_revenue, margin_pct, units_sold
FROM ({_BY_CATEGORY}) ORDER BY total_revenue DESC, category LIMIT 5"""),
    "q3_mom_growth": _with(_FACT, f"""SELECT year, month, month_name, monthly_revenue,
       prev_month_revenue,
       {_percent("(monthly_revenue - prev_month_revenue)", "prev_month_revenue", 1)} AS mom_growth_pct
FROM (
  SELECT *, LAG(monthly_revenue) OVER (ORDER BY year, month) AS prev_month_revenue
  FROM ({_TREND}))"""),
    "q4_channel": _with(_FACT, f"""SELECT channel, {_SALES} AS orders, {_REV} AS revenue,
       {_AVG_SALE} AS avg_order_value
FROM fact GROUP BY channel"""),
    "q5_weekend": _with(_FACT, f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {_SALES} AS transactions, {_REV} AS total_revenue, {_AVG_SALE} AS avg_order_value
FROM fact GROUP BY is_weekend"""),
    "q6_loyalty_breakdown": _with(_FACT, f"""SELECT loyalty_tier, {_BUYERS} AS customers,
       {_REV} AS revenue, {_AVG_SALE} AS avg_order_value,
       {_percent("SUM(total_amount)", "(SELECT SUM(total_amount) FROM fact)", 1)} AS revenue_pct
FROM fact GROUP BY loyalty_tier"""),
    "q7_top_items": _with(_FACT, f"""SELECT item_name, category, {_UNITS} AS units_sold,
       {_REV} AS revenue, {_AVG_DISCOUNT} AS avg_discount_pct
FROM fact GROUP BY item_name, category ORDER BY revenue DESC, item_name, category LIMIT 10"""),
    "q8_region": _with(_FACT, f"""SELECT region, COUNT(DISTINCT store_id) AS store_count,
       {_REV} AS total_revenue, {_BUYERS} AS customers, {_AVG_SALE} AS avg_order_value
FROM fact GROUP BY region"""),
    # Data quality.
    "dq_not_null": _with(_STAR, _report("not_null")),
    "dq_range": _with(_STAR, _report("range")),
    "dq_positive": _with(_STAR, _report("positive")),
    "dq_column_compare": _with(_STAR, _report("compare")),
    "dq_domain": _with(_STAR, _report("domain")),
    "dq_unique": _with(_STAR, _report("unique")),
    "dq_ref_integrity": _with(_STAR, _report("reference", more=(
        _check("customer_id active", "txns",
               _orphans("customer_id", "(SELECT customer_id FROM customers WHERE is_active)")),
    ))),
    "dq_more_rules": _with(_STAR, _report(more=_MORE_CHECKS)),
    "dq_report": _with(_STAR, _FULL_REPORT),
    "dq_summary": _with(_STAR, f"SELECT status, COUNT(*) AS checks FROM ({_FULL_REPORT}) GROUP BY status"),
    "dq_failures": _with(_STAR, f"SELECT * FROM ({_FULL_REPORT}) WHERE status = 'FAIL'"),
    "dq_gate": _with(_STAR, f"""SELECT COUNT(*) FILTER (WHERE status = 'FAIL') > 0 AS blocked,
       COUNT(*) FILTER (WHERE status = 'FAIL') AS failed_checks, COUNT(*) AS checks
FROM ({_FULL_REPORT})"""),
    # The whole job and the alerts.
    "medallion_e2e": ("WITH " + _FACT + f""", tables AS (
  SELECT 'gold_fact_sales' AS table_name, (SELECT COUNT(*) FROM fact) AS row_count
  UNION ALL SELECT 'gold_sales_daily', (SELECT COUNT(*) FROM ({_DAILY}))
  UNION ALL SELECT 'gold_sales_by_category', (SELECT COUNT(*) FROM ({_CATEGORY}))
  UNION ALL SELECT 'gold_customer_summary', (SELECT COUNT(*) FROM ({_SUMMARY})))
SELECT table_name, row_count, (SELECT {_REV} FROM fact) AS revenue FROM tables"""),
    "alert_daily_revenue": _with(_FACT, f"""SELECT full_date, total_revenue,
       CAST(1000000 AS DOUBLE) AS target, {_round("1000000 - total_revenue", 2)} AS shortfall
FROM ({_DAILY}) WHERE total_revenue < 1000000"""),
    "alert_daily_revenue_stream": f"""SELECT full_date, total_revenue,
       CAST(3000 AS DOUBLE) AS target, {_round("3000 - total_revenue", 2)} AS shortfall
FROM (
  SELECT CAST(ts AS DATE) AS full_date, CAST(SUM(CAST(value AS {D2})) AS DOUBLE) AS total_revenue
  FROM events WHERE event_type = 'purchase' GROUP BY 1)
WHERE total_revenue < 3000
  AND full_date + INTERVAL 2 DAY <= (SELECT MAX(ts) FROM events WHERE event_type = 'purchase')""",
}


# Of every tenth order only the lines that came again are left, if any did; a seventh of the customers rose.
_REFRESHED = _FACT.replace(
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
    """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_orderkey % 10 <> 0 OR l_quantity <= 25
     OR l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity <= 25))""",
).replace("c.loyalty_tier,", "CASE WHEN c.customer_id % 7 = 0 THEN 'Gold' ELSE c.loyalty_tier END AS loyalty_tier,")


def _placed(keys: str, select: str, order: str) -> str:
    return f"SELECT {keys}, CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INT) AS place FROM ({select})"


_CHANNEL = f"SELECT channel, {_REV} AS revenue FROM fact GROUP BY channel"
_REGION = f"SELECT region, {_REV} AS total_revenue FROM fact GROUP BY region"

# Lines of which some name a customer, item, store or day that is not there.
_LOST = {"customer_id": ("NULL", 0), "item_id": ("-1", 1), "store_id": ("-1", 2), "date_id": ("-1", 3)}
_LOST_KEYS = ", ".join(
    f"CASE WHEN transaction_id % 7 = {rest} THEN {value} ELSE {key} END AS {key}"
    for key, (value, rest) in _LOST.items()
)
_SOUND = re.sub(r"^(customers|items|txns) AS", r"sound_\1 AS", _STAR, flags=re.MULTILINE)
_PLANTED = f"""{_SOUND},
customers AS (SELECT * REPLACE (CASE WHEN customer_id % 5 <> 0 THEN email END AS email,
                                CASE WHEN customer_id % 9 = 0 THEN 17 ELSE age END AS age) FROM sound_customers),
items AS (SELECT * REPLACE (CASE WHEN item_id % 4 <> 0 THEN category END AS category,
                            CASE WHEN item_id % 6 = 0 THEN 0 ELSE unit_price END AS unit_price) FROM sound_items),
txns AS (SELECT * REPLACE ({_LOST_KEYS}, CASE WHEN transaction_id % 11 = 0 THEN 0 ELSE quantity END AS quantity,
                           CASE WHEN transaction_id % 13 = 0 THEN 2 ELSE discount_pct END AS discount_pct)
         FROM sound_txns)"""

ORACLE |= {
    "catalog_executive_kpis": ORACLE["v1_executive_kpis"],
    "catalog_revenue_by_category": ORACLE["v2_revenue_by_category"],
    "catalog_monthly_trend": ORACLE["v3_monthly_trend"],
    "catalog_top_customers": ORACLE["v4_top_customers"],
    "catalog_store_performance": ORACLE["v5_store_performance"],
    "order_sales_daily": _with(_FACT, _placed("full_date", _DAILY, "full_date")),
    "order_mom_growth": _with(_FACT, _placed("year, month", _TREND, "year, month")),
    "order_channel": _with(_FACT, _placed("channel", _CHANNEL, "revenue DESC, channel")),
    "order_region": _with(_FACT, _placed("region", _REGION, "total_revenue DESC, region")),
    "join_left_orphans": _with(_STAR, f"""SELECT c.full_name IS NULL AS no_customer,
       i.item_name IS NULL AS no_item, s.store_name IS NULL AS no_store, d.day_name IS NULL AS no_day,
       COUNT(*) AS lines, CAST(SUM(total_amount) AS DOUBLE) AS revenue
FROM (SELECT * REPLACE ({_LOST_KEYS}) FROM txns) t
LEFT JOIN customers c ON t.customer_id = c.customer_id LEFT JOIN items i ON t.item_id = i.item_id
LEFT JOIN stores s ON t.store_id = s.store_id LEFT JOIN calendar d ON t.date_id = d.date_id
GROUP BY ALL"""),
    "dq_planted": _with(_PLANTED, _FULL_REPORT),
    "silver_bad_text": f"""SELECT s_suppkey AS store_id,
       CASE WHEN s_suppkey % 2 <> 0 THEN CAST(2000 + (s_suppkey * 37) % 18001 AS INT) END AS sq_footage,
       CASE WHEN s_suppkey % 3 <> 0 THEN DATE '1990-01-01' + CAST(s_suppkey % 3653 AS INT) END AS open_date,
       CASE WHEN s_suppkey % 5 <> 0 THEN true END AS is_active, CAST(13 AS INT) AS width
FROM supplier""",
    "dedup_null_keys": _with(_TXNS, f"""SELECT transaction_id, date_id, {_doubles("total_amount")},
       item_id, store_id, quantity
FROM (SELECT * REPLACE (CASE WHEN transaction_id % 4 <> 0 THEN transaction_id END AS transaction_id) FROM txns)
QUALIFY transaction_id IS NULL OR ROW_NUMBER() OVER (
  PARTITION BY transaction_id
  ORDER BY date_id DESC, total_amount DESC, item_id DESC, store_id DESC, quantity DESC) = 1"""),
    "fn_profit_four_digits": _with(_txns(cost_factor="0.5531"), f"""SELECT transaction_id, item_id,
       {_doubles("net_amount", "profit_amount")}
FROM txns"""),
    "medallion_append_all": f"""WITH {_CALENDAR}, parts AS (
  SELECT 'bronze 2001-08-02' AS part, COUNT(*) FILTER (l_orderkey % 2 = 0) AS row_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'bronze 2001-08-03', COUNT(*) FILTER (l_orderkey % 2 <> 0)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
silver AS (
  SELECT 'silver_customer_dim' AS part, COUNT(*) AS row_count FROM customer
  UNION ALL SELECT 'silver_item_dim', COUNT(*) FROM part
  UNION ALL SELECT 'silver_store_dim', COUNT(*) FROM supplier
  UNION ALL SELECT 'silver_time_dim', COUNT(*) FROM calendar
  UNION ALL SELECT 'silver_transactions', COUNT(DISTINCT l_orderkey)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT * FROM parts UNION ALL SELECT * FROM silver
UNION ALL SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM silver
UNION ALL SELECT 'new managers', COUNT(*) FROM supplier WHERE s_suppkey % 2 = 0""",
    "medallion_refresh": _with(_REFRESHED, _SUMMARY),
    "medallion_refresh_daily": _with(_REFRESHED, _DAILY),
    "medallion_refresh_tables": f"""WITH {_REFRESHED}
SELECT table_name, row_count, (SELECT {_REV} FROM fact) AS revenue FROM (
  SELECT 'gold_fact_sales' AS table_name, (SELECT COUNT(*) FROM fact) AS row_count
  UNION ALL SELECT 'gold_sales_daily', (SELECT COUNT(*) FROM ({_DAILY}))
  UNION ALL SELECT 'gold_sales_by_category', (SELECT COUNT(*) FROM ({_CATEGORY}))
  UNION ALL SELECT 'gold_customer_summary', (SELECT COUNT(*) FROM ({_SUMMARY})))""",
    "medallion_columns": ORACLE["gold_customer_summary"],
    "win_rank_items": _with(_TXNS, f"""SELECT item_id, {_REV} AS total_revenue,
       RANK() OVER (ORDER BY {_REV} DESC) AS revenue_rank
FROM txns GROUP BY item_id"""),
    "alert_repeated_events": ORACLE["alert_daily_revenue_stream"],
    "quarantine_lines": f"""WITH {_RAW_CUSTOMERS}, marked AS (
  SELECT customer_id, customer_id % 50 = 0 AS bad_age, customer_id % 75 = 0 AS bad_day FROM raw_customers),
parts AS (
  SELECT CASE WHEN bad_age AND bad_day THEN 'does not parse: age, join_date' WHEN bad_age THEN 'does not parse: age'
              WHEN bad_day THEN 'does not parse: join_date' ELSE 'readable' END AS part, customer_id FROM marked)
SELECT part, COUNT(*) AS lines, CAST(SUM(customer_id) AS BIGINT) AS ids FROM parts GROUP BY part
UNION ALL SELECT CASE WHEN COUNT(*) FILTER (bad_age OR bad_day) > 0 THEN 'lines readable FAIL' ELSE 'lines readable PASS' END,
       COUNT(*), COUNT(*) FILTER (bad_age OR bad_day) FROM marked""",
    "sink_publish": f"""WITH {_RAW_CUSTOMERS} SELECT * REPLACE (upper(city) AS city) FROM raw_customers""",
    "agg_distinct_bitmaps": _with(_TXNS, """SELECT date_id // 100 AS month, COUNT(DISTINCT customer_id) AS customers,
       COUNT(DISTINCT item_id) AS items
FROM txns GROUP BY 1"""),
    "join_colocated_customer": _with(_STAR, f"""SELECT t.transaction_id, t.date_id, t.item_id, t.customer_id,
       c.full_name, c.city, c.state, c.loyalty_tier, c.age_band, c.gender, {_doubles("total_amount")}
FROM (SELECT * REPLACE (CASE WHEN transaction_id % 3 = 0 THEN 1 WHEN transaction_id % 7 <> 0 THEN customer_id
                             WHEN transaction_id % 2 = 0 THEN -1 END AS customer_id) FROM txns) t
LEFT JOIN customers c ON t.customer_id = c.customer_id"""),
    "medallion_colocated": _with(_STAR, f"""SELECT c.country, CAST(year(c.join_date) AS INT) AS joined,
       c.loyalty_tier, COUNT(*) AS lines, {_REV} AS revenue
FROM txns t LEFT JOIN customers c ON t.customer_id = c.customer_id GROUP BY ALL"""),
}
