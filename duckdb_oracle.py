"""The same queries as ANSI SQL for DuckDB, written apart from the Spark code.

Each oracle is a chain of common table expressions over the test tables. Money
and percentages end as DOUBLE after exact decimal or integer rounding, counts as
BIGINT. Percentages and averages are rounded in whole hundredths, half away from
zero, because a DOUBLE quotient cannot be.
"""

from __future__ import annotations


def _hundredths(top: str, bottom: str, scale: int = 1) -> str:
    """``scale * top / bottom`` in whole hundredths, rounded half away from zero."""
    n = f"(({top}) * 100)::HUGEINT"
    d = f"(({bottom}) * 100)::HUGEINT"
    exact = f"(abs({n}) * {2 * 100 * scale} + abs({d})) // (2 * abs({d}))"
    sign = f"CASE WHEN (({top}) < 0) <> (({bottom}) < 0) THEN -1 ELSE 1 END"
    return f"(CASE WHEN ({bottom}) = 0 THEN NULL ELSE ({sign}) * ({exact}) END)"


def _as_double(hundredths: str) -> str:
    return f"(({hundredths})::DECIMAL(18,0) / 100.0)::DOUBLE"


def _percent(part: str, whole: str) -> str:
    return _as_double(_hundredths(part, whole, 100))


def _ratio(top: str, bottom: str) -> str:
    return _as_double(_hundredths(top, bottom))


_ORDERS_KEYED = """
keyed AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate, o_orderkey % 20 < 7 AS legacy,
         (SELECT count(*) FROM part) AS parts
  FROM orders),
first_write AS (
  SELECT k, legacy,
         CAST(k AS VARCHAR) AS order_id,
         CAST(CASE WHEN NOT legacy AND k % 97 = 8 THEN o_custkey + 10000000 ELSE o_custkey END AS VARCHAR) AS customer_id,
         CAST(CASE WHEN NOT legacy AND k % 89 = 9 THEN k + 10000000 ELSE k % parts END AS VARCHAR) AS product_id,
         CAST(1 + k % 5 AS INTEGER) AS quantity,
         CASE WHEN legacy THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN k % 33 = 0 THEN o_orderdate + to_days(CAST(35 + k % 36 AS INTEGER))
              WHEN k % 101 = 50 THEN o_orderdate + to_days(30)
              ELSE o_orderdate + to_hours(CAST(k % 5 AS INTEGER)) END AS load_timestamp,
         CASE WHEN legacy THEN 'legacy_pos' ELSE 'web_platform' END AS source_system
  FROM keyed),
all_writes AS (
  SELECT * FROM first_write
  UNION ALL
  SELECT * REPLACE (load_timestamp + to_seconds(CAST(5 + k % 86 AS INTEGER)) AS load_timestamp)
  FROM first_write WHERE legacy AND k % 40 = 5)"""

_RAW_ORDERS = (
    _ORDERS_KEYED
    + """,
orders_raw AS (
  SELECT order_id, customer_id, product_id, quantity, order_date, load_timestamp, source_system FROM all_writes)"""
)

# What arrived before the second delivery.
_FIRST_DELIVERY = _ORDERS_KEYED + """,
orders_raw AS (
  SELECT order_id, customer_id, product_id, quantity, order_date, load_timestamp, source_system FROM all_writes
  WHERE load_timestamp < TIMESTAMP '2001-01-01 00:00:00')"""

_RAW_ORDERS_BAD = (
    _ORDERS_KEYED
    + """,
orders_raw AS (
  SELECT order_id, customer_id, product_id, quantity,
         CASE WHEN k % 509 = 1 THEN '13/45/2024' WHEN k % 499 = 3 THEN NULL ELSE order_date END AS order_date,
         load_timestamp,
         CASE WHEN k % 503 = 2 THEN 'kiosk' ELSE source_system END AS source_system
  FROM all_writes)"""
)

_STG_ORDERS = """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY load_timestamp NULLS LAST,
           customer_id NULLS FIRST, product_id NULLS FIRST, quantity NULLS FIRST, order_date NULLS FIRST,
           source_system NULLS FIRST) AS rn
  FROM orders_raw),
parsed AS (
  SELECT * REPLACE (
           CAST(CASE WHEN source_system = 'legacy_pos' THEN try_strptime(order_date, '%m/%d/%Y')
                     WHEN source_system = 'web_platform' THEN try_strptime(order_date, '%Y-%m-%d') END AS DATE)
           AS order_date),
         order_date AS raw_date
  FROM numbered WHERE rn = 1),
stg_orders AS (
  SELECT order_id, customer_id, product_id, quantity, order_date, load_timestamp, source_system,
         date_diff('day', order_date, CAST(load_timestamp AS DATE)) > 30 AS is_late_arriving
  FROM parsed)"""

_DIMENSIONS = """
stg_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         lower(c_name) || '@example.com' AS email,
         r_name AS region,
         CAST(DATE '2024-01-01' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS DATE) AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
priced AS (
  SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part),
stg_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, trim(p_name, ' ') AS product_name, trim(p_type, ' ') AS category,
         CAST(CAST((cents * (30 + p_partkey % 80)) // 100 AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS unit_cost,
         CAST(CAST(cents AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS unit_price
  FROM priced)"""

_VALIDATED = """,
int_orders_validated AS (
  SELECT o.*, c.customer_id IS NOT NULL AS is_valid_customer, p.product_id IS NOT NULL AS is_valid_product,
         p.category, p.unit_price, p.unit_cost, c.region
  FROM stg_orders o
  LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN stg_products p ON o.product_id = p.product_id)"""

_FACT = """,
fct_orders AS (
  SELECT order_id, customer_id, product_id, order_date, source_system, is_late_arriving, category, region,
         quantity, unit_price, unit_cost,
         CAST(quantity * unit_price AS DECIMAL(18,2)) AS revenue,
         CAST(quantity * (unit_price - unit_cost) AS DECIMAL(18,2)) AS gross_margin
  FROM int_orders_validated WHERE is_valid_customer AND is_valid_product)"""

_DAILY = """,
daily AS (
  SELECT order_date, sum(revenue) AS revenue, count(order_id) AS n FROM fct_orders GROUP BY order_date)"""

_SEGMENTS = """,
segments AS (
  SELECT region, category, sum(revenue) AS revenue, sum(gross_margin) AS margin, count(order_id) AS n
  FROM fct_orders GROUP BY region, category)"""

_STAGED = f"WITH {_RAW_ORDERS}{_STG_ORDERS}"
_STAGED_BAD = f"WITH {_RAW_ORDERS_BAD}{_STG_ORDERS}"
_JOINED = f"{_STAGED},{_DIMENSIONS}{_VALIDATED}"
_FACTS = f"{_JOINED}{_FACT}"
_BY_SEGMENT = f"{_FACTS}{_SEGMENTS}"
_PRODUCT_COLUMNS = "product_id, product_name, category, unit_cost::DOUBLE AS unit_cost, unit_price::DOUBLE AS unit_price"


def _trends(frame: str, order: str, days: str, by: str = "") -> str:
    """Trailing sums and averages; ``frame`` is ROWS or RANGE."""
    source = f"SELECT {by} order_date, sum(revenue) AS revenue, count(order_id) AS n FROM fct_orders GROUP BY ALL"
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    windows = ", ".join(
        f"w{n} AS ({part} ORDER BY {order} {frame} BETWEEN {days.format(n - 1)} PRECEDING AND CURRENT ROW)"
        for n in (7, 30)
    )
    columns = ", ".join(
        f"CAST(sum(revenue) OVER w{n} AS DOUBLE) AS revenue_rolling_{n}d, "
        f"sum(revenue) OVER w{n} AS s{n}, count(*) OVER w{n} AS c{n}"
        for n in (7, 30)
    )
    return f"""{_FACTS},
series AS ({source}),
framed AS (SELECT *, {columns} FROM series WINDOW {windows})
SELECT {by} order_date, revenue::DOUBLE AS daily_revenue, n AS daily_order_count,
       revenue_rolling_7d, revenue_rolling_30d,
       {_ratio('s7', 'c7')} AS avg_daily_revenue_7d, {_ratio('s30', 'c30')} AS avg_daily_revenue_30d
FROM framed"""


def _event_trends() -> str:
    """Trailing sums of whole cents, and their averages rounded half away from zero."""
    columns = ", ".join(
        f"(sum(cents) OVER w{n})::DECIMAL(18,0) / 100.0 AS s{n}, sum(cents) OVER w{n} AS t{n}, count(cents) OVER w{n} AS c{n}"
        for n in (7, 30)
    )
    windows = ", ".join(f"w{n} AS (ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (7, 30))
    mean = "(CASE WHEN t{0} < 0 THEN -1 ELSE 1 END * ((2 * abs(t{0}) + c{0}) // (2 * c{0})))::DECIMAL(18,0) / 100.0"
    results = ", ".join(
        f"s{n}::DOUBLE AS amount_rolling_{n}, ({mean.format(n)})::DOUBLE AS avg_amount_{n}" for n in (7, 30)
    )
    return f"""
WITH e AS (SELECT event_id, ts, CAST(floor(value * 100) AS BIGINT) AS cents FROM events),
framed AS (SELECT *, {columns} FROM e WINDOW {windows})
SELECT event_id, ts, (cents::DECIMAL(18,0) / 100.0)::DOUBLE AS amount, {results} FROM framed"""


def _monthly(select_from: str = "fct_orders") -> str:
    return f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, region, category,
       count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
       sum(revenue)::DOUBLE AS total_revenue, sum(gross_margin)::DOUBLE AS total_gross_margin,
       {_percent('sum(gross_margin)', 'sum(revenue)')} AS margin_pct
FROM {select_from} GROUP BY 1, 2, 3"""


def _top(n: int) -> str:
    return f"""{_BY_SEGMENT},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY revenue DESC, category) AS rank FROM segments),
top AS (SELECT * FROM ranked WHERE rank <= {n})"""


def _heatmap(categories: list[str]) -> str:
    columns = ", ".join(f"sum(CASE WHEN category = '{c}' THEN revenue END)::DOUBLE AS \"{c}\"" for c in categories)
    known = ", ".join(f"'{c}'" for c in categories)
    others = f"sum(CASE WHEN category IS NULL OR category NOT IN ({known}) THEN revenue END)::DOUBLE AS others"
    return f"{_BY_SEGMENT} SELECT region, {columns}, {others} FROM segments GROUP BY region"


def _sumif(regions: list[str]) -> str:
    columns = ", ".join(f"sum(CASE WHEN region = '{r}' THEN revenue END)::DOUBLE AS \"{r}\"" for r in regions)
    return f"""{_BY_SEGMENT}
SELECT category, {columns}, sum(revenue)::DOUBLE AS total_revenue FROM segments GROUP BY category"""


_MEASURES = {
    "total_revenue": "sum(revenue)",
    "gross_margin": "sum(margin)",
    "margin_pct": _hundredths("sum(margin)", "sum(revenue)", 100),
    "order_count": "sum(n)",
}


def _performers() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{dimension}' AS dimension, '{measure}' AS measure, {dimension} AS name, "
        f"CAST({value} AS DECIMAL(30,2)) AS v FROM segments GROUP BY {dimension}"
        for dimension in ("region", "category")
        for measure, value in _MEASURES.items()
    )
    return f"""{_BY_SEGMENT},
long AS ({rows}),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY dimension, measure ORDER BY v DESC, name) AS t,
         row_number() OVER (PARTITION BY dimension, measure ORDER BY v, name) AS b
  FROM long WHERE name IS NOT NULL AND v IS NOT NULL)
SELECT dimension, measure, max(CASE WHEN t = 1 THEN name END) AS top_name,
       max(CASE WHEN b = 1 THEN name END) AS bottom_name
FROM placed GROUP BY dimension, measure"""


def _test_rows() -> str:
    keys = {
        "stg_customers": "customer_id",
        "stg_products": "product_id",
        "stg_orders": "order_id",
        "int_orders_validated": "order_id",
        "dim_customers": "customer_id",
        "dim_products": "product_id",
        "fct_orders": "order_id",
    }
    parts = []
    for table, key in keys.items():
        source = table.replace("dim_", "stg_")
        parts.append(
            f"SELECT '{table}' AS table_name, 'unique' AS test, '{key}' AS column_name, count(*) AS failures FROM "
            f"(SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
        )
        parts.append(f"SELECT '{table}', 'not_null', '{key}', count(*) FROM {source} WHERE {key} IS NULL")
    parts.append("SELECT 'stg_orders', 'not_null', 'order_date', count(*) FROM stg_orders WHERE order_date IS NULL")
    for key, parent in (("customer_id", "stg_customers"), ("product_id", "stg_products")):
        parts.append(
            f"SELECT 'fct_orders', 'relationships', '{key}', count(*) FROM fct_orders f WHERE {key} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = f.{key})"
        )
    return " UNION ALL ".join(parts)


def oracle_sql(categories: list[str], regions: list[str]) -> dict[str, str]:
    raw_columns = "order_id, customer_id, product_id, quantity, order_date, load_timestamp, source_system"
    bad_columns = raw_columns.split(", ")
    null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS failures FROM stg_orders WHERE {c} IS NULL" for c in bad_columns
    )
    segment = "region, category, "
    validated = (
        "SELECT * REPLACE (unit_price::DOUBLE AS unit_price, unit_cost::DOUBLE AS unit_cost) FROM int_orders_validated"
    )
    fact = (
        "SELECT * REPLACE (unit_price::DOUBLE AS unit_price, unit_cost::DOUBLE AS unit_cost, "
        "revenue::DOUBLE AS revenue, gross_margin::DOUBLE AS gross_margin) FROM fct_orders"
    )
    customers = f"WITH {_DIMENSIONS} SELECT * FROM stg_customers"
    products = f"WITH {_DIMENSIONS} SELECT {_PRODUCT_COLUMNS} FROM stg_products"
    relationship = (
        "{staged},{dims} SELECT order_id, {key} FROM stg_orders o WHERE {key} IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = o.{key})"
    )
    audit = """
SELECT count(*) AS staged, count(*) FILTER (NOT is_valid_customer) AS orphan_customer,
       count(*) FILTER (NOT is_valid_product) AS orphan_product,
       count(*) FILTER (NOT is_valid_customer AND NOT is_valid_product) AS orphan_both,
       count(*) FILTER (is_valid_customer AND is_valid_product) AS valid
FROM int_orders_validated"""
    duplicates = "count(*) AS raw_rows, count(DISTINCT order_id) AS distinct_ids, count(*) - count(DISTINCT order_id) AS duplicates"
    categories_cte = f"""{_BY_SEGMENT},
per_category AS (
  SELECT category, sum(revenue) AS revenue, sum(margin) AS margin,
         CAST({_hundredths('sum(margin)', 'sum(revenue)', 100)} AS BIGINT) AS pct
  FROM segments GROUP BY category),
lines AS (
  SELECT CAST({_hundredths('sum(margin)', 'sum(revenue)', 100)} AS BIGINT) AS overall,
         sum(pct) AS pct_sum, count(pct) AS pct_n
  FROM per_category)"""
    mean = "(CASE WHEN pct_sum < 0 THEN -1 ELSE 1 END) * ((2 * abs(pct_sum) + pct_n) // (2 * pct_n))"
    return {
        "raw_orders_scan": f"WITH {_RAW_ORDERS} SELECT {raw_columns} FROM orders_raw",
        "stg_customers": customers,
        "dim_customers": customers,
        "stg_products": products,
        "dim_products": products,
        "stg_orders": f"{_STAGED} SELECT * FROM stg_orders",
        "dedup_events": """
SELECT user_id, event_type, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS LAST, event_id NULLS FIRST) AS rn FROM events)
WHERE rn = 1""",
        "int_orders_validated": f"{_JOINED} {validated}",
        "fct_orders": f"{_FACTS} {fact}",
        "mart_monthly_kpis": f"{_FACTS} {_monthly()}",
        "daily_revenue": f"{_FACTS}{_DAILY} SELECT order_date, revenue::DOUBLE AS daily_revenue, n AS daily_order_count FROM daily",
        "revenue_trends": _trends("ROWS", "order_date", "{}"),
        "revenue_trends_calendar": _trends("RANGE", "order_date", "INTERVAL {} DAYS"),
        "revenue_trends_by_segment": _trends("ROWS", "order_date", "{}", segment),
        "test_unique": f"WITH {_RAW_ORDERS} SELECT order_id, count(*) AS n FROM orders_raw WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1",
        "test_not_null": f"{_STAGED_BAD} {null_rows}",
        "test_relationships": relationship.format(staged=_STAGED, dims=_DIMENSIONS, key="customer_id", parent="stg_customers"),
        "test_relationships_product": relationship.format(staged=_STAGED, dims=_DIMENSIONS, key="product_id", parent="stg_products"),
        "test_suite": f"{_FACTS} {_test_rows()}",
        "load_reconciliation": f"""WITH {_RAW_ORDERS},{_DIMENSIONS},
counts AS (
  SELECT 'customers' AS table_name, (SELECT count(*) FROM customer) AS expected_rows, (SELECT count(*) FROM stg_customers) AS actual_rows
  UNION ALL SELECT 'products', (SELECT count(*) FROM part), (SELECT count(*) FROM stg_products)
  UNION ALL SELECT 'orders_raw', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders_raw))
SELECT *, CASE WHEN expected_rows = actual_rows THEN 'OK' ELSE 'MISMATCH' END AS status FROM counts""",
        "orphan_audit": f"{_JOINED} {audit}",
        "duplicate_audit": f"WITH {_RAW_ORDERS} SELECT source_system, {duplicates} FROM orders_raw GROUP BY source_system",
        "duplicate_total": f"WITH {_RAW_ORDERS} SELECT {duplicates} FROM orders_raw",
        "late_arrival_report": f"""{_STAGED}
SELECT source_system, CAST(date_trunc('month', order_date) AS DATE) AS order_month, count(*) AS orders,
       count(*) FILTER (is_late_arriving) AS late_orders
FROM stg_orders GROUP BY 1, 2""",
        "bad_date_report": f"""{_STAGED_BAD}
SELECT order_id, source_system, raw_date,
       CASE WHEN raw_date IS NULL THEN 'missing'
            WHEN source_system IN ('legacy_pos', 'web_platform') THEN 'unparseable'
            ELSE 'unknown source' END AS reason
FROM parsed WHERE order_date IS NULL""",
        "kpi_scorecard": f"""{_FACTS}
SELECT sum(revenue)::DOUBLE AS total_revenue, count(order_id) AS order_count, sum(gross_margin)::DOUBLE AS gross_margin,
       {_percent('sum(gross_margin)', 'sum(revenue)')} AS margin_pct,
       {_ratio('sum(revenue)', 'count(order_id)')} AS avg_order_value
FROM fct_orders""",
        "margin_vs_revenue": f"""{categories_cte}
SELECT category, revenue::DOUBLE AS total_revenue, margin::DOUBLE AS gross_margin, {_as_double('pct')} AS margin_pct,
       {_as_double('overall')} AS overall_margin_pct, {_as_double(mean)} AS mean_category_margin_pct,
       {_as_double('pct - overall')} AS distance
FROM per_category, lines""",
        "region_category_heatmap": _heatmap(categories),
        "event_trends": _event_trends(),
        "customers_by_year": f"""{_FACTS}
SELECT year(order_date) AS order_year, region, count(DISTINCT customer_id) AS customers FROM fct_orders GROUP BY ALL""",
        "conditional_totals": _sumif(regions),
        "kpi_breakdowns": f"""{_BY_SEGMENT}
SELECT region, category,
       CASE WHEN grouping(region) = 0 THEN 'region' WHEN grouping(category) = 0 THEN 'category' ELSE 'total' END AS grouping_level,
       sum(revenue)::DOUBLE AS total_revenue, CAST(sum(n) AS BIGINT) AS order_count
FROM segments GROUP BY GROUPING SETS ((region), (category), ())""",
        "top_bottom_performers": _performers(),
        "top_categories_by_region": f"{_top(2)} SELECT region, category, revenue::DOUBLE AS total_revenue, rank FROM top",
        "consistent_top_categories": f"""{_top(4)}
SELECT category FROM top GROUP BY category HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT region FROM top))""",
        "csv_load": f"WITH {_RAW_ORDERS} SELECT {raw_columns} FROM orders_raw",
        "bucketed_customers": f"{_JOINED} SELECT order_id, customer_id, region, is_valid_customer FROM int_orders_validated",
        "bucketed_relationships": relationship.format(staged=_STAGED, dims=_DIMENSIONS, key="customer_id", parent="stg_customers"),
        "schema_drift": f"""WITH {_RAW_ORDERS},
n AS (SELECT CAST(order_id AS BIGINT) % 3 + 1 AS version, count(*) AS delivered_rows FROM orders_raw GROUP BY 1),
c (version, kind, column_name, detail) AS (
  VALUES (2, 'added', 'channel', 'string'), (2, 'moved', 'quantity', 'from place 4'),
         (3, 'renamed', 'customer_id', 'delivered as client_id'), (3, 'removed', 'source_system', 'string'))
SELECT n.version, kind, column_name, detail, delivered_rows FROM c JOIN n ON n.version = c.version""",
        "schema_versions_merged": f"""WITH {_RAW_ORDERS}
SELECT order_id, customer_id, product_id, quantity, order_date, load_timestamp,
       CASE WHEN CAST(order_id AS BIGINT) % 3 < 2 THEN source_system END AS source_system,
       CASE WHEN CAST(order_id AS BIGINT) % 3 > 0 THEN 'channel ' || CAST(order_id AS BIGINT) % 7 END AS channel
FROM orders_raw""",
        "reloaded_orders": f"WITH {_RAW_ORDERS} SELECT {raw_columns}, true AS of_last_load FROM orders_raw",
        "published_monthly_kpis": f"{_FACTS} {_monthly()}",
        "published_revenue_trends": _trends("ROWS", "order_date", "{}"),
        "published_orphan_audit": f"{_JOINED} {audit}",
        "incremental_monthly_kpis": f"{_FACTS} {_monthly()}",
        "incremental_revenue_trends": _trends("ROWS", "order_date", "{}"),
        "published_as_of": f"WITH {_FIRST_DELIVERY}{_STG_ORDERS},{_DIMENSIONS}{_VALIDATED}{_FACT} {_monthly()}",
        "published_test_results": f"{_FACTS} {_test_rows()}",
        "csv_reconciliation": f"""WITH {_RAW_ORDERS}
SELECT 'orders_raw' AS table_name, count(*) AS expected_rows, count(*) AS actual_rows, 'OK' AS status FROM orders_raw""",
        "rejected_rows": f"""WITH {_RAW_ORDERS},
judged AS (
  SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 499 = 3 THEN 'quantity is no int'
                        WHEN CAST(order_id AS BIGINT) % 509 = 1 THEN 'load_timestamp is no timestamp_ntz' END AS reason
  FROM orders_raw)
SELECT order_id, reason FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT 'landed', CAST(count(*) AS VARCHAR) FROM judged WHERE reason IS NULL""",
        "csv_quoted_reconciliation": """
WITH n AS (SELECT count(*) AS a, count(*) FILTER (p_partkey % 100 <> 7) AS b FROM part)
SELECT 'products' AS table_name, a AS expected_rows, a AS actual_rows, 'OK' AS status FROM n
UNION ALL SELECT 'short', a, b, CASE WHEN a = b THEN 'OK' ELSE 'MISMATCH' END FROM n""",
        "stream_raw_load": f"WITH {_RAW_ORDERS} SELECT {raw_columns} FROM orders_raw",
        "stream_retry_dedup": f"WITH {_RAW_ORDERS} SELECT DISTINCT order_id, customer_id, product_id, quantity, order_date, source_system FROM orders_raw",
        "stream_two_feeds": f"WITH {_RAW_ORDERS} SELECT DISTINCT order_id, customer_id, product_id, quantity, order_date, source_system FROM orders_raw",
    }
