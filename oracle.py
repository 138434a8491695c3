"""Reference SQL for every registered query, written for DuckDB.

Each statement reads the Parquet tables directly and shares nothing with the
library: cleaning, joins and aggregates are spelled out again.
"""

from __future__ import annotations

LINES = """
raw_lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         l_extendedprice / l_quantity AS unit_price,
         CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount
  FROM lineitem),
lines AS (
  SELECT order_id, product_id, COALESCE(unit_price, 0.0) AS unit_price,
         COALESCE(quantity, 0) AS quantity, COALESCE(discount, 0.0) AS discount
  FROM (SELECT *, ROW_NUMBER() OVER (
          PARTITION BY order_id, product_id
          ORDER BY unit_price NULLS LAST, quantity NULLS LAST, discount NULLS LAST) AS rn
        FROM raw_lines)
  WHERE rn = 1)"""

DIMENSIONS = """
ord AS (
  SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_custkey % 9 + 1 AS BIGINT) AS employee_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS required_date,
         o_orderpriority AS shipper
  FROM orders),
prod AS (
  SELECT p.p_partkey AS product_id, TRIM(p.p_name) AS product_name,
         CAST(SUBSTR(p.p_brand, 7) AS BIGINT) AS category_id, s.supplier_id
  FROM part p
  LEFT JOIN (SELECT l_partkey, MIN(l_suppkey) AS supplier_id FROM lineitem GROUP BY 1) s
    ON s.l_partkey = p.p_partkey)"""

FEATURES = (
    LINES
    + ","
    + DIMENSIONS
    + """,
base AS (
  SELECT l.order_id, o.order_date, o.customer_id, o.employee_id, o.shipper,
         l.product_id, p.product_name, p.category_id, p.supplier_id,
         l.unit_price, l.quantity, l.discount
  FROM lines l JOIN ord o ON o.order_id = l.order_id JOIN prod p ON p.product_id = l.product_id),
features AS (
  SELECT *, quantity AS demand_units, unit_price * quantity * (1 - discount) AS revenue,
         CAST(YEAR(order_date) AS INTEGER) AS order_year,
         CAST(MONTH(order_date) AS INTEGER) AS order_month,
         STRFTIME(order_date, '%Y-%m') AS order_year_month
  FROM base)"""
)


def _monthly(keys: str) -> str:
    return f"""
  SELECT order_year, order_month, order_year_month, {keys},
         CAST(SUM(demand_units) AS BIGINT) AS monthly_demand_units,
         SUM(revenue) AS monthly_revenue,
         COUNT(DISTINCT order_id) AS monthly_order_count
  FROM features GROUP BY order_year, order_month, order_year_month, {keys}"""


MONTHLY = FEATURES + f""",
monthly AS ({_monthly("product_id, product_name, category_id")})"""

MONTHLY_COLUMNS = """order_year, order_month, order_year_month, product_id, product_name,
  category_id, monthly_demand_units, ROUND(monthly_revenue, 4) AS monthly_revenue,
  monthly_order_count"""

FULFILLMENT = DIMENSIONS + """,
shipped AS (
  SELECT l_orderkey AS order_id, CAST(MAX(l_shipdate) AS DATE) AS shipped_date
  FROM lineitem GROUP BY 1),
fulfillment AS (
  SELECT o.*, s.shipped_date,
         CAST(DATE_DIFF('day', o.required_date, s.shipped_date) AS INTEGER) AS delay_days,
         COALESCE(DATE_DIFF('day', o.required_date, s.shipped_date) <= 0, FALSE) AS on_time,
         COALESCE(DATE_DIFF('day', o.required_date, s.shipped_date) > 0, FALSE) AS late,
         s.shipped_date IS NULL AS unshipped
  FROM ord o LEFT JOIN shipped s ON s.order_id = o.order_id)"""

KPIS = """COUNT(*) AS total_orders,
  COUNT(*) FILTER (WHERE on_time) AS on_time_orders,
  COUNT(*) FILTER (WHERE late) AS late_orders,
  COUNT(*) FILTER (WHERE unshipped) AS unshipped_orders,
  ROUND(COUNT(*) FILTER (WHERE on_time) / COUNT(*), 6) AS on_time_rate,
  ROUND(COUNT(*) FILTER (WHERE late) / COUNT(*), 6) AS late_rate,
  ROUND(AVG(delay_days), 6) AS avg_delay_days"""

TOTALS = """CAST(SUM(demand_units) AS BIGINT) AS total_demand_units,
  ROUND(SUM(revenue), 4) AS total_revenue,
  COUNT(DISTINCT order_id) AS order_count,
  ROUND(AVG(unit_price), 4) AS avg_unit_price"""


def _top(measure: str, total: str, n: int, kind: str = "") -> str:
    summed = f"CAST(SUM({measure}) AS BIGINT)" if kind == "int" else f"ROUND(SUM({measure}), 4)"
    return f"""SELECT product_id, product_name, {summed} AS {total}
  FROM monthly GROUP BY product_id, product_name
  ORDER BY SUM({measure}) DESC, product_id, product_name LIMIT {n}"""


TOP_REVENUE = _top("monthly_revenue", "total_revenue", 10)
TOP_UNITS = _top("monthly_demand_units", "total_demand_units", 10, "int")

CHART = MONTHLY + f""",
top AS ({TOP_REVENUE}),
chart AS (SELECT * FROM monthly WHERE product_id IN (SELECT product_id FROM top))"""


def _histogram(source: str, measure: str) -> str:
    return f"""
WITH {CHART},
vals AS (SELECT product_name, CAST(ROUND({measure}, 4) AS DOUBLE) AS x FROM {source}),
lim AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM vals),
placed AS (
  SELECT product_name, lo, hi,
         CASE WHEN hi = lo THEN 1
              ELSE LEAST(CAST(FLOOR(30 * (x - lo) / (hi - lo)) AS INTEGER) + 1, 30) END AS bin
  FROM vals, lim)
SELECT product_name, CAST(bin AS INTEGER) AS bin,
       ROUND(lo + (bin - 1) * ((hi - lo) / 30), 6) AS bin_start,
       ROUND(lo + bin * ((hi - lo) / 30), 6) AS bin_end,
       COUNT(*) AS row_count
FROM placed GROUP BY product_name, bin, lo, hi"""


def _growth(source: str, series: str, columns: str, ties: str = "") -> str:
    previous = f"""LAG(monthly_demand_units) OVER (
    PARTITION BY {series} ORDER BY order_year_month{ties})"""
    return f"""SELECT {columns},
  ROUND(CASE WHEN {previous} = 0 THEN NULL
        ELSE monthly_demand_units / {previous} - 1 END, 6) AS demand_growth_rate
FROM {source}"""


SHARE = """
product_month AS (
  SELECT order_year_month, category_id, product_id, product_name,
         SUM(monthly_revenue) AS product_month_revenue
  FROM monthly WHERE product_name IS NOT NULL GROUP BY ALL),
category_month AS (
  SELECT order_year_month, category_id, SUM(monthly_revenue) AS category_month_revenue
  FROM monthly GROUP BY ALL),
share AS (
  SELECT p.order_year_month, p.category_id, p.product_id, p.product_name,
         ROUND(p.product_month_revenue, 4) AS product_month_revenue,
         ROUND(c.category_month_revenue, 4) AS category_month_revenue,
         ROUND(p.product_month_revenue / c.category_month_revenue, 6) AS category_revenue_share
  FROM product_month p LEFT JOIN category_month c USING (order_year_month, category_id))"""

BASE_COLUMNS = """order_id, order_date, customer_id, employee_id, product_id, product_name,
  category_id, supplier_id, unit_price, quantity, discount"""


def _nulls(table: str, columns: list[str], floating: tuple[str, ...] = ()) -> str:
    def one(name: str) -> str:
        test = f"{name} IS NULL" + (f" OR ISNAN({name})" if name in floating else "")
        count = f"COUNT(*) FILTER (WHERE {test})"
        return f"""SELECT '{name}' AS column_name, COUNT(*) AS row_count, {count} AS null_count,
  {count} / COUNT(*) AS null_ratio, CAST(0.05 AS DOUBLE) AS threshold,
  {count} / COUNT(*) <= 0.05 AS passed FROM {table}"""

    return " UNION ALL ".join(one(name) for name in columns)


def _schema_row(name: str, want: str, have: str, bad: str) -> str:
    return f"""SELECT '{name}' AS column_name, '{want}' AS expected_type, '{have}' AS actual_type,
  TRUE AS present, {"TRUE" if want == have else "FALSE"} AS type_matches,
  COUNT(*) AS row_count, {bad} AS uncastable_values FROM raw_lines"""


def _bad(name: str, kind: str) -> str:
    return f"COUNT(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL)"


def _orphans(name: str, table: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS violations, COUNT(*) = 0 AS passed
  FROM {table} WHERE NOT EXISTS (SELECT 1 FROM {parent} WHERE {key} = {column})"""


def _duplicates(name: str, table: str, keys: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS violations, COUNT(*) = 0 AS passed
  FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1)"""


def statements() -> dict[str, str]:
    service = f"SELECT {KPIS} FROM fulfillment"
    monthly_growth = _growth("monthly", "product_id, product_name, category_id", MONTHLY_COLUMNS)
    category_columns = """order_year, order_month, order_year_month, category_id,
  monthly_demand_units, ROUND(monthly_revenue, 4) AS monthly_revenue, monthly_order_count"""
    return {
        "order_details_clean": f"""WITH {LINES}
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
       unit_price, quantity, discount FROM lines""",
        "order_details_demand_clean": f"WITH {LINES} SELECT * FROM lines",
        "orders_clean": f"""WITH {DIMENSIONS}
SELECT order_id, customer_id, employee_id, order_date, required_date, shipper FROM ord""",
        "products_clean": f"WITH {DIMENSIONS} SELECT * FROM prod",
        "demand_base": f"WITH {FEATURES} SELECT {BASE_COLUMNS} FROM base",
        "line_revenue": f"""WITH {FEATURES}
SELECT order_id, product_id, unit_price, quantity, discount, revenue FROM features""",
        "demand_features": f"""WITH {FEATURES}
SELECT {BASE_COLUMNS}, demand_units, revenue, order_year, order_month, order_year_month
FROM features""",
        "product_revenue": f"""WITH {LINES}
SELECT l.product_id, p.p_name AS product_name,
       ROUND(SUM(l.unit_price * l.quantity * (1 - l.discount)), 4) AS total_revenue,
       CAST(SUM(l.quantity) AS BIGINT) AS total_quantity
FROM lines l JOIN orders o ON o.o_orderkey = l.order_id JOIN part p ON p.p_partkey = l.product_id
GROUP BY l.product_id, p.p_name""",
        "product_demand_summary": f"""WITH {FEATURES}
SELECT product_id, product_name, category_id, {TOTALS}
FROM features GROUP BY product_id, product_name, category_id""",
        "product_demand_monthly": f"WITH {MONTHLY} SELECT {MONTHLY_COLUMNS} FROM monthly",
        "daily_product_demand": f"""WITH {FEATURES}
SELECT order_date, product_id, CAST(SUM(demand_units) AS BIGINT) AS daily_demand_units
FROM features GROUP BY order_date, product_id""",
        "category_summary": f"""WITH {FEATURES}
SELECT category_id, {TOTALS} FROM features GROUP BY category_id""",
        "customer_summary": f"""WITH {FEATURES}
SELECT customer_id, {TOTALS} FROM features GROUP BY customer_id""",
        "supplier_summary": f"""WITH {FEATURES}
SELECT supplier_id, {TOTALS} FROM features GROUP BY supplier_id""",
        "employee_summary": f"""WITH {FEATURES}
SELECT employee_id, {TOTALS} FROM features GROUP BY employee_id""",
        "customer_category_summary": f"""WITH {FEATURES}
SELECT customer_id, category_id, {TOTALS.replace("AVG(unit_price)", "AVG(unit_price) + 1e-9")} FROM features GROUP BY customer_id, category_id""",
        "category_demand_monthly": f"""WITH {FEATURES},
by_category AS ({_monthly("category_id")})
{_growth("by_category", "category_id", category_columns)}""",
        "monthly_for_category": f"""WITH {MONTHLY}
SELECT {MONTHLY_COLUMNS} FROM monthly WHERE category_id = 1""",
        "monthly_for_product": f"""WITH {MONTHLY}
SELECT {MONTHLY_COLUMNS} FROM monthly WHERE product_id = 2""",
        "top_products_by_revenue": f"WITH {MONTHLY} {TOP_REVENUE}",
        "top_products_by_units": f"WITH {MONTHLY} {TOP_UNITS}",
        "products_highest_first": f"""WITH {FEATURES},
summary AS (SELECT product_id, product_name, category_id, {TOTALS}
  FROM features GROUP BY product_id, product_name, category_id)
SELECT *, ROW_NUMBER() OVER (ORDER BY total_revenue DESC, product_id) AS place FROM summary""",
        "monthly_in_order": f"""WITH {MONTHLY}, rounded AS (SELECT {MONTHLY_COLUMNS} FROM monthly)
SELECT *, ROW_NUMBER() OVER (ORDER BY order_year_month, monthly_revenue DESC, product_id) AS place
FROM rounded""",
        "top_products_trend": f"WITH {CHART} SELECT {MONTHLY_COLUMNS} FROM chart",
        "focus_top_units": f"""WITH {MONTHLY},
picked AS (SELECT product_id FROM monthly WHERE category_id = 1 GROUP BY product_id, product_name
  ORDER BY SUM(monthly_demand_units) DESC, product_id LIMIT 2)
SELECT {MONTHLY_COLUMNS} FROM monthly
WHERE category_id = 1 AND product_id IN (SELECT product_id FROM picked)""",
        "category_month_revenue": f"""WITH {MONTHLY}
SELECT order_year_month, category_id, ROUND(SUM(monthly_revenue), 4) AS category_month_revenue
FROM monthly GROUP BY order_year_month, category_id""",
        "category_share": f"WITH {MONTHLY}, {SHARE} SELECT * FROM share",
        "category_share_of_one": f"""WITH {MONTHLY}, {SHARE}
SELECT * FROM share WHERE category_id = 1""",
        "demand_growth": f"WITH {MONTHLY} {monthly_growth}",
        "demand_growth_by_name": f"""WITH {MONTHLY},
named AS (SELECT * FROM monthly WHERE product_name IS NOT NULL)
{_growth("named", "product_name", MONTHLY_COLUMNS, ", product_id, category_id")}""",
        "period_summary": f"""WITH {MONTHLY}
SELECT product_id, product_name,
       CAST(SUM(monthly_demand_units) AS BIGINT) AS total_demand_units,
       ROUND(SUM(monthly_revenue), 4) AS total_revenue,
       ROUND(AVG(monthly_demand_units), 6) AS avg_monthly_demand_units,
       ROUND(AVG(monthly_revenue) + 1e-9, 6) AS avg_monthly_revenue
FROM monthly GROUP BY product_id, product_name""",
        "revenue_histogram": _histogram("monthly", "monthly_revenue"),
        "demand_histogram": _histogram("monthly", "monthly_demand_units"),
        "top_products_revenue_histogram": _histogram("chart", "monthly_revenue"),
        "top_products_demand_histogram": _histogram("chart", "monthly_demand_units"),
        "revenue_vs_demand_points": f"""WITH {CHART}
SELECT order_year_month, product_id, product_name, monthly_demand_units,
       ROUND(monthly_revenue, 4) AS monthly_revenue, monthly_order_count FROM chart""",
        "order_fulfillment": f"""WITH {FULFILLMENT}
SELECT order_id, customer_id, order_date, required_date, shipped_date, shipper,
       delay_days, on_time, late, unshipped FROM fulfillment""",
        "service_kpis": f"WITH {FULFILLMENT} {service}",
        "service_kpis_by_customer": f"""WITH {FULFILLMENT}
SELECT customer_id, {KPIS} FROM fulfillment GROUP BY customer_id""",
        "service_kpis_by_shipper": f"""WITH {FULFILLMENT}
SELECT shipper, {KPIS} FROM fulfillment GROUP BY shipper""",
        "service_kpis_by_product": f"""WITH {FULFILLMENT},
ordered AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem)
SELECT d.product_id, {KPIS}
FROM ordered d JOIN fulfillment f ON f.order_id = d.order_id GROUP BY d.product_id""",
        "shipper_summary": f"""WITH {LINES}, {FULFILLMENT},
per_order AS (
  SELECT l.order_id, SUM(l.quantity) AS units,
         SUM(l.unit_price * l.quantity * (1 - l.discount)) AS revenue
  FROM lines l JOIN prod p ON p.product_id = l.product_id GROUP BY l.order_id)
SELECT f.shipper, CAST(COALESCE(SUM(t.units), 0) AS BIGINT) AS total_demand_units,
       ROUND(COALESCE(SUM(t.revenue), 0.0), 4) AS total_revenue, {KPIS}
FROM fulfillment f LEFT JOIN per_order t ON t.order_id = f.order_id GROUP BY f.shipper""",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {table}"
            for name, table in (
                ("order_details", "lineitem"),
                ("orders", "orders"),
                ("products", "part"),
                ("customers", "customer"),
                ("suppliers", "supplier"),
            )
        ),
        "source_preview": f"""WITH {DIMENSIONS}
SELECT order_id, customer_id, employee_id, order_date FROM ord ORDER BY order_id LIMIT 5""",
        "schema_report": f"""WITH {LINES}
{_schema_row("order_id", "bigint", "bigint", "0")}
UNION ALL {_schema_row("product_id", "bigint", "bigint", "0")}
UNION ALL {_schema_row("unit_price", "double", "double", "0")}
UNION ALL {_schema_row("quantity", "int", "double", _bad("quantity", "INTEGER"))}
UNION ALL {_schema_row("discount", "double", "double", "0")}""",
        "null_report": f"""WITH {LINES}
{_nulls("raw_lines", ["order_id", "product_id", "unit_price", "quantity", "discount"],
        ("unit_price", "quantity", "discount"))}""",
        "fulfillment_null_report": f"""WITH {FULFILLMENT}
{_nulls("fulfillment", ["order_id", "required_date", "shipped_date", "delay_days"])}""",
        "integrity_report": " UNION ALL ".join(
            [
                _duplicates("duplicate_order_lines", "lineitem", "l_orderkey, l_partkey"),
                _duplicates("duplicate_orders", "orders", "o_orderkey"),
                _duplicates("duplicate_products", "part", "p_partkey"),
                _orphans("lines_without_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
                _orphans("lines_without_product", "lineitem", "l_partkey", "part", "p_partkey"),
            ]
        ),
        "csv_scan": f"WITH {LINES} SELECT * FROM lines",
        "parquet_by_year": f"WITH {MONTHLY} SELECT {MONTHLY_COLUMNS} FROM monthly",
    }
