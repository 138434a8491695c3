"""Registered queries over the star-schema tables, with their SQL counterparts.

Sums of money are rounded to 4 decimals here, where results are compared, and
not in the library: a line's revenue has exactly 4 decimals, so the sum's order
cannot show. Ratios are rounded to 6.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from ordertide import schemas
from ordertide.operators import charts, cleaning, demand, fulfillment, ordering, quality, trends
from ordertide.plans import demand as plans
from ordertide.sources import readers, retail, staging, writers

try:
    import corpus_pipeline
    from ordertide.llm import queries as llm_queries
except ImportError as missing:
    # The text operators, or a package that only they need, may be absent; all other queries stand.
    print(f"text operators left out: {missing}", file=sys.stderr)
    corpus_pipeline = llm_queries = None

SMOKE_FOLDER = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def _money(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_order_details(retail.order_details(spark, folder))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_orders(retail.orders(spark, folder))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_products(retail.products(spark, folder))


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _lines(spark, folder), _orders(spark, folder), _products(spark, folder)


def _derived_products(spark: SparkSession, folder: str) -> DataFrame:
    """For queries that read the supplier, which is derived from the lines here.

    The hint feeds the join by a plain shuffle, so that Spark can split a product that
    holds a large share of the lines; the derivation would else place it by product.
    """
    return cleaning.clean_products(retail.products(spark, folder).hint("rebalance"))


def _base(spark: SparkSession, folder: str) -> DataFrame:
    return demand.demand_base(
        _lines(spark, folder), _orders(spark, folder), _derived_products(spark, folder)
    )


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return demand.with_demand_features(_base(spark, folder))


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return plans.product_demand_monthly(*_tables(spark, folder))


def _monthly_of(spark: SparkSession, folder: str, category_id: int | None) -> DataFrame:
    """The monthly table of one category, chosen before any line is joined; None is all."""
    lines, orders, products = _tables(spark, folder)
    return plans.product_demand_monthly(lines, orders, trends.select_products(products, category_id))


def _fulfillment(spark: SparkSession, folder: str) -> DataFrame:
    shipped = fulfillment.attach_shipments(
        _orders(spark, folder), retail.shipments(spark, folder)
    )
    return fulfillment.order_fulfillment(shipped)


# Cleaning


def order_details_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = retail.order_details(spark, folder)
    text = raw.withColumns({key: F.col(key).cast("string") for key in schemas.LINE_KEYS})
    return cleaning.clean_order_details(text, typed_keys=False)


def products_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _products(spark, folder)


# Demand


def line_revenue(spark: SparkSession, folder: str) -> DataFrame:
    priced = demand.with_revenue(demand.demand_base(*_tables(spark, folder)))
    return priced.select("order_id", "product_id", *schemas.LINE_MEASURES, "revenue")


def product_revenue(spark: SparkSession, folder: str) -> DataFrame:
    tables = (retail.order_details, retail.orders, retail.products)
    cleaned = plans.cleaned_lines(*(read(spark, folder) for read in tables))
    return _money(plans.product_revenue(*cleaned), "total_revenue")


def product_demand_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(plans.product_demand_summary(*_tables(spark, folder)))


def product_demand_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _money(_monthly(spark, folder), "monthly_revenue")


def daily_product_demand(spark: SparkSession, folder: str) -> DataFrame:
    return plans.daily_product_demand(*_tables(spark, folder))


def _summary(summary: DataFrame) -> DataFrame:
    return _money(summary, "total_revenue", "avg_unit_price")


def category_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(plans.demand_by_product_attribute(*_tables(spark, folder), "category_id"))


def supplier_summary(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders, _ = _tables(spark, folder)
    products = _derived_products(spark, folder)
    return _summary(plans.demand_by_product_attribute(lines, orders, products, "supplier_id"))


def _summary_by_order_key(key: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _summary(plans.demand_by_order_attribute(*_tables(spark, folder), key))

    return query


def customer_category_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = plans.demand_by(*_tables(spark, folder), "customer_id", "category_id")
    # As in the period summary, a billionth moves means off the point between two rounded values.
    return _summary(summary.withColumn("avg_unit_price", F.col("avg_unit_price") + 1e-9))


def category_demand_monthly(spark: SparkSession, folder: str) -> DataFrame:
    grown = plans.category_demand_monthly(*_tables(spark, folder))
    return _money(_money(grown, "monthly_revenue"), "demand_growth_rate", digits=6)


# Monthly analytics


def monthly_for_category(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders, products = _tables(spark, folder)
    wanted = trends.select_products(products, category_id=1)
    monthly = demand.product_demand_monthly(
        demand.with_demand_features(demand.demand_base(lines, orders, wanted))
    )
    return _money(monthly, "monthly_revenue")


def monthly_for_product(spark: SparkSession, folder: str) -> DataFrame:
    return _money(
        trends.select_products(_monthly(spark, folder), product_id=2), "monthly_revenue"
    )


def top_products_by_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return _money(trends.top_products(_monthly(spark, folder)), "total_revenue")


def top_products_by_units(spark: SparkSession, folder: str) -> DataFrame:
    return trends.top_products_by_units(_monthly(spark, folder))


def products_highest_first(spark: SparkSession, folder: str) -> DataFrame:
    """The whole summary in its order, each row with its place."""
    summary = product_demand_summary(spark, folder)
    return ordering.placed(ordering.highest_first(summary, "total_revenue", "product_id"))


def monthly_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """The whole monthly table in its order, each row with its place."""
    monthly = product_demand_monthly(spark, folder)
    return ordering.placed(ordering.by_month(monthly, "monthly_revenue", "product_id"))


def top_products_trend(spark: SparkSession, folder: str) -> DataFrame:
    frame = charts.chart_frame(_monthly(spark, folder))
    return charts.in_plot_order(_money(frame, "monthly_revenue"))


def focus_top_units(spark: SparkSession, folder: str) -> DataFrame:
    chosen = trends.focus(_monthly_of(spark, folder, 1), category_id=1, top_n=2)
    return _money(chosen, "monthly_revenue")


def category_month_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return _money(
        trends.category_month_revenue(_monthly(spark, folder)), "category_month_revenue"
    )


def _share(spark: SparkSession, folder: str, category_id: int | None) -> DataFrame:
    shares = trends.category_share(_monthly_of(spark, folder, category_id), category_id)
    shares = _money(shares, "product_month_revenue", "category_month_revenue")
    return _money(shares, "category_revenue_share", digits=6)


def category_share(spark: SparkSession, folder: str) -> DataFrame:
    return _share(spark, folder, None)


def category_share_of_one(spark: SparkSession, folder: str) -> DataFrame:
    return _share(spark, folder, 1)


def demand_growth(spark: SparkSession, folder: str) -> DataFrame:
    grown = trends.demand_growth(_monthly(spark, folder))
    return _money(_money(grown, "monthly_revenue"), "demand_growth_rate", digits=6)


def demand_growth_by_name(spark: SparkSession, folder: str) -> DataFrame:
    grown = trends.demand_growth(_monthly(spark, folder), series=("product_name",))
    return _money(_money(grown, "monthly_revenue"), "demand_growth_rate", digits=6)


def period_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = trends.period_summary(_monthly(spark, folder))
    # A billionth moves means that lie halfway between two rounded values off that point in both engines.
    moved = F.col("avg_monthly_revenue") + 1e-9
    summary = _money(summary.withColumn("avg_monthly_revenue", moved), "total_revenue")
    return _money(summary, "avg_monthly_demand_units", "avg_monthly_revenue", digits=6)


# Charts


def _histogram(measure: str, top: int | None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        monthly = _monthly(spark, folder)
        frame = monthly if top is None else charts.chart_frame(monthly, top)
        rounded = frame.withColumn(measure, F.round(measure, 4))
        return _money(charts.histogram(rounded, measure), "bin_start", "bin_end", digits=6)

    return query


def revenue_vs_demand_points(spark: SparkSession, folder: str) -> DataFrame:
    frame = charts.chart_frame(_monthly(spark, folder))
    return _money(charts.revenue_vs_demand(frame), "monthly_revenue")


# Fulfillment


def order_fulfillment(spark: SparkSession, folder: str) -> DataFrame:
    return _fulfillment(spark, folder).select(
        "order_id", "customer_id", "order_date", "required_date", "shipped_date", "shipper",
        "delay_days", "on_time", "late", "unshipped",
    )


def _rounded_kpis(df: DataFrame) -> DataFrame:
    return _money(df, "on_time_rate", "late_rate", "avg_delay_days", digits=6)


def _service_kpis(*keys: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded_kpis(fulfillment.service_kpis(_fulfillment(spark, folder), *keys))

    return query


def service_kpis_by_product(spark: SparkSession, folder: str) -> DataFrame:
    lines = retail.order_details(spark, folder)
    return _rounded_kpis(
        fulfillment.service_kpis_by_product(_fulfillment(spark, folder), lines)
    )


def shipper_summary(spark: SparkSession, folder: str) -> DataFrame:
    lines, _, products = _tables(spark, folder)
    report = fulfillment.demand_and_service(
        _fulfillment(spark, folder), lines, products, "shipper"
    )
    return _rounded_kpis(_money(report, "total_revenue"))


# Sources and quality


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_counts(
        {
            "order_details": retail.table(spark, folder, "lineitem"),
            "orders": retail.table(spark, folder, "orders"),
            "products": retail.table(spark, folder, "part"),
            "customers": retail.table(spark, folder, "customer"),
            "suppliers": retail.table(spark, folder, "supplier"),
        }
    )


def source_preview(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select(*schemas.ORDERS.fieldNames())
    return ordering.preview(ordering.by_number(orders, "order_id"), 5)


def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.schema_report(retail.order_details(spark, folder), schemas.ORDER_DETAILS)


def null_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_report(retail.order_details(spark, folder), default=0.05)


def fulfillment_null_report(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("order_id", "required_date", "shipped_date", "delay_days")
    return quality.null_report(_fulfillment(spark, folder).select(*columns), default=0.05)


def integrity_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.integrity_report(
        retail.order_details(spark, folder),
        retail.orders(spark, folder),
        retail.products(spark, folder),
    )


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines exported as CSV, scanned back as text and cleaned."""
    location = staging.new_location(spark, "order_details_csv")
    whole = F.col("quantity").cast("int")
    exported = retail.order_details(spark, folder).withColumn("quantity", whole)
    exported.write.option("header", True).csv(location)
    return cleaning.clean_order_details(readers.read_csv(spark, location))


def parquet_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly table through the partitioned Parquet sink and back."""
    location = staging.new_location(spark, "product_demand_by_year")
    writers.write_parquet(_monthly(spark, folder), location, ["order_year"])
    stored = readers.read_parquet(spark, location)
    return _money(stored.select(*schemas.PRODUCT_DEMAND_MONTHLY.fieldNames()), "monthly_revenue")


def entry(spark: SparkSession) -> DataFrame:
    """Demand and revenue per product."""
    return product_demand_summary(spark, SMOKE_FOLDER)


def queries() -> dict[str, Query]:
    found = _own_queries()
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _own_queries() -> dict[str, Query]:
    return {
        "order_details_clean": order_details_clean,
        "order_details_demand_clean": _lines,
        "orders_clean": _orders,
        "products_clean": products_clean,
        "demand_base": _base,
        "line_revenue": line_revenue,
        "demand_features": _features,
        "product_revenue": product_revenue,
        "product_demand_summary": product_demand_summary,
        "product_demand_monthly": product_demand_monthly,
        "daily_product_demand": daily_product_demand,
        "category_summary": category_summary,
        "customer_summary": _summary_by_order_key("customer_id"),
        "supplier_summary": supplier_summary,
        "employee_summary": _summary_by_order_key("employee_id"),
        "customer_category_summary": customer_category_summary,
        "category_demand_monthly": category_demand_monthly,
        "monthly_for_category": monthly_for_category,
        "monthly_for_product": monthly_for_product,
        "top_products_by_revenue": top_products_by_revenue,
        "top_products_by_units": top_products_by_units,
        "products_highest_first": products_highest_first,
        "monthly_in_order": monthly_in_order,
        "top_products_trend": top_products_trend,
        "focus_top_units": focus_top_units,
        "category_month_revenue": category_month_revenue,
        "category_share": category_share,
        "category_share_of_one": category_share_of_one,
        "demand_growth": demand_growth,
        "demand_growth_by_name": demand_growth_by_name,
        "period_summary": period_summary,
        "revenue_histogram": _histogram("monthly_revenue", None),
        "demand_histogram": _histogram("monthly_demand_units", None),
        "top_products_revenue_histogram": _histogram("monthly_revenue", 10),
        "top_products_demand_histogram": _histogram("monthly_demand_units", 10),
        "revenue_vs_demand_points": revenue_vs_demand_points,
        "order_fulfillment": order_fulfillment,
        "service_kpis": _service_kpis(),
        "service_kpis_by_customer": _service_kpis("customer_id"),
        "service_kpis_by_shipper": _service_kpis("shipper"),
        "service_kpis_by_product": service_kpis_by_product,
        "shipper_summary": shipper_summary,
        "row_counts": row_counts,
        "source_preview": source_preview,
        "schema_report": schema_report,
        "null_report": null_report,
        "fulfillment_null_report": fulfillment_null_report,
        "integrity_report": integrity_report,
        "csv_scan": csv_scan,
        "parquet_by_year": parquet_by_year,
    }


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if llm_queries is not None:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
