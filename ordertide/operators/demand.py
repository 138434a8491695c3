"""Order-line demand: the joined base, its features, and totals by any key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schemas
from ordertide.functions import calendar_parts, line_revenue, month_parts


def demand_base(
    lines: DataFrame, orders: DataFrame, products: DataFrame, order_columns: Sequence[str] = ()
) -> DataFrame:
    """Order lines joined to their product and their order, both inner.

    Only the needed columns enter the joins. Neither side is hinted: Spark
    broadcasts a table that its size statistics show to be small, and otherwise
    splits hot keys of the sort-merge join at run time. The order join comes
    last, so that rows leave partitioned by ``order_id`` and the distinct order
    counts that follow need no shuffle of the lines.

    ``order_columns`` carries further order columns (say, the shipper) along.
    """
    order_side = orders.select(
        "order_id", "order_date", "customer_id", "employee_id", *order_columns
    )
    product_side = products.select(*schemas.PRODUCTS.fieldNames())
    return (
        lines.select(*schemas.ORDER_DETAILS.fieldNames())
        .join(product_side, "product_id")
        .join(order_side, "order_id")
        .select(*schemas.DEMAND_BASE.fieldNames(), *order_columns)
    )


def with_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", line_revenue())


def with_demand_features(base: DataFrame) -> DataFrame:
    """Add units, revenue and the calendar columns of the order date."""
    return base.withColumns(
        {"demand_units": F.col("quantity"), "revenue": line_revenue(), **calendar_parts()}
    )


def product_revenue(lines: DataFrame) -> DataFrame:
    """Revenue and quantity per product, from lines that carry ``revenue``."""
    return lines.groupBy("product_id", "product_name").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("quantity").alias("total_quantity")
    )


def _measures(prefix: str, orders: str) -> list[Column]:
    return [
        F.sum("demand_units").alias(f"{prefix}_demand_units"),
        F.sum("revenue").alias(f"{prefix}_revenue"),
        F.countDistinct("order_id").alias(orders),
    ]


def demand_by(features: DataFrame, *keys: str) -> DataFrame:
    """Units, revenue, distinct orders and mean unit price for any set of keys."""
    return features.groupBy(*keys).agg(
        *_measures("total", "order_count"), F.avg("unit_price").alias("avg_unit_price")
    )


def monthly_demand_by(features: DataFrame, *keys: str) -> DataFrame:
    """Units, revenue and distinct orders per calendar month and key.

    Groups by the month as one date and derives the three calendar columns
    afterwards, so the shuffled rows carry 4 bytes of calendar instead of a
    year, a month and a string.
    """
    return (
        features.groupBy(F.trunc("order_date", "month").alias("_month"), *keys)
        .agg(*_measures("monthly", "monthly_order_count"))
        .select(
            *month_parts("_month"),
            *keys,
            "monthly_demand_units",
            "monthly_revenue",
            "monthly_order_count",
        )
    )


def product_demand_summary(features: DataFrame) -> DataFrame:
    return demand_by(features, *schemas.PRODUCT_KEYS)


def product_demand_monthly(features: DataFrame) -> DataFrame:
    return monthly_demand_by(features, *schemas.PRODUCT_KEYS)


def daily_product_demand(features: DataFrame) -> DataFrame:
    """Units per order date and product."""
    return features.groupBy("order_date", "product_id").agg(
        F.sum("demand_units").alias("daily_demand_units")
    )


def category_demand_monthly(features: DataFrame) -> DataFrame:
    """Monthly demand per category. Orders are counted from the lines, because an
    order with two products of a category must count once."""
    return monthly_demand_by(features, "category_id")
