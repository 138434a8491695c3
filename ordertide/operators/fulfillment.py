"""Delay of each order against its promise, and service KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions import line_revenue, ratio


def attach_shipments(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Give orders their ``shipped_date``; an order without a shipment stays, unshipped."""
    return orders.drop("shipped_date").join(
        shipments.select("order_id", "shipped_date"), "order_id", "left"
    )


def order_fulfillment(orders: DataFrame) -> DataFrame:
    """Days late per order (negative when early) and its service status.

    An order that has not shipped, or has no promised date, has a null delay and
    is neither on time nor late.
    """
    delay = F.datediff("shipped_date", "required_date")
    return orders.withColumn("delay_days", delay).withColumns(
        {
            "on_time": F.coalesce(F.col("delay_days") <= 0, F.lit(False)),
            "late": F.coalesce(F.col("delay_days") > 0, F.lit(False)),
            "unshipped": F.col("shipped_date").isNull(),
        }
    )


def _kpis() -> list[Column]:
    total = F.count("*")
    on_time = F.count_if("on_time")
    late = F.count_if("late")
    return [
        total.alias("total_orders"),
        on_time.alias("on_time_orders"),
        late.alias("late_orders"),
        F.count_if("unshipped").alias("unshipped_orders"),
        ratio(on_time, total).alias("on_time_rate"),
        ratio(late, total).alias("late_rate"),
        F.avg("delay_days").alias("avg_delay_days"),
    ]


def service_kpis(fulfillment: DataFrame, *keys: str) -> DataFrame:
    """On-time rate, late rate and mean delay, overall or per key.

    Rates divide by all orders, unshipped ones included. Input is one row per
    order (and key).
    """
    return fulfillment.groupBy(*keys).agg(*_kpis())


def service_kpis_by_product(fulfillment: DataFrame, lines: DataFrame) -> DataFrame:
    """The KPIs over the distinct orders that contain each product.

    Both sides reach the join by plain shuffles, so Spark can split an order of very
    many products: the outcomes would else arrive placed by their order.
    """
    ordered = lines.select("order_id", "product_id").distinct()
    outcome = fulfillment.select("order_id", "delay_days", "on_time", "late", "unshipped")
    return service_kpis(ordered.join(outcome.hint("rebalance"), "order_id"), "product_id")


def demand_and_service(
    fulfillment: DataFrame, lines: DataFrame, products: DataFrame, *keys: str
) -> DataFrame:
    """Units, revenue and service KPIs for an order attribute, such as the shipper.

    The lines are first totalled per order, which both shrinks them before the
    join and makes a very large order one row. Orders without lines count in the
    KPIs and add nothing to demand.
    """
    per_order = (
        lines.join(products.select("product_id"), "product_id")
        .groupBy("order_id")
        .agg(F.sum("quantity").alias("_units"), F.sum(line_revenue()).alias("_revenue"))
    )
    return (
        fulfillment.select("order_id", *keys, "delay_days", "on_time", "late", "unshipped")
        .join(per_order, "order_id", "left")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("_units"), F.lit(0)).alias("total_demand_units"),
            F.coalesce(F.sum("_revenue"), F.lit(0.0)).alias("total_revenue"),
            *_kpis(),
        )
    )
