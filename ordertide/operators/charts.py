"""Chart-ready datasets. Drawing them is left to the reader's own tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators.trends import keep_top_products, select_products


def chart_frame(monthly: DataFrame, n: int = 10, category_id: int | None = None) -> DataFrame:
    """Monthly rows of the ``n`` products with most revenue: the trend lines of
    revenue and of units, one point per product and month."""
    return keep_top_products(select_products(monthly, category_id), n)


def in_plot_order(frame: DataFrame) -> DataFrame:
    return frame.orderBy("order_year_month", "product_id")


def histogram(
    frame: DataFrame, measure: str, bins: int = 30, by: Sequence[str] = ("product_name",)
) -> DataFrame:
    """Counts in ``bins`` equal-width bins over the whole range, per series.

    Bins are closed below; the last is closed on both sides. When all values are
    equal they fall in the first bin. Minimum and maximum come from one scalar
    subquery, so nothing is collected by hand. Reads ``frame`` twice; pass a
    stored table.
    """
    limits = frame.agg(F.struct(F.min(measure).alias("low"), F.max(measure).alias("high")))
    value = F.col(measure).cast("double")
    placed = (
        frame.where(F.col(measure).isNotNull())
        .select(*by, value.alias("_value"), limits.scalar().alias("_range"))
        .select(
            *by,
            "_value",
            F.col("_range.low").cast("double").alias("_low"),
            F.col("_range.high").cast("double").alias("_high"),
        )
    )
    bucket = F.width_bucket("_value", "_low", "_high", F.lit(bins))
    width = (F.col("_high") - F.col("_low")) / bins
    return (
        placed.groupBy(
            *by, F.least(F.coalesce(bucket, F.lit(1)), F.lit(bins)).cast("int").alias("bin"),
            "_low", "_high",
        )
        .agg(F.count("*").alias("row_count"))
        .select(
            *by,
            "bin",
            (F.col("_low") + (F.col("bin") - 1) * width).alias("bin_start"),
            (F.col("_low") + F.col("bin") * width).alias("bin_end"),
            "row_count",
        )
    )


def revenue_vs_demand(frame: DataFrame) -> DataFrame:
    """Points of revenue against units, one animation frame per month."""
    return frame.select(
        "order_year_month",
        "product_id",
        "product_name",
        "monthly_demand_units",
        "monthly_revenue",
        "monthly_order_count",
    )
