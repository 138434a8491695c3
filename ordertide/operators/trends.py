"""Analytics over the monthly product demand table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.functions import ratio
from ordertide.operators.ordering import with_previous

#: Key of the monthly table besides the month.
SERIES = ("product_id", "product_name", "category_id")


def select_products(
    monthly: DataFrame, category_id: int | None = None, product_id: int | None = None
) -> DataFrame:
    """Keep one category and/or one product; None keeps all."""
    if category_id is not None:
        monthly = monthly.where(F.col("category_id") == category_id)
    if product_id is not None:
        monthly = monthly.where(F.col("product_id") == product_id)
    return monthly


def product_totals(monthly: DataFrame, measure: str, total: str) -> DataFrame:
    """One measure of the monthly table summed per product."""
    return monthly.groupBy("product_id", "product_name").agg(F.sum(measure).alias(total))


def top_products(
    monthly: DataFrame,
    n: int = 10,
    measure: str = "monthly_revenue",
    total: str = "total_revenue",
) -> DataFrame:
    """The ``n`` products with the highest total; equal totals by smaller id.

    Sort and limit become a bounded top-k per task, merged at the end.
    """
    totals = product_totals(monthly, measure, total)
    return totals.orderBy(F.desc(total), "product_id", "product_name").limit(n)


def top_products_by_units(monthly: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with most units. Products without a name are not ranked."""
    named = monthly.where(F.col("product_name").isNotNull())
    return top_products(named, n, "monthly_demand_units", "total_demand_units")


def keep_products(monthly: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen products, by a semi-join instead of a collect; Spark decides by
    the size of the list whether to broadcast it."""
    ids = chosen.select("product_id")
    return monthly.join(ids, "product_id", "left_semi").select(*monthly.columns)


def keep_top_products(monthly: DataFrame, n: int = 10) -> DataFrame:
    """All rows of the ``n`` products with most revenue. Reads ``monthly`` twice."""
    return keep_products(monthly, top_products(monthly, n))


def focus(
    monthly: DataFrame,
    category_id: int | None = None,
    product_id: int | None = None,
    top_n: int | None = None,
) -> DataFrame:
    """An analyst's selection: by category, then one product or the top by units."""
    selected = select_products(monthly, category_id, product_id)
    if product_id is not None or top_n is None:
        return selected
    return keep_products(selected, top_products_by_units(selected, top_n))


def product_month_revenue(monthly: DataFrame) -> DataFrame:
    """Revenue per month, category and product. Rows without a category drop out."""
    return (
        monthly.where(F.col("category_id").isNotNull())
        .groupBy("order_year_month", "category_id", "product_id", "product_name")
        .agg(F.sum("monthly_revenue").alias("product_month_revenue"))
    )


def category_month_revenue(monthly: DataFrame) -> DataFrame:
    """Revenue per month and category, of named and unnamed products alike."""
    return (
        monthly.where(F.col("category_id").isNotNull())
        .groupBy("order_year_month", "category_id")
        .agg(F.sum("monthly_revenue").alias("category_month_revenue"))
    )


def category_share(
    monthly: DataFrame, category_id: int | None = None, product_id: int | None = None
) -> DataFrame:
    """Each product's share of its category's revenue, month by month.

    A category-month may hold any number of products, so its total is a partial
    aggregate joined back, not a window that gathers the group in one task. The
    totals are the small side of the join; Spark checks their size at run time.
    A product without a name counts in the total and is not listed.
    """
    monthly = select_products(monthly, category_id)
    products = product_month_revenue(monthly).where(F.col("product_name").isNotNull())
    totals = category_month_revenue(monthly).select(
        F.col("order_year_month").alias("_month"),
        F.col("category_id").alias("_category"),
        "category_month_revenue",
    )
    same_month = F.col("order_year_month").eqNullSafe(F.col("_month"))
    same_category = F.col("category_id") == F.col("_category")
    share = ratio(F.col("product_month_revenue"), F.col("category_month_revenue"))
    shares = (
        products.join(totals, same_month & same_category, "left")
        .drop("_month", "_category")
        .withColumn("category_revenue_share", share)
    )
    return select_products(shares, product_id=product_id)


def demand_growth(
    monthly: DataFrame,
    series: Sequence[str] = SERIES,
    units: str = "monthly_demand_units",
) -> DataFrame:
    """Change of units against the previous month that has a row in the series.

    The first month, and any month after one with zero units, has null growth. The
    default series is the monthly table's key, so a window partition holds one row per
    month, and so it does for totals that have no product at all. Pass
    ``series=("product_name",)`` to follow names across product ids; rows without a name
    are then left out. A name may stand for any number of products, so its rows are
    followed over the ranges of a sort, of which a long series fills several.
    """
    if "product_name" in series and "product_id" not in series:
        monthly = monthly.where(F.col("product_name").isNotNull())
    ties = [c for c in SERIES if c in monthly.columns]
    order = [F.asc_nulls_last(c) for c in ("order_year_month", *ties) if c not in series]
    growth = ratio(F.col(units), F.col("_before")) - 1
    if "product_id" in series or "product_id" not in monthly.columns:
        before = F.lag(units).over(Window.partitionBy(*series).orderBy(*order))
        followed = monthly.withColumn("_before", before)
    else:
        followed = with_previous(monthly, series, order, units, "_before")
    return followed.withColumn("demand_growth_rate", growth).drop("_before")


def period_summary(monthly: DataFrame) -> DataFrame:
    """Totals and monthly means per named product over the months present."""
    named = monthly.where(F.col("product_name").isNotNull())
    return named.groupBy("product_id", "product_name").agg(
        F.sum("monthly_demand_units").alias("total_demand_units"),
        F.sum("monthly_revenue").alias("total_revenue"),
        F.avg("monthly_demand_units").alias("avg_monthly_demand_units"),
        F.avg("monthly_revenue").alias("avg_monthly_revenue"),
    )
