"""Demand reports straight from the three input tables.

The operators in ``ordertide.operators.demand`` aggregate any line-level frame.
When a report starts from the input tables, the lines can be totalled *before*
they meet the dimension they do not need at line grain, so the join moves totals
instead of lines. Results equal join-then-aggregate, also when a dimension has
duplicate keys.

``lines`` are as ``clean_order_details`` returns them: one per order and product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schemas
from ordertide.functions import calendar_parts, line_revenue, month_parts, ratio
from ordertide.operators.cleaning import clean_order_details, clean_orders, clean_products
from ordertide.operators.trends import demand_growth
from ordertide.session import small_tasks


def _times_copies(*names: str) -> list[Column]:
    return [F.sum(F.col(name) * F.col("_copies")).alias(name) for name in names]


def _mean_price() -> Column:
    return ratio(F.sum("_price"), F.sum("_priced"))


def _distinct_orders(orders: DataFrame, *keys: Column) -> DataFrame:
    """One row per order id and key, with the number of order rows it stands for.

    Lines are unique per order and product, so once orders are unique too a plain
    count is the distinct count, and the lines are spared three more aggregations.

    The second grouping column keeps the result from leaving the aggregate placed
    by ``order_id`` alone. The join then shuffles this narrow table once more, and
    in return Spark can split a hot order between tasks: it does so only where a
    shuffle feeds the join directly on both sides.
    """
    side = orders.where(F.col("order_id").isNotNull()).select(
        "order_id", *(keys or [F.xxhash64("order_id").alias("_spread")])
    )
    return side.groupBy(*side.columns).agg(F.count("*").alias("_copies")).drop("_spread")


def _per_product(lines: DataFrame, orders: DataFrame, *order_keys: Column) -> DataFrame:
    """Line totals per product (and order attribute) over the lines that have an order.

    A task sorts its lines and its orders and holds a hash table of totals, of which there are almost
    as many as lines, so it is given few of them.
    """
    small_tasks(lines.sparkSession)
    order_side = _distinct_orders(orders, *order_keys)
    names = [c for c in order_side.columns if c not in ("order_id", "_copies")]
    measured = lines.select(
        "order_id",
        "product_id",
        F.col("quantity").alias("_units"),
        line_revenue().alias("_revenue"),
        F.col("unit_price").alias("_price"),
        F.when(F.col("unit_price").isNotNull(), 1).otherwise(0).alias("_priced"),
    )
    return (
        measured.join(order_side, "order_id")
        .groupBy("product_id", *names)
        .agg(
            *_times_copies("_units", "_revenue", "_price", "_priced"),
            F.count("*").alias("_orders"),
        )
    )


def _with_products(totals: DataFrame, products: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach product columns to totals that are one row per product (and order attribute).

    Product rows that agree in ``columns`` are one row with their number before they meet the
    totals, as orders are; dealt by product, they stay so for the join. So the totals are not
    grouped again: a task holds them once, in the aggregate that made them, and not in two more
    hash tables.
    """
    side = products.select(*columns).where(F.col("product_id").isNotNull())
    side = side.repartition("product_id").groupBy(*columns).agg(F.count("*").alias("_rows"))
    measures = [c for c in ("_units", "_revenue") if c in totals.columns]
    joined = totals.join(side, "product_id")
    return joined.withColumns({c: F.col(c) * F.col("_rows") for c in measures}).drop("_rows")


def product_revenue(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and quantity per product."""
    keys = ("product_id", "product_name")
    totals = _with_products(_per_product(lines, orders), products, keys)
    return totals.select(
        *keys, F.col("_revenue").alias("total_revenue"), F.col("_units").alias("total_quantity")
    )


def product_demand_summary(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue, distinct orders and mean unit price per product."""
    totals = _with_products(_per_product(lines, orders), products, schemas.PRODUCT_KEYS)
    return totals.select(
        *schemas.PRODUCT_KEYS,
        F.col("_units").alias("total_demand_units"),
        F.col("_revenue").alias("total_revenue"),
        F.col("_orders").alias("order_count"),
        ratio(F.col("_price"), F.col("_priced")).alias("avg_unit_price"),
    )


def product_demand_monthly(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and distinct orders per calendar month and product."""
    month = F.trunc("order_date", "month").alias("_month")
    totals = _with_products(_per_product(lines, orders, month), products, schemas.PRODUCT_KEYS)
    return totals.select(
        *month_parts("_month"),
        *schemas.PRODUCT_KEYS,
        F.col("_units").alias("monthly_demand_units"),
        F.col("_revenue").alias("monthly_revenue"),
        F.col("_orders").alias("monthly_order_count"),
    )


def daily_product_demand(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units per order date and product."""
    totals = _per_product(lines, orders, F.col("order_date"))
    totals = _with_products(totals, products, ["product_id"])
    return totals.select("order_date", "product_id", F.col("_units").alias("daily_demand_units"))


def _per_order(lines: DataFrame, products: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Line totals per order and product or line attribute: an order of any length is one row
    for each value of it that the order has."""
    product_keys = [c for c in keys if c in products.columns and c != "product_id"]
    line_keys = [c for c in keys if c not in product_keys]
    return (
        lines.join(products.select("product_id", *product_keys), "product_id")
        .groupBy("order_id", *line_keys, *product_keys)
        .agg(
            F.sum("quantity").alias("_units"),
            F.sum(line_revenue()).alias("_revenue"),
            F.sum("unit_price").alias("_price"),
            F.count("unit_price").alias("_priced"),
        )
    )


def _per_key(orders: DataFrame, per_order: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key of the orders, of what was totalled per order, or of both."""
    return (
        orders.join(per_order, "order_id")
        .groupBy(*keys)
        .agg(
            F.sum("_units").alias("total_demand_units"),
            F.sum("_revenue").alias("total_revenue"),
            F.countDistinct("order_id").alias("order_count"),
            _mean_price().alias("avg_unit_price"),
        )
    )


def demand_by_order_attribute(
    lines: DataFrame, orders: DataFrame, products: DataFrame, *keys: str
) -> DataFrame:
    """Units, revenue, distinct orders and mean unit price by customer, employee, or
    another order column.

    Lines are totalled per order before they meet the orders, so an order of any
    length is one row in that join, and the distinct count that follows is over
    orders already placed by their id.
    """
    order_side = orders.select(*dict.fromkeys(("order_id", *keys)))
    return _per_key(order_side, _per_order(lines, products), keys)


def demand_by_product_attribute(
    lines: DataFrame, orders: DataFrame, products: DataFrame, *keys: str
) -> DataFrame:
    """Units, revenue, distinct orders and mean unit price by category, supplier, or
    another product column."""
    return _per_key(orders.select("order_id"), _per_order(lines, products, keys), keys)


#: Columns of the demand features that derive from a line alone, and from its order's date.
_OF_LINES = ("demand_units", "revenue")
_CALENDAR = ("order_year", "order_month", "order_year_month")


def demand_by(lines: DataFrame, orders: DataFrame, products: DataFrame, *keys: str) -> DataFrame:
    """Units, revenue, distinct orders and mean unit price by any columns of the order lines, the
    orders, the products, and by the calendar columns; none is one row over all.

    Two levels: lines are totalled per order and per key that is a product's or the line's own, and
    those totals meet the orders, which bring the other keys. A hot order is a row per value of the
    former, a hot customer or category is added up before the last shuffle.
    """
    of_orders = [c for c in keys if c in orders.columns and c != "product_id"]
    calendar = [c for c in keys if c in _CALENDAR and c not in of_orders]
    further = [c for c in keys if c not in of_orders and c not in calendar]
    known = {*lines.columns, *products.columns, *_OF_LINES}
    if unknown := [c for c in further if c not in known]:
        raise ValueError(f"no column {', '.join(unknown)} in the lines, orders or products")
    derived = {"demand_units": F.col("quantity"), "revenue": line_revenue()}
    lines = lines.withColumns({c: derived[c] for c in further if c in derived})
    dated = orders.withColumns({c: x for c, x in calendar_parts().items() if c in calendar})
    order_side = dated.select(*dict.fromkeys(("order_id", *of_orders, *calendar)))
    return _per_key(order_side, _per_order(lines, products, further), keys)


def monthly_demand_by_product_attribute(
    lines: DataFrame, orders: DataFrame, products: DataFrame, *keys: str
) -> DataFrame:
    """Units, revenue and distinct orders per month and category, supplier, or another product column.

    Lines are totalled to one row per order and key and orders are one row per id and month, so a
    plain count is the distinct count and no task holds a hash table of orders to count them.
    """
    order_side = _distinct_orders(orders, F.trunc("order_date", "month").alias("_month"))
    return (
        order_side.join(_per_order(lines, products, keys), "order_id")
        .groupBy("_month", *keys)
        .agg(*_times_copies("_units", "_revenue"), F.count("*").alias("_orders"))
        .select(
            *month_parts("_month"),
            *keys,
            F.col("_units").alias("monthly_demand_units"),
            F.col("_revenue").alias("monthly_revenue"),
            F.col("_orders").alias("monthly_order_count"),
        )
    )


def category_demand_monthly(
    lines: DataFrame, orders: DataFrame, products: DataFrame
) -> DataFrame:
    """Monthly demand per category, with the growth of its units against the month before."""
    monthly = monthly_demand_by_product_attribute(lines, orders, products, "category_id")
    return demand_growth(monthly, series=("category_id",))


def cleaned(
    order_details: DataFrame, orders: DataFrame, products: DataFrame, lenient: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three input tables, cleaned, in the argument order of the reports above."""
    return (
        clean_order_details(order_details, lenient=lenient),
        clean_orders(orders, lenient),
        clean_products(products, lenient),
    )


def cleaned_lines(
    order_details: DataFrame, orders: DataFrame, products: DataFrame, lenient: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Only the lines cleaned; ids and names stay as the source has them."""
    return clean_order_details(order_details, typed_keys=False, lenient=lenient), orders, products
