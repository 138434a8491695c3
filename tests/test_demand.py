import datetime as dt
import random

import pytest
from conftest import rows
from ordertide import schemas
from ordertide.operators import demand, ordering
from ordertide.plans import demand as plans

DAY = dt.date


def lines_of(spark, data):
    return spark.createDataFrame(data, schemas.ORDER_DETAILS)


def orders_of(spark, data):
    return spark.createDataFrame(data, schemas.ORDERS)


def products_of(spark, data):
    return spark.createDataFrame(data, schemas.PRODUCTS)


def small(spark):
    lines = [(1, 10, 2.0, 3, 0.0), (1, 11, 5.0, 1, 0.5), (2, 10, 4.0, 1, 0.25), (3, 99, 1.0, 1, 0.0),
             (9, 10, 1.0, 1, 0.0)]
    orders = [(1, "a", 1, DAY(1997, 1, 5)), (2, "b", 1, None), (3, "b", 2, DAY(1997, 2, 1))]
    products = [(10, "nut", 1, 7), (11, "bolt", 1, 8)]
    return lines_of(spark, lines), orders_of(spark, orders), products_of(spark, products)


def features(spark, tables=None):
    return demand.with_demand_features(demand.demand_base(*(tables or small(spark))))


def test_line_revenue(spark):
    df = spark.createDataFrame(
        [("903", "valve", 2.5, 32, 0.5)],
        "product_id string, product_name string, unit_price double, quantity bigint, discount double",
    )
    assert demand.with_revenue(df).first()["revenue"] == 40.0


def test_base_drops_lines_without_order_or_product(spark):
    base = demand.demand_base(*small(spark))
    assert base.schema.fieldNames() == schemas.DEMAND_BASE.fieldNames()
    assert [(r.order_id, r.product_id) for r in base.orderBy("order_id", "product_id").collect()] == [
        (1, 10), (1, 11), (2, 10),
    ]


def test_base_takes_the_price_of_the_line(spark):
    lines, orders, products = small(spark)
    priced = products.selectExpr("*", "100.0D AS unit_price")
    assert {r.unit_price for r in demand.demand_base(lines, orders, priced).collect()} == {2.0, 5.0, 4.0}


def test_duplicate_dimension_keys_fan_out(spark):
    lines, orders, products = small(spark)
    assert demand.demand_base(lines, orders.union(orders), products).count() == 6


def test_features_and_declared_types(spark):
    df = features(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.DEMAND_FEATURES
    ]
    dated, undated = df.where("order_id = 1 AND product_id = 10").first(), df.where("order_id = 2").first()
    assert (dated.demand_units, dated.revenue, dated.order_year, dated.order_month) == (3, 6.0, 1997, 1)
    assert dated.order_year_month == "1997-01"
    assert (undated.order_year, undated.order_month, undated.order_year_month) == (None, None, None)


def test_product_revenue_sorted_highest_first(spark):
    df = spark.createDataFrame(
        [("a1", "hose", 8.5, 2), ("b2", "valve", 3.0, 9), ("a1", "hose", 1.25, 6)],
        "product_id string, product_name string, revenue double, quantity bigint",
    )
    ranked = ordering.highest_first(demand.product_revenue(df), "total_revenue").collect()
    assert [tuple(r) for r in ranked] == [("a1", "hose", 9.75, 8), ("b2", "valve", 3.0, 9)]


def test_summary_counts_orders_once_and_averages_the_filled_price(spark):
    assert rows(demand.product_demand_summary(features(spark))) == [
        (10, "nut", 1, 4, 9.0, 2, 3.0),
        (11, "bolt", 1, 1, 2.5, 1, 5.0),
    ]


def test_monthly_keeps_undated_orders_as_a_group(spark):
    assert rows(demand.product_demand_monthly(features(spark))) == [
        (None, None, None, 10, "nut", 1, 1, 3.0, 1),
        (1997, 1, "1997-01", 10, "nut", 1, 3, 6.0, 1),
        (1997, 1, "1997-01", 11, "bolt", 1, 1, 2.5, 1),
    ]


def test_category_counts_an_order_with_two_products_once(spark):
    monthly = demand.category_demand_monthly(features(spark)).where("order_year = 1997")
    assert rows(monthly) == [(1997, 1, "1997-01", 1, 4, 8.5, 1)]


def test_daily_demand(spark):
    assert rows(demand.daily_product_demand(features(spark))) == [
        (None, 10, 1), (DAY(1997, 1, 5), 10, 3), (DAY(1997, 1, 5), 11, 1),
    ]


def test_sorts_put_missing_measures_last_and_months_in_order(spark):
    df = spark.createDataFrame(
        [("b", None, "02"), ("a", 1.0, "02"), ("c", 5.0, "01"), ("d", 1.0, "01")],
        "id string, v double, order_year_month string",
    )
    assert [r.id for r in ordering.highest_first(df, "v", "id").collect()] == ["c", "a", "d", "b"]
    assert [r.id for r in ordering.by_month(df, "v").collect()] == ["c", "d", "a", "b"]
    text = spark.createDataFrame([("10",), ("9",), ("x",)], "k string")
    assert [r.k for r in ordering.by_number(text, "k", lenient=True).collect()] == ["x", "9", "10"]
    assert ordering.preview(text, 2).count() == 2


def random_tables(spark, seed):
    """Tables with orphans, null keys, null dates and duplicate dimension rows."""
    rng = random.Random(seed)
    pairs = {(rng.choice([None, *range(30)]), rng.choice([None, *range(12)])) for _ in range(150)}
    lines = [(o, p, float(rng.randint(1, 40)), rng.randint(0, 9), rng.choice([0.0, 0.25, 0.5]))
             for o, p in pairs]
    dates = [None] + [DAY(1997, m, d) for m in (1, 2, 3) for d in (1, 15)]
    orders = [(rng.choice([None, *range(26)]), rng.choice("abc"), rng.randint(1, 3), rng.choice(dates))
              for _ in range(40)]
    products = [(rng.choice([None, *range(10)]), rng.choice(["nut", "bolt", None]), rng.randint(1, 2), 1)
                for _ in range(14)]
    return (lines_of(spark, lines), orders_of(spark, orders + orders[:5]),
            products_of(spark, products + products[:3]))


@pytest.mark.parametrize("seed", range(4))
def test_reports_from_tables_equal_join_then_aggregate(spark, seed):
    tables = random_tables(spark, seed)
    joined = features(spark, tables).cache()
    assert joined.count() > 0
    pairs = [
        (plans.product_revenue, demand.product_revenue),
        (plans.product_demand_summary, demand.product_demand_summary),
        (plans.product_demand_monthly, demand.product_demand_monthly),
        (plans.daily_product_demand, demand.daily_product_demand),
    ]
    for from_tables, from_features in pairs:
        left, right = from_tables(*tables), from_features(joined)
        assert left.columns == right.columns
        assert left.dtypes == right.dtypes
        assert rows(left) == rows(right)
    for key in ("customer_id", "employee_id"):
        left = plans.demand_by_order_attribute(*tables, key)
        right = demand.demand_by(joined, key)
        assert left.dtypes == right.dtypes
        assert rows(left) == rows(right)
    for keys in (
        (), ("customer_id", "category_id"), ("order_year_month", "employee_id", "supplier_id"), ("product_id", "customer_id"),
        ("order_id",), ("product_id", "order_id"), ("quantity", "discount"), ("revenue", "order_year", "demand_units", "product_name"),
    ):
        left, right = plans.demand_by(*tables, *keys), demand.demand_by(joined, *keys)
        assert left.dtypes == right.dtypes
        assert rows(left) == rows(right)
    with pytest.raises(ValueError, match="no column nope"):
        plans.demand_by(*tables, "nope")
    joined.unpersist()


def test_declared_report_schemas(spark):
    from ordertide.plans.jobs import REPORTS

    for report in REPORTS.values():
        if report.schema is not None:
            built = report.from_tables(*small(spark))
            assert [(f.name, f.dataType) for f in built.schema] == [
                (f.name, f.dataType) for f in report.schema
            ]
