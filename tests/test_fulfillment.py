import datetime as dt

import pytest
from conftest import rows
from ordertide import schemas
from ordertide.operators import fulfillment

PROMISED = dt.date(1997, 3, 10)


def orders(spark, delays, shipper="x"):
    shipped = [None if d is None else PROMISED + dt.timedelta(days=d) for d in delays]
    data = [(i, f"c{i % 2}", shipper, PROMISED, s) for i, s in enumerate(shipped)]
    return spark.createDataFrame(
        data,
        "order_id bigint, customer_id string, shipper string, required_date date, shipped_date date",
    )


def test_delay_and_status(spark):
    df = fulfillment.order_fulfillment(orders(spark, [-1, 0, 3, None]))
    found = rows(df.select("order_id", "delay_days", "on_time", "late", "unshipped"))
    assert found == [
        (0, -1, True, False, False),
        (1, 0, True, False, False),
        (2, 3, False, True, False),
        (3, None, False, False, True),
    ]


def test_rates_divide_by_all_orders(spark):
    kpis = fulfillment.service_kpis(fulfillment.order_fulfillment(orders(spark, [-1, 0, 3, None])))
    assert tuple(kpis.first())[:6] == (4, 2, 1, 1, 0.5, 0.25)
    assert kpis.first()["avg_delay_days"] == pytest.approx(2 / 3)


def test_no_orders_give_null_rates(spark):
    kpis = fulfillment.service_kpis(fulfillment.order_fulfillment(orders(spark, [1]).limit(0)))
    assert tuple(kpis.first()) == (0, 0, 0, 0, None, None, None)


def test_kpis_by_key(spark):
    df = fulfillment.order_fulfillment(orders(spark, [-1, 0, 3, None]))
    assert [r[:4] for r in rows(fulfillment.service_kpis(df, "customer_id"))] == [
        ("c0", 2, 1, 1), ("c1", 2, 1, 0),
    ]


def test_product_kpis_count_an_order_once(spark):
    df = fulfillment.order_fulfillment(orders(spark, [-1, 3]))
    lines = spark.createDataFrame([(0, 5), (0, 5), (1, 5), (1, 6), (9, 6)], "order_id bigint, product_id bigint")
    found = rows(fulfillment.service_kpis_by_product(df, lines))
    assert [r[:4] for r in found] == [(5, 2, 1, 1), (6, 1, 0, 1)]


def test_orders_without_shipment_stay(spark):
    shipments = spark.createDataFrame([(0, PROMISED)], "order_id bigint, shipped_date date")
    df = fulfillment.attach_shipments(orders(spark, [5, 5]), shipments)
    assert rows(df.select("order_id", "shipped_date")) == [(0, PROMISED), (1, None)]


def test_demand_and_service_keeps_orders_without_lines(spark):
    both = orders(spark, [-1, 3]).union(orders(spark, [1], shipper="y").selectExpr("7L", "customer_id", "shipper", "required_date", "shipped_date"))
    lines = spark.createDataFrame(
        [(0, 5, 2.0, 3, 0.0), (1, 5, 2.0, 1, 0.5), (1, 6, 9.0, 1, 0.0)], schemas.ORDER_DETAILS
    )
    products = spark.createDataFrame([(5,)], "product_id bigint")
    report = fulfillment.demand_and_service(
        fulfillment.order_fulfillment(both), lines, products, "shipper"
    )
    assert [r[:6] for r in rows(report)] == [("x", 4, 7.0, 2, 1, 1), ("y", 0, 0.0, 1, 0, 1)]
