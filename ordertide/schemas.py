"""Canonical schemas of the datasets the operators read and produce.

Ids are ``bigint``: at the target volume an order number no longer fits an
``int``, and an overflowing cast is an error in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KEY = LongType()
COUNT = LongType()
INT = IntegerType()
MONEY = DoubleType()
TEXT = StringType()
DATE = DateType()
FLAG = BooleanType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


ORDER_DETAILS = _schema(
    order_id=KEY, product_id=KEY, unit_price=MONEY, quantity=INT, discount=MONEY
)

ORDERS = _schema(order_id=KEY, customer_id=TEXT, employee_id=KEY, order_date=DATE)

#: Order dates that only the fulfillment operators need.
FULFILLMENT_DATES = _schema(required_date=DATE, shipped_date=DATE)

PRODUCTS = _schema(product_id=KEY, product_name=TEXT, category_id=KEY, supplier_id=KEY)

DEMAND_BASE = _schema(
    order_id=KEY,
    order_date=DATE,
    customer_id=TEXT,
    employee_id=KEY,
    product_id=KEY,
    product_name=TEXT,
    category_id=KEY,
    supplier_id=KEY,
    unit_price=MONEY,
    quantity=INT,
    discount=MONEY,
)

DEMAND_FEATURES = StructType(
    DEMAND_BASE.fields
    + _schema(
        demand_units=INT, revenue=MONEY, order_year=INT, order_month=INT, order_year_month=TEXT
    ).fields
)

PRODUCT_REVENUE = _schema(
    product_id=KEY, product_name=TEXT, total_revenue=MONEY, total_quantity=COUNT
)

PRODUCT_DEMAND_SUMMARY = _schema(
    product_id=KEY,
    product_name=TEXT,
    category_id=KEY,
    total_demand_units=COUNT,
    total_revenue=MONEY,
    order_count=COUNT,
    avg_unit_price=MONEY,
)

PRODUCT_DEMAND_MONTHLY = _schema(
    order_year=INT,
    order_month=INT,
    order_year_month=TEXT,
    product_id=KEY,
    product_name=TEXT,
    category_id=KEY,
    monthly_demand_units=COUNT,
    monthly_revenue=MONEY,
    monthly_order_count=COUNT,
)

CATEGORY_SHARE = _schema(
    order_year_month=TEXT,
    category_id=KEY,
    product_id=KEY,
    product_name=TEXT,
    product_month_revenue=MONEY,
    category_month_revenue=MONEY,
    category_revenue_share=MONEY,
)

DEMAND_GROWTH = StructType(
    PRODUCT_DEMAND_MONTHLY.fields + _schema(demand_growth_rate=MONEY).fields
)

PERIOD_SUMMARY = _schema(
    product_id=KEY,
    product_name=TEXT,
    total_demand_units=COUNT,
    total_revenue=MONEY,
    avg_monthly_demand_units=MONEY,
    avg_monthly_revenue=MONEY,
)

LINE_KEYS = ("order_id", "product_id")
LINE_MEASURES = ("unit_price", "quantity", "discount")
PRODUCT_KEYS = ("product_id", "product_name", "category_id")
CALENDAR_KEYS = ("order_year", "order_month", "order_year_month")
