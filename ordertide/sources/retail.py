"""The star-schema test tables seen as the three canonical input tables.

The tables lack some columns the canonical ones have; stand-ins are marked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days between an order and its promised delivery (stand-in).
PROMISED_DAYS = 30


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_details(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with stand-ins for employee, promised date and shipper."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 9 + 1).alias("employee_id"),
        F.col("o_orderdate").alias("order_date"),
        F.date_add(F.col("o_orderdate").cast("date"), PROMISED_DAYS).alias("required_date"),
        F.col("o_orderpriority").alias("shipper"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Products; the brand number stands in for the category and the smallest
    supplier of the product's lines for its supplier. Spark drops the supplier
    join from a query that does not read that column."""
    suppliers = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"))
        .agg(F.min("l_suppkey").alias("supplier_id"))
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.substring("p_brand", 7, 10).alias("category_id"),
    )
    return parts.join(suppliers, "product_id", "left")


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """The day the last line of an order shipped."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.max("l_shipdate").cast("date").alias("shipped_date"))
    )
