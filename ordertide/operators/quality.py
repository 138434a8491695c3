"""Data-quality reports, each a small table computed in one pass per input."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordertide.functions import missing, ratio, typed


def _counted(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _rows(totals: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn the single row of an aggregate into one row per struct."""
    return totals.select(F.inline(F.array(*rows)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The number of rows of each table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def schema_report(df: DataFrame, expected: StructType) -> DataFrame:
    """Expected against actual columns, and how many values would not survive the cast.

    Lists the expected columns in order, then the unexpected ones.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    failing = {
        name: F.col(f"`{name}`").isNotNull() & F.col(f"`{name}`").try_cast(kind).isNull()
        for name, kind in wanted.items()
        if name in actual and actual[name] != kind
    }
    counts = [_counted(test, f"_{i}") for i, test in enumerate(failing.values())]
    totals = df.agg(F.count("*").alias("_rows"), *counts)
    at = {name: F.col(f"_{i}") for i, name in enumerate(failing)}

    def row(name: str) -> Column:
        want, have = wanted.get(name), actual.get(name)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(want.simpleString() if want else None).cast("string").alias("expected_type"),
            F.lit(have.simpleString() if have else None).cast("string").alias("actual_type"),
            F.lit(have is not None).alias("present"),
            F.lit(want is not None and want == have).alias("type_matches"),
            F.col("_rows").alias("row_count"),
            at.get(name, F.lit(0)).cast("bigint").alias("uncastable_values"),
        )

    extra = [name for name in actual if name not in wanted]
    return _rows(totals, [row(name) for name in (*wanted, *extra)])


def loss_counts(expected: StructType) -> list[Column]:
    """Aggregates over an input with the expected columns' names: its rows, and the values of each
    column that a lenient cast makes null."""
    lost = [
        _counted(F.col(f.name).isNotNull() & typed(f.name, f.dataType, lenient=True).isNull(), f"_{i}")
        for i, f in enumerate(expected.fields)
    ]
    return [F.count(F.lit(1)).alias("_rows"), *lost]


def loss_rows(totals: DataFrame, expected: StructType) -> DataFrame:
    """One row per expected column of the single row that :func:`loss_counts` makes."""
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"_{i}").alias("lost_values"),
        )
        for i, name in enumerate(expected.fieldNames())
    ]
    return _rows(totals, rows)


def cast_losses(df: DataFrame, expected: StructType) -> DataFrame:
    """How many values of each expected column a lenient cast makes null, by a scan of its own."""
    return loss_rows(df.agg(*loss_counts(expected)), expected)


def null_report(
    df: DataFrame, thresholds: Mapping[str, float] | None = None, default: float = 0.0
) -> DataFrame:
    """Missing values per column against a permitted share of rows."""
    thresholds = thresholds or {}
    fields = df.schema.fields
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[_counted(missing(f.name, f.dataType), f"_{i}") for i, f in enumerate(fields)],
    )

    def row(i: int, name: str) -> Column:
        count, limit = F.col(f"_{i}"), F.lit(float(thresholds.get(name, default)))
        share = F.coalesce(ratio(count, F.col("_rows")), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            count.alias("null_count"),
            share.alias("null_ratio"),
            limit.alias("threshold"),
            (share <= limit).alias("passed"),
        )

    return _rows(totals, [row(i, f.name) for i, f in enumerate(fields)])


def integrity_report(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Duplicate keys and order lines that lack their order or product.

    Every input is counted per key before it is compared, so a key that fills
    the table is one row by the time it reaches a join. The lines are counted per
    (order, product) once, and both references are totals of those counts. A line
    whose key is null lacks its order or product; null keys of one table are equal.
    """
    per_order = orders.groupBy("order_id").agg(F.count("*").alias("copies"))
    per_product = products.groupBy("product_id").agg(F.count("*").alias("copies"))
    per_line = lines.groupBy("order_id", "product_id").agg(F.count("*").alias("copies"))

    def duplicates(name: str, counts: DataFrame) -> DataFrame:
        return _check(name, counts.agg(F.count_if(F.col("copies") > 1).alias("violations")))

    def orphans(name: str, key: str, parents: DataFrame) -> DataFrame:
        references = per_line.groupBy(key).agg(F.sum("copies").alias("copies"))
        unmatched = references.join(parents.select(key), key, "left_anti")
        total = F.coalesce(F.sum("copies"), F.lit(0)).alias("violations")
        return _check(name, unmatched.agg(total))

    checks = [
        duplicates("duplicate_order_lines", per_line),
        duplicates("duplicate_orders", per_order),
        duplicates("duplicate_products", per_product),
        orphans("lines_without_order", "order_id", per_order),
        orphans("lines_without_product", "product_id", per_product),
    ]
    return reduce(DataFrame.unionByName, checks)


def _check(name: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(name).alias("check_name"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )
