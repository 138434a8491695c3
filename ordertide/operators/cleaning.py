"""Typed, de-duplicated, null-free versions of the three input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordertide import schemas
from ordertide.functions import typed


def named_as(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns that ``schema`` names, found without regard to case, named as there."""
    found = {name.lower(): name for name in df.columns}
    absent = [name for name in schema.fieldNames() if name.lower() not in found]
    if absent:
        raise ValueError(f"input has no column {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df.withColumnsRenamed({found[name.lower()]: name for name in schema.fieldNames()})


def cast_columns(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """Cast the columns that ``schema`` names and keep every other column as it is.

    Names match as in Spark, without regard to case, and come out as in ``schema``.
    """
    df = named_as(df, schema)
    return df.withColumns({f.name: typed(f.name, f.dataType, lenient) for f in schema.fields})


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``prefer``, a known value before a missing one.

    Null keys form one group. Spark turns the row number filter into a group
    limit that runs before the shuffle as well, so a key with very many copies
    sends at most one row per input partition. Columns outside ``prefer`` break
    the remaining ties where they can be ordered, so the result does not depend
    on row order.
    """
    named = {c.lower() for c in (*keys, *prefer)}
    others = [c for c in df.columns if c.lower() not in named]
    sortable = [
        c for c in others if df.schema[c].dataType.typeName() not in ("map", "variant")
    ]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (*prefer, *sortable)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def clean_order_details(
    df: DataFrame, typed_keys: bool = True, lenient: bool = False
) -> DataFrame:
    """Order lines with typed measures, one per (order, product), no missing measure.

    ``typed_keys=False`` leaves both ids as they arrive. Casts come before the
    de-duplication, so the keys ``"1"`` and ``"01"`` are one key once typed and
    prices compare as numbers.
    """
    fields = [
        f for f in schemas.ORDER_DETAILS.fields if typed_keys or f.name not in schemas.LINE_KEYS
    ]
    lines = cast_columns(df, StructType(fields), lenient)
    lines = keep_one(lines, schemas.LINE_KEYS, schemas.LINE_MEASURES)
    return lines.fillna(0, subset=list(schemas.LINE_MEASURES))


def clean_orders(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Orders with typed ids and dates, including the fulfillment dates if present."""
    present = {name.lower() for name in df.columns}
    dates = [f for f in schemas.FULFILLMENT_DATES.fields if f.name.lower() in present]
    return cast_columns(df, StructType(schemas.ORDERS.fields + dates), lenient)


def clean_products(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Products with typed ids and a trimmed name."""
    products = cast_columns(df, schemas.PRODUCTS, lenient)
    return products.withColumn("product_name", F.trim("product_name"))
