"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType


def typed(name: str, kind: DataType, lenient: bool = False) -> Column:
    """Cast a column; malformed text is an error, or null when ``lenient``.

    Lenient whole numbers may be written with a fraction of zero, as in ``12.0``.
    """
    column = F.col(name)
    if not lenient:
        return column.cast(kind)
    if not isinstance(kind, IntegralType):
        return column.try_cast(kind)
    number = column.try_cast("decimal(38,10)")
    return F.coalesce(column.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def line_revenue() -> Column:
    """Price of an order line after discount, multiplied left to right in double."""
    return F.col("unit_price") * F.col("quantity") * (1 - F.col("discount"))


def calendar_parts(date: str = "order_date") -> dict[str, Column]:
    """Year, month and ``yyyy-MM`` of a date. A null date gives nulls."""
    return {
        "order_year": F.year(date),
        "order_month": F.month(date),
        "order_year_month": F.date_format(date, "yyyy-MM"),
    }


def month_parts(month: str) -> list[Column]:
    """The calendar columns of a first-of-month date, in output order."""
    return [part.alias(name) for name, part in calendar_parts(month).items()]


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null where ``whole`` is zero or null."""
    return F.try_divide(part, whole)


def missing(name: str, kind: DataType) -> Column:
    """True for null, and for NaN in a floating-point column."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (DoubleType, FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
