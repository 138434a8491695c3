"""Sorts for people, and what a whole order tells each row: its place, its neighbour.

Stored tables stay unsorted unless a job asks for a sort. A place in the whole order, a
running total over it and the row before are found without a window over the whole table:
the sort deals the rows out by ranges, each range is numbered by itself, and one row per
range carries over what the ranges before it hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ordertide.sources.staging import staged

#: Low bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33


def highest_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Descending by a measure (nulls last), equal values by ``ties``."""
    return df.orderBy(F.desc(measure), *ties)


def by_month(df: DataFrame, measure: str = "monthly_revenue", *ties: str) -> DataFrame:
    """Month by month, the highest measure first within a month."""
    return df.orderBy("order_year_month", F.desc(measure), *ties)


def by_series(df: DataFrame, *series: str) -> DataFrame:
    """Series by series, month by month within one."""
    return df.orderBy(*series, "order_year_month")


def by_number(df: DataFrame, column: str, lenient: bool = False) -> DataFrame:
    """Ascending by a text column that holds whole numbers."""
    number = F.col(column)
    return df.orderBy(number.try_cast(LongType()) if lenient else number.cast(LongType()))


def preview(df: DataFrame, rows: int) -> DataFrame:
    """The first rows. After one of the sorts above this is a bounded top-k."""
    return df.limit(rows)


def in_ranges(ordered: DataFrame, name: str = "ordered") -> DataFrame:
    """A sorted frame, stored with ``_range`` and ``_index``: which range of the order a row
    lies in and where, both from 0.

    Two runs of one sort may cut the ranges differently, so it runs once, and all that is
    told of the ranges is read from the stored table, also when an executor is lost.
    """
    at = F.col("_at")
    stored = staged(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    places = {"_range": F.shiftright(at, _ROW_BITS), "_index": at % F.lit(1 << _ROW_BITS)}
    return stored.withColumns(places).drop("_at")


def _before(total: Column) -> Column:
    """The sum of a column over the ranges before a row's own: a window of one row per range."""
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(ranges), F.lit(0))


def placed(
    ordered: DataFrame, running: Mapping[str, str] | None = None, name: str = "ordered"
) -> DataFrame:
    """Every row of a sorted frame with its ``place`` in the whole order, from 1.

    ``running`` maps new columns to whole-number columns whose sum over all rows before
    they give; nulls add nothing. Equal rows get their places in any order. The rows come back
    unsorted: ``orderBy("place")`` prints them. An empty frame stays empty.
    """
    running = dict(running or {})
    if taken := {"place", *running} & set(ordered.columns):
        raise ValueError(f"the frame already has {', '.join(sorted(taken))}")
    own = {column: f"c{i}" for i, column in enumerate(ordered.columns)}
    rows = in_ranges(ordered.toDF(*own.values()), name)
    running = {new: own[column] for new, column in running.items()}
    sums = [F.coalesce(F.sum(column), F.lit(0)).alias(f"_{new}") for new, column in running.items()]
    totals = rows.groupBy("_range").agg(F.count("*").alias("_rows"), *sums)
    offsets = totals.select(
        "_range",
        _before(F.col("_rows")).alias("_rows"),
        *(_before(F.col(f"_{new}")).alias(f"_{new}") for new in running),
    )
    inside = Window.partitionBy("_range").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {new: F.coalesce(F.sum(column).over(inside), F.lit(0)) for new, column in running.items()}
    )
    # One row per partition of the sort, so its size is bounded whatever the table.
    rows = rows.join(F.broadcast(offsets), "_range")
    return rows.select(
        *(F.col(c).alias(column) for column, c in own.items()),
        *((F.col(new) + F.col(f"_{new}")).alias(new) for new in running),
        (F.col("_rows") + F.col("_index") + 1).alias("place"),
    )


def with_previous(
    df: DataFrame, series: Sequence[str], order: Sequence[Column | str], column: str, name: str
) -> DataFrame:
    """Add the ``column`` of the row before in the same series, as ``name``; null for the first.

    For series of any length. The rows are sorted by series and order, so a long series is
    cut over as many ranges as it fills; a range's first row takes over from the last row of
    the range before, if that is of its series. Null keys are a series of their own.
    """
    kept = df.columns
    rows = in_ranges(df.orderBy(*(F.asc_nulls_last(c) for c in series), *order), "series")
    inside = Window.partitionBy("_range", *series).orderBy("_index")
    rows = rows.withColumns(
        {name: F.lag(column).over(inside), "_first": F.row_number().over(inside) == 1}
    )
    ends = rows.groupBy("_range").agg(
        F.max_by(F.struct(*series, F.col(column).alias("_value")), "_index").alias("_end")
    )
    carried = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_end"))
    same = F.col("_first") & F.col("_end").isNotNull()
    for key in series:
        same &= F.col(key).eqNullSafe(F.col(f"_end.{key}"))
    # One row per partition of the sort, so its size is bounded whatever the table.
    rows = rows.join(F.broadcast(carried), "_range")
    return rows.select(*kept, F.when(same, F.col("_end._value")).otherwise(F.col(name)).alias(name))
