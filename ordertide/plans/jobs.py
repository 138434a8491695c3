"""Jobs: a source, a report, a sink and a preview, checked before Spark does any work.

The preview reads the stored result, so a job runs its plan once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import ClassVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordertide import schemas
from ordertide.operators import charts, demand, fulfillment, ordering, quality, trends
from ordertide.operators.cleaning import cast_columns, named_as
from ordertide.plans import demand as plans
from ordertide.sources import identity, readers, writers
from ordertide.sources.settings import Connection, Settings

Transform = Callable[[DataFrame], DataFrame]

INPUTS = ("order_details", "orders", "products")

EXPECTED = dict(
    zip(INPUTS, (schemas.ORDER_DETAILS, schemas.ORDERS, schemas.PRODUCTS), strict=True)
)

#: Database connections of a table's scan or write, unless the caller says otherwise.
CONNECTIONS = 16

FILE_READERS = {"parquet": readers.read_parquet, "csv": readers.read_csv}


@dataclass(frozen=True)
class Source:
    """A database table, or files: Parquet, or CSV with a header."""

    connection: Connection | None = None
    table: str | None = None
    path: str | None = None
    file_format: str = "parquet"
    split: readers.Split | None = None

    def check(self) -> None:
        if not (self.connection and self.table) and not self.path:
            raise ValueError("give a JDBC url and input table, or an input path")
        if self.file_format not in FILE_READERS:
            known = ", ".join(FILE_READERS)
            raise ValueError(f"no file format {self.file_format!r}; known: {known}")

    def load(self, spark: SparkSession) -> DataFrame:
        self.check()
        if self.connection and self.table:
            return readers.read_jdbc(spark, self.connection, self.table, self.split)
        return FILE_READERS[self.file_format](spark, self.path)

    def count(self, spark: SparkSession) -> int:
        """The number of rows. A database counts its own table."""
        self.check()
        if self.connection and self.table:
            return readers.count_jdbc(spark, self.connection, self.table)
        return quality.row_counts({"source": self.load(spark)}).first()["row_count"]


@dataclass(frozen=True)
class Sink:
    """A database table or a Parquet folder, overwritten."""

    connection: Connection | None = None
    table: str | None = None
    path: str | None = None
    partition_by: tuple[str, ...] = ()
    #: Connections of a database write; None writes one for each partition of the result.
    connections: int | None = CONNECTIONS
    #: How a stored database table is read back; None is over one connection.
    split: readers.Split | None = None

    def check(self) -> None:
        if not (self.connection and self.table) and not self.path:
            raise ValueError("give a JDBC url and output table, or an output path")
        if self.connections is not None and self.connections < 1:
            raise ValueError("a database write needs a connection at least")

    def save(self, df: DataFrame) -> DataFrame:
        """Write, then return the stored table."""
        self.check()
        if self.connection and self.table:
            writers.write_jdbc(df, self.connection, self.table, self.connections)
            return readers.read_jdbc(df.sparkSession, self.connection, self.table, self.split)
        writers.write_parquet(df, self.path, self.partition_by)
        return readers.read_parquet(df.sparkSession, self.path)


def _overwrites(sink: Sink, source: Source) -> bool:
    """Whether a sink would overwrite what the source reads."""
    if source.connection and source.table:
        if not (sink.connection and sink.table):
            return False
        return identity.same_table(
            source.connection.url, source.table, sink.connection.url, sink.table
        )
    if sink.connection and sink.table:
        return False
    return identity.overlapping(source.path, sink.path)


def _refuse_overwrites(sources: Iterable[Source], sinks: Iterable[Sink]) -> None:
    """All of a job's sources against all of its sinks, before anything is read."""
    sinks = list(sinks)
    for source in sources:
        for sink in sinks:
            if _overwrites(sink, source):
                raise ValueError(
                    f"the sink {sink.table or sink.path} is the source's own table or folder: "
                    "an overwrite would empty it before it is read"
                )


def _features(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return demand.with_demand_features(demand.demand_base(lines, orders, products))


def _fulfillment(orders: DataFrame) -> DataFrame:
    return fulfillment.order_fulfillment(cast_columns(orders, schemas.FULFILLMENT_DATES))


def _service_kpis(
    lines: DataFrame, orders: DataFrame, products: DataFrame, *by: str
) -> DataFrame:
    """KPIs over all orders, per order column, or per product."""
    outcome = _fulfillment(orders)
    if by == ("product_id",):
        return fulfillment.service_kpis_by_product(outcome, lines)
    return fulfillment.service_kpis(outcome, *by)


def _demand_and_service(
    lines: DataFrame, orders: DataFrame, products: DataFrame, *by: str
) -> DataFrame:
    return fulfillment.demand_and_service(_fulfillment(orders), lines, products, *by)


@dataclass(frozen=True)
class Report:
    """A table built from lines, orders and products, once ``clean`` has been over them.

    ``from_features`` builds the same table from a stored demand base. ``keyed``
    reports take grouping columns. ``schema`` is declared where the columns are fixed.
    """

    path_name: str
    from_tables: Callable[..., DataFrame]
    from_features: Transform | None = None
    clean: Callable[..., tuple[DataFrame, DataFrame, DataFrame]] = plans.cleaned
    in_order: Transform = lambda df: df
    keyed: bool = False
    schema: StructType | None = None
    #: The inputs that the report by these columns reads.
    reads: Callable[[tuple[str, ...]], tuple[str, ...]] = lambda by: INPUTS


def _by_revenue(df: DataFrame) -> DataFrame:
    ties = [c for c in df.columns if not c.startswith(("total_", "avg_"))]
    return ordering.highest_first(df, "total_revenue", *ties)


def _by_month(df: DataFrame) -> DataFrame:
    return ordering.by_month(df, "monthly_revenue", "product_id", "product_name")


REPORTS: Mapping[str, Report] = {
    "supply_chain_pipeline": Report(
        "output",
        plans.product_revenue,
        demand.product_revenue,
        clean=plans.cleaned_lines,
        in_order=_by_revenue,
        schema=schemas.PRODUCT_REVENUE,
    ),
    "product_demand_base": Report(
        "product_demand_base", _features, lambda df: df, schema=schemas.DEMAND_FEATURES
    ),
    "product_demand_summary": Report(
        "product_demand_summary",
        plans.product_demand_summary,
        demand.product_demand_summary,
        in_order=_by_revenue,
        schema=schemas.PRODUCT_DEMAND_SUMMARY,
    ),
    "product_demand_monthly": Report(
        "product_demand_monthly",
        plans.product_demand_monthly,
        demand.product_demand_monthly,
        in_order=_by_month,
        schema=schemas.PRODUCT_DEMAND_MONTHLY,
    ),
    "daily_product_demand": Report(
        "daily_product_demand", plans.daily_product_demand, demand.daily_product_demand
    ),
    "category_demand_monthly": Report(
        "category_demand_monthly",
        plans.category_demand_monthly,
        lambda features: trends.demand_growth(
            demand.category_demand_monthly(features), series=("category_id",)
        ),
    ),
    "demand_summary": Report(
        "demand_summary", plans.demand_by, demand.demand_by, in_order=_by_revenue, keyed=True
    ),
    "service_kpis": Report(
        "service_kpis", _service_kpis, keyed=True,
        reads=lambda by: ("order_details", "orders") if by == ("product_id",) else ("orders",),
    ),
    "demand_and_service": Report("demand_and_service", _demand_and_service, keyed=True),
}


@dataclass(frozen=True)
class ReportJob:
    """Clean the three inputs, or read a stored demand base, and write one report.

    ``ordered`` sorts the stored table too; otherwise only the preview is sorted.
    ``lenient`` also stores, beside the report, how many values became null.
    """

    report: str
    sources: Mapping[str, Source]
    sink: Sink
    base: Source | None = None
    by: tuple[str, ...] = ()
    preview_rows: int = 20
    ordered: bool = False
    lenient: bool = False

    def check(self) -> None:
        if self.report not in REPORTS:
            raise ValueError(f"no report {self.report!r}; known: {', '.join(REPORTS)}")
        if self.by and not REPORTS[self.report].keyed:
            raise ValueError(f"{self.report} takes no grouping columns")
        if self.base is not None and REPORTS[self.report].from_features is None:
            raise ValueError(f"{self.report} cannot be built from a demand base")
        if self.preview_rows < 0:
            raise ValueError("the number of preview rows cannot be negative")
        if self.lenient and self.base is not None:
            raise ValueError("lenient casts apply to the three inputs, not to a stored base")
        if self.base is not None:
            self.base.check()
        else:
            absent = [name for name in INPUTS if name not in self.sources]
            if absent:
                raise ValueError(f"no source for {', '.join(absent)}")
            for source in self.sources.values():
                source.check()
        self.sink.check()
        sinks = [self.sink]
        if self.lenient and self.sink.path:
            sinks.append(Sink(path=f"{self.sink.path}_cast_losses"))
        _refuse_overwrites([self.base] if self.base else self.sources.values(), sinks)

    def build(
        self, spark: SparkSession, losses: Mapping[str, Observation] | None = None
    ) -> DataFrame:
        """The report, lazily. With ``losses`` the run that reads an input also counts, in the
        observation of its name, what lenient casts lose of it."""
        report = REPORTS[self.report]
        if self.base is not None:
            result = report.from_features(self.base.load(spark), *self.by)
        else:
            raw = {name: self.sources[name].load(spark) for name in INPUTS}
            for name, observation in (losses or {}).items():
                counted = quality.loss_counts(EXPECTED[name])
                raw[name] = named_as(raw[name], EXPECTED[name]).observe(observation, *counted)
            tables = report.clean(*raw.values(), lenient=self.lenient)
            result = report.from_tables(*tables, *self.by)
        return report.in_order(result) if self.ordered else result

    def run(self, spark: SparkSession) -> DataFrame:
        self.check()
        read = REPORTS[self.report].reads(self.by) if self.lenient else ()
        losses = {name: Observation(f"losses of {name}") for name in read}
        stored = self.sink.save(self.build(spark, losses))
        show(REPORTS[self.report].in_order(stored), self.preview_rows)
        if self.lenient:
            self._save_losses(spark, losses)
        return stored

    def _save_losses(self, spark: SparkSession, losses: Mapping[str, Observation]) -> None:
        """Store and show how many values of each input column lenient casts made null.

        They were counted while the report was made. An input that the report does not read, or
        whose rows Spark found it need not read (they would join nothing), is scanned for it.
        """
        tables = []
        for name in INPUTS:
            counts = _observed(losses[name]) if name in losses else None
            if counts is None:
                source = named_as(self.sources[name].load(spark), EXPECTED[name])
                lost = quality.cast_losses(source, EXPECTED[name])
            else:
                schema = ", ".join(f"{column} bigint" for column in counts)
                totals = spark.createDataFrame([tuple(counts.values())], schema)
                lost = quality.loss_rows(totals, EXPECTED[name])
            tables.append(lost.select(F.lit(name).alias("table_name"), "*"))
        result = reduce(DataFrame.unionByName, tables)
        if self.sink.path:
            result = Sink(path=f"{self.sink.path}_cast_losses").save(result)
        show(result.orderBy("table_name", "column_name"), sum(len(x) for x in EXPECTED.values()))


def _observed(observation: Observation) -> dict[str, int] | None:
    """What a finished run observed; None if its rows were passed by. Spark then gives an empty row,
    which has no form in Python."""
    try:
        return observation.get
    except Py4JError:
        return None


@dataclass(frozen=True)
class TransformJob:
    """Apply a caller's function to one source and write the result."""

    source: Source
    transform: Transform
    sink: Sink
    preview_rows: int = 20
    order_by_number: str | None = None

    def check(self) -> None:
        self.source.check()
        self.sink.check()
        _refuse_overwrites([self.source], [self.sink])
        if not callable(self.transform):
            raise ValueError("the transform must be a function from DataFrame to DataFrame")

    def run(self, spark: SparkSession) -> DataFrame:
        self.check()
        stored = self.sink.save(self.transform(self.source.load(spark)))
        shown = stored
        if self.order_by_number:
            shown = ordering.by_number(stored, self.order_by_number)
        show(shown, self.preview_rows)
        return stored


@dataclass(frozen=True)
class ChartsJob:
    """Write the chart datasets of a stored monthly table, one folder each."""

    DATASETS: ClassVar = (
        "monthly_trend", "monthly_revenue_histogram", "monthly_demand_histogram", "monthly_revenue_vs_demand",
    )

    monthly: Source
    folder: str
    top_n: int = 10
    category_id: int | None = None
    bins: int = 30

    def check(self) -> None:
        self.monthly.check()
        if not self.folder:
            raise ValueError("give an output folder for the chart datasets")
        if self.top_n < 1 or self.bins < 1:
            raise ValueError("top-n and bins start at 1")
        _refuse_overwrites([self.monthly], (Sink(path=f"{self.folder}/{x}") for x in self.DATASETS))

    def run(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The frame is stored first; the other datasets are made from it."""
        self.check()
        frame = charts.chart_frame(self.monthly.load(spark), self.top_n, self.category_id)
        trend = Sink(path=f"{self.folder}/monthly_trend").save(frame)
        datasets = {
            "monthly_revenue_histogram": charts.histogram(trend, "monthly_revenue", self.bins),
            "monthly_demand_histogram": charts.histogram(trend, "monthly_demand_units", self.bins),
            "monthly_revenue_vs_demand": charts.revenue_vs_demand(trend),
        }
        stored = {
            name: Sink(path=f"{self.folder}/{name}").save(df) for name, df in datasets.items()
        }
        return {"monthly_trend": trend, **stored}


@dataclass(frozen=True)
class Analysis:
    """A table made from the monthly table, and the order in which it is shown.

    ``narrows``: whether it may follow the top products alone. A ranking or a share is of all.
    """

    build: Callable[[DataFrame, int], DataFrame]
    in_order: Transform
    narrows: bool = False


def _highest(measure: str) -> Transform:
    return lambda df: ordering.highest_first(df, measure, "product_id", "product_name")


ANALYSES: Mapping[str, Analysis] = {
    "top_products_by_revenue": Analysis(trends.top_products, _highest("total_revenue")),
    "top_products_by_units": Analysis(trends.top_products_by_units, _highest("total_demand_units")),
    "category_share": Analysis(
        lambda monthly, n: trends.category_share(monthly),
        lambda df: ordering.by_month(df, "product_month_revenue", "category_id", "product_id"),
    ),
    "demand_growth": Analysis(
        lambda monthly, n: trends.demand_growth(monthly),
        lambda df: ordering.by_series(df, "product_name", "product_id", "category_id"),
        narrows=True,
    ),
    "period_summary": Analysis(
        lambda monthly, n: trends.period_summary(monthly),
        _highest("total_demand_units"),
        narrows=True,
    ),
}


@dataclass(frozen=True)
class AnalysisJob:
    """Write one analysis of a stored monthly table.

    The category narrows the table first, then ``focus_top`` to the products with most
    units. A product is chosen from the result, because a share is of the whole
    category; it goes before ``focus_top``. The preview is sorted, the stored table is not.
    """

    analysis: str
    monthly: Source
    sink: Sink
    category_id: int | None = None
    product_id: int | None = None
    top_n: int = 10
    preview_rows: int = 20
    focus_top: int | None = None

    def check(self) -> None:
        if self.analysis not in ANALYSES:
            raise ValueError(f"no analysis {self.analysis!r}; known: {', '.join(ANALYSES)}")
        if self.top_n < 1 or (self.focus_top is not None and self.focus_top < 1):
            raise ValueError("top-n and focus-top start at 1")
        if self.focus_top is not None and not ANALYSES[self.analysis].narrows:
            raise ValueError(f"{self.analysis} is of all products and takes no focus-top")
        self.monthly.check()
        self.sink.check()
        _refuse_overwrites([self.monthly], [self.sink])

    def run(self, spark: SparkSession) -> DataFrame:
        self.check()
        analysis = ANALYSES[self.analysis]
        focus_top = self.focus_top if self.product_id is None else None
        monthly = trends.focus(self.monthly.load(spark), self.category_id, top_n=focus_top)
        result = analysis.build(monthly, self.top_n)
        stored = self.sink.save(trends.select_products(result, product_id=self.product_id))
        show(analysis.in_order(stored), self.preview_rows)
        return stored


@dataclass(frozen=True)
class QualityJob:
    """Write the quality reports of the three raw inputs, one folder each."""

    sources: Mapping[str, Source]
    folder: str
    null_threshold: float = 0.0
    preview_rows: int = 20

    def check(self) -> None:
        if not self.folder:
            raise ValueError("give an output folder for the quality reports")
        for name in INPUTS:
            if name not in self.sources:
                raise ValueError(f"no source for {name}")
            self.sources[name].check()
        reports = ("integrity", *(f"{name}_{x}" for name in INPUTS for x in ("schema", "nulls")))
        _refuse_overwrites(self.sources.values(), (Sink(path=f"{self.folder}/{x}") for x in reports))

    def run(self, spark: SparkSession) -> dict[str, DataFrame]:
        self.check()
        tables = {name: self.sources[name].load(spark) for name in INPUTS}
        reports = {"integrity": quality.integrity_report(*tables.values())}
        for name, table in tables.items():
            reports[f"{name}_schema"] = quality.schema_report(table, EXPECTED[name])
            reports[f"{name}_nulls"] = quality.null_report(table, default=self.null_threshold)
        stored = {
            name: Sink(path=f"{self.folder}/{name}").save(report)
            for name, report in reports.items()
        }
        for report in stored.values():
            show(report, self.preview_rows)
        return stored


@dataclass(frozen=True)
class ProbeJob:
    """Show a few rows of a source and count it."""

    source: Source
    preview_rows: int = 5

    def check(self) -> None:
        self.source.check()

    def run(self, spark: SparkSession) -> int:
        self.check()
        show(self.source.load(spark), self.preview_rows)
        count = self.source.count(spark)
        print(f"row count = {count}")
        return count


def show(df: DataFrame, rows: int) -> None:
    """Print the first rows in full; zero prints nothing."""
    if rows:
        ordering.preview(df, rows).show(rows, truncate=False)


def configured_sources(
    settings: Settings,
    connection: Connection,
    splits: Mapping[str, readers.Split] | None = None,
) -> dict[str, Source]:
    """The three input tables as the configuration names them."""
    return {
        name: Source(connection, settings.table(name), split=(splits or {}).get(name))
        for name in INPUTS
    }


def even_split(partitions: int) -> dict[str, readers.Split]:
    """Read each input over ``partitions`` connections, by ranges of its key."""
    keys = dict(zip(INPUTS, ("order_id", "order_id", "product_id"), strict=True))
    if partitions <= 1:
        return {}
    return {name: readers.Split(key, partitions) for name, key in keys.items()}


def folder_sources(folder: str) -> dict[str, Source]:
    """The three input tables as files ``<folder>/<table>.parquet``."""
    return {name: Source(path=f"{folder}/{name}.parquet") for name in INPUTS}
