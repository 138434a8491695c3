"""JDBC, CSV and Parquet scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from ordertide.sources import splitting
from ordertide.sources.folders import Folder
from ordertide.sources.settings import Connection


@dataclass(frozen=True)
class Split:
    """How to read one JDBC table over several connections: ranges of a numeric, date or
    timestamp column.

    Without bounds the database is asked: ranges of a number then hold about equally many
    rows, by its own counts; ranges of a date are equally long. Bounds given make equal ranges.
    """

    column: str
    partitions: int
    lower: str | None = None
    upper: str | None = None


def connection_options(connection: Connection) -> dict[str, str]:
    options = {
        "url": connection.url,
        "driver": connection.driver,
        "user": connection.user,
        "password": connection.password,
    }
    return {name: value for name, value in options.items() if value is not None}


def scan_options(
    connection: Connection, table: str, split: Split | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC scan. Filters and the column list are pushed to the database.

    The fetch size matters: some drivers otherwise fetch a whole partition at once.
    """
    options = connection_options(connection) | {"dbtable": table, "fetchsize": str(fetch_size)}
    if split is not None:
        if split.lower is None or split.upper is None:
            raise ValueError(f"no bounds for the split column {split.column}")
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"


def read_jdbc(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan a database table, in parallel when given a split."""
    if split is not None and (split.lower is None or split.upper is None):

        def ask(query: str) -> list[Row]:
            options = scan_options(connection, query)
            return spark.read.format("jdbc").options(**options).load().collect()

        low, high = ask(bounds_query(table, split.column))[0]
        if low is None:
            return read_jdbc(spark, connection, table, None, fetch_size)
        ranges = splitting.balanced(ask, table, split.column, low, high, split.partitions)
        if ranges is not None:
            options = scan_options(connection, table, None, fetch_size)
            place = {name: options.pop(name) for name in ("url", "dbtable")}
            return spark.read.jdbc(place["url"], place["dbtable"], predicates=ranges, properties=options)
        split = Split(split.column, split.partitions, str(low), str(high))
    options = scan_options(connection, table, split, fetch_size)
    return spark.read.format("jdbc").options(**options).load()


def count_query(table: str) -> str:
    return f"(SELECT COUNT(*) AS row_count FROM {table}) counted"


def count_jdbc(spark: SparkSession, connection: Connection, table: str) -> int:
    """The rows of a database table, counted by the database."""
    options = scan_options(connection, count_query(table))
    return int(spark.read.format("jdbc").options(**options).load().first()[0])


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan CSV files with a header. Without a schema every column is text; nothing
    is inferred, since that would read the data twice."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Scan Parquet files. A path that is not there may have been left half-way through a
    replacement; its old rows are then put back and read."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not Folder(spark, path).recover():
            raise
        return spark.read.parquet(path)
