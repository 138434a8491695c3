"""Parquet and JDBC sinks. Both replace what is there, and only once the new rows are complete."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordertide.sources.folders import Folder, new_run
from ordertide.sources.identity import database
from ordertide.sources.readers import connection_options, count_jdbc
from ordertide.sources.settings import Connection

#: Loads of a database table before a sink gives up on rows that arrive twice or not at all.
LOADS = 2


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet directory, optionally one folder per key value.

    The rows are written aside, beside the path, and take its place when they are complete: a
    job that fails before leaves the old rows as they were, and readers of the path, whatever
    their tool, see the old rows or the new ones. The path is the pointer: moving it is two
    renames. Where a session ends between the two, the old rows stand aside, and the next read or
    write of the path through this library puts them back.

    With ``partition_by`` the rows are rebalanced by those columns first, so a
    folder holds a few large files, not one per task; Spark splits a key that is
    too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    folder = Folder(df.sparkSession, path)
    folder.recover()
    aside = folder.aside("new")
    try:
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(aside)
        folder.replace(aside)
    except BaseException:
        folder.remove(aside)
        raise


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Overwrite a catalog table bucketed and sorted by ``keys``.

    Order lines and orders stored in the same number of buckets of ``order_id``
    are de-duplicated, joined and counted without a shuffle of either.
    """
    first, *rest = keys
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, first, *rest)
        .sortBy(first, *rest)
        .saveAsTable(table)
    )


def sink_options(
    connection: Connection, table: str, connections: int | None = 16, batch_size: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC write. ``connections`` bounds the load on the database."""
    options = connection_options(connection) | {"dbtable": table, "batchsize": str(batch_size)}
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def renamed(table: str, suffix: str) -> str:
    """A table's name with a suffix to its last part, within its quotes if it has some."""
    return re.sub(r"([\"`\]]?)$", rf"{suffix}\1", table.rstrip(), count=1)


def last_part(table: str) -> str:
    """The table's own name, as it is quoted, without catalog and schema."""
    return re.search(r"(\"(?:[^\"]|\"\")*\"|`[^`]*`|\[[^\]]*\]|[^.]+)$", table.strip()).group(1)


def swap_statements(kind: str, table: str, load: str, old: str) -> list[str]:
    """What puts a loaded table in the place of the old one, in the database's own words.

    To be run as one transaction. Databases that end one at each such statement have a single
    statement for both renames (MySQL), or else a moment without the table (Oracle).
    """
    if kind in ("mysql", "mariadb"):
        return [
            f"CREATE TABLE IF NOT EXISTS {table} LIKE {load}",
            f"RENAME TABLE {table} TO {old}, {load} TO {table}",
            f"DROP TABLE {old}",
        ]
    if kind == "sqlserver":
        name = last_part(table).strip('[]"')
        return [f"DROP TABLE IF EXISTS {table}", f"EXEC sp_rename '{load}', '{name}'"]
    return [f"DROP TABLE IF EXISTS {table}", f"ALTER TABLE {load} RENAME TO {last_part(table)}"]


def execute(spark: SparkSession, connection: Connection, statements: Sequence[str]) -> None:
    """Run statements in the database as one transaction, over a connection of the driver's."""
    jvm = spark._jvm
    if connection.driver:
        # Makes drivers known that came with the session's jars.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(connection.driver)
    settings = jvm.java.util.Properties()
    for name in ("user", "password"):
        if (value := getattr(connection, name)) is not None:
            settings.setProperty(name, value)
    opened = jvm.java.sql.DriverManager.getConnection(connection.url, settings)
    try:
        opened.setAutoCommit(False)
        statement = opened.createStatement()
        for text in statements:
            statement.execute(text)
        opened.commit()
    except BaseException:
        opened.rollback()
        raise
    finally:
        opened.close()


def write_jdbc(
    df: DataFrame, connection: Connection, table: str, connections: int | None = 16
) -> None:
    """Replace a database table.

    The rows are loaded into a table named by the run. A task that is lost after its rows were
    committed runs again and repeats them, so the database's count is held against the rows that
    were sent, and a load that does not agree is dropped and made anew. Only then does
    the loaded table take the place of the old one, in one transaction where the database has
    such; a load that fails leaves the old table as it was. Grants and indexes of the old table go
    with it, as with any overwrite that creates the table.

    The rows are shuffled into as many partitions as there are connections. Left to
    the writer, that number would be a coalesce, and the whole last stage of the
    query would run in so few tasks.
    """
    spark = df.sparkSession
    if connections is not None:
        df = df.repartition(connections)
    for attempt in range(LOADS):
        run = new_run()
        load = renamed(table, f"_load_{run}")
        sent = Observation(f"rows sent {run}")
        try:
            options = sink_options(connection, load, connections)
            counted = df.observe(sent, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("errorifexists").format("jdbc").options(**options).save()
            rows, arrived = sent.get["rows"], count_jdbc(spark, connection, load)
            if rows == arrived:
                kind = database(connection.url).kind
                swap = swap_statements(kind, table, load, renamed(table, f"_old_{run}"))
                execute(spark, connection, swap)
                return
            if attempt + 1 == LOADS:
                raise RuntimeError(f"{rows} rows were sent to {table} and {arrived} arrived; the old table stays")
        except BaseException:
            _drop(spark, connection, load)
            raise
        _drop(spark, connection, load)


def _drop(spark: SparkSession, connection: Connection, load: str) -> None:
    """Drop a load that will not be used, if that can still be done."""
    try:
        execute(spark, connection, [f"DROP TABLE IF EXISTS {load}"])
    except Exception as error:  # the failure that brought us here matters more
        print(f"{load} is left over: {error}")
