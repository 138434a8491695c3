import datetime as dt

import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F
from ordertide import schemas
from ordertide.sources import readers, settings, staging, writers
from ordertide.sources.settings import Connection

DB = Connection("jdbc:postgresql://db:5432/shop", "ann", "hidden")


class Recorder:
    """Stands in for a session, a reader or a writer and notes what it is told."""

    def __init__(self, first=None):
        self.calls, self.answer = [], first
        self.read = self.write = self

    def format(self, name):
        self.calls.append({"format": name})
        return self

    def options(self, **options):
        self.calls[-1].update(options)
        return self

    def mode(self, name):
        self.calls.append({"mode": name})
        return self

    def load(self):
        return self

    def repartition(self, partitions):
        self.calls.append({"repartition": partitions})
        return self

    def save(self):
        self.calls[-1]["saved"] = True

    def first(self):
        return self.answer

    def collect(self):
        return [self.answer]


def test_settings_file_has_all_sections_and_tables():
    found = settings.load_settings(ROOT / "configs/base.yaml")
    assert found.spark and found.database and found.tables and found.paths
    assert len(found.tables) == 15
    assert found.table("orders") == "public.orders"
    with pytest.raises(ValueError, match="no table 'nope'"):
        found.table("nope")
    with pytest.raises(ValueError, match="no path 'nope'"):
        found.path("nope")
    assert found.path("output", "elsewhere") == "elsewhere"


def test_settings_accept_full_table_names_and_report_absent_sections(tmp_path):
    file = tmp_path / "c.yaml"
    file.write_text("spark: {}\ndatabase: {host: h, port: 1, db: d, user: u}\ntables: {orders: mart.o}\npaths: {}\n")
    found = settings.load_settings(file)
    assert found.table("orders") == "mart.o"
    assert found.connection("pw").url == "jdbc:postgresql://h:1/d"
    file.write_text("spark: {}\n")
    with pytest.raises(ValueError, match="lacks the section database, tables, paths"):
        settings.load_settings(file)


def test_an_argument_beats_the_environment(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "env value")
    monkeypatch.setenv("OTHER", "second value")
    assert settings.setting("given value", "DB_PASSWORD") == "given value"
    assert settings.setting(None, "DB_PASSWORD") == "env value"
    assert settings.setting("", "OTHER") == "second value"
    assert settings.setting(None, None) is None
    base = settings.load_settings(ROOT / "configs/base.yaml")
    assert base.connection().password == "env value"
    assert base.connection(password_env="OTHER").password == "second value"
    assert base.connection("given value").password == "given value"


def test_a_missing_password_is_reported_early(monkeypatch):
    monkeypatch.delenv("DB_PASSWORD", raising=False)
    with pytest.raises(ValueError, match="password not found: pass --db-password or set DB_PASSWORD"):
        settings.load_settings(ROOT / "configs/base.yaml").connection()


def test_passwords_stay_out_of_text():
    assert "hidden" not in repr(DB)


def test_names_and_paths():
    assert settings.qualified("lines") == "public.lines"
    assert settings.qualified("sales.lines") == "sales.lines"
    assert settings.optional_path(None) is None
    assert settings.optional_path(ROOT / "jars/db.jar").endswith("jars/db.jar")


def test_jdbc_scan_without_split():
    spark = Recorder()
    readers.read_jdbc(spark, DB, "public.orders")
    assert spark.calls == [
        {
            "format": "jdbc",
            "url": DB.url,
            "driver": "org.postgresql.Driver",
            "user": "ann",
            "password": "hidden",
            "dbtable": "public.orders",
            "fetchsize": "10000",
        }
    ]


def test_jdbc_scan_asks_for_bounds_and_splits():
    spark = Recorder(first=(dt.date(2020, 1, 1), dt.date(2024, 1, 1)))
    readers.read_jdbc(spark, DB, "public.orders", readers.Split("order_id", 8))
    bounds, scan = spark.calls
    assert bounds["dbtable"] == (
        "(SELECT MIN(order_id) AS low, MAX(order_id) AS high FROM public.orders) bounds"
    )
    assert {k: scan[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "order_id", "lowerBound": "2020-01-01", "upperBound": "2024-01-01", "numPartitions": "8",
    }


def test_jdbc_scan_of_an_empty_table_is_not_split():
    spark = Recorder(first=(None, None))
    readers.read_jdbc(spark, DB, "public.orders", readers.Split("order_id", 8))
    assert "partitionColumn" not in spark.calls[-1]
    with pytest.raises(ValueError, match="no bounds"):
        readers.scan_options(DB, "t", readers.Split("order_id", 8))


def test_a_database_counts_its_own_rows():
    spark = Recorder(first=(41,))
    assert readers.count_jdbc(spark, DB, "public.orders") == 41
    assert [c["dbtable"] for c in spark.calls] == ["(SELECT COUNT(*) AS row_count FROM public.orders) counted"]


def test_csv_is_text_unless_typed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,note\n01,x\n2,\n")
    path = str(tmp_path / "a.csv")
    text = readers.read_csv(spark, path)
    assert dict(text.dtypes) == {"order_id": "string", "note": "string"}
    assert rows(text) == [("01", "x"), ("2", None)]
    typed = readers.read_csv(spark, path, schemas._schema(order_id=schemas.KEY, note=schemas.TEXT))
    assert rows(typed) == [(1, "x"), (2, None)]


def test_parquet_overwrite_and_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10).withColumn("order_year", (F.col("id") % 2 + 1997).cast("int"))
    writers.write_parquet(df.limit(1), path)
    writers.write_parquet(df, path, ["order_year"])
    stored = readers.read_parquet(spark, path)
    assert stored.count() == 10
    assert {p.name for p in (tmp_path / "out").glob("order_year=*")} == {"order_year=1997", "order_year=1998"}
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "out").glob("order_year=*"))


def test_bucketed_tables_join_and_deduplicate_without_a_shuffle(spark):
    from ordertide.operators import cleaning

    lines = spark.createDataFrame([(1, 10, 2.0, 3, 0.0)], schemas.ORDER_DETAILS)
    orders = spark.createDataFrame([(1, "a", 1, None)], schemas.ORDERS)
    writers.write_bucketed(lines, "lines_bucketed", ["order_id"], 4)
    writers.write_bucketed(orders, "orders_bucketed", ["order_id"], 4)
    joined = cleaning.clean_order_details(spark.table("lines_bucketed")).join(
        spark.table("orders_bucketed").hint("merge"), "order_id"
    )
    assert joined.count() == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_staged_tables_live_in_the_shared_folder(spark):
    stored = staging.staged(spark.range(3), "numbers")
    assert stored.count() == 3
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in stored.inputFiles())


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf(dict):
        def get(self, name, default=None):
            return super().get(name, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())
