"""Sinks replace what is there once the new rows are complete, and not before."""

import duckdb
import pytest
from conftest import rows
from ordertide.sources import folders, readers, writers
from ordertide.sources.settings import Connection
from pyspark.sql import functions as F

DB = Connection("jdbc:postgresql://db:5432/shop", "ann", "hidden")


def fail(x):
    raise RuntimeError(f"lost task {x}")


@pytest.fixture
def stored(spark, tmp_path):
    path = f"{tmp_path}/out"
    writers.write_parquet(spark.range(5), path)
    return path


def listed(folder):
    return sorted(x.name for x in folder.iterdir() if not x.name.startswith("."))


def test_a_write_replaces_and_leaves_nothing_aside(spark, stored, tmp_path):
    writers.write_parquet(spark.range(3).withColumn("k", F.col("id") % 2), stored, ["k"])
    assert rows(spark.read.parquet(stored)) == [(0, 0), (1, 1), (2, 0)]
    assert listed(tmp_path) == ["out"] and listed(tmp_path / "out")[-2:] == ["k=0", "k=1"]


def test_a_job_that_fails_half_way_leaves_the_old_rows(spark, stored, tmp_path):
    broken = spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("y"))
    with pytest.raises(Exception, match="lost"):
        writers.write_parquet(broken, stored)
    assert spark.read.parquet(stored).count() == 5
    assert listed(tmp_path) == ["out"]


def test_a_frame_may_replace_the_folder_it_reads(spark, stored):
    writers.write_parquet(spark.read.parquet(stored).where("id > 2"), stored)
    assert rows(spark.read.parquet(stored)) == [(3,), (4,)]


def test_a_swap_that_fails_puts_the_old_rows_back(spark, stored, tmp_path, monkeypatch):
    real, moves = folders.Folder._move, []

    def second_fails(self, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise OSError("store is away")
        real(self, source, target)

    monkeypatch.setattr(folders.Folder, "_move", second_fails)
    with pytest.raises(OSError, match="store is away"):
        writers.write_parquet(spark.range(9), stored)
    assert spark.read.parquet(stored).count() == 5 and listed(tmp_path) == ["out"]


def test_a_session_that_ended_within_the_swap_is_made_good(spark, stored, tmp_path):
    (tmp_path / "out").rename(tmp_path / "_out-old-1")
    assert readers.read_parquet(spark, stored).count() == 5
    (tmp_path / "out").rename(tmp_path / "_out-old-2")
    writers.write_parquet(spark.range(2), stored)
    assert spark.read.parquet(stored).count() == 2 and listed(tmp_path) == ["out"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_parquet(spark, f"{tmp_path}/never")


class Loader:
    """Stands in for a frame, its writer and the database; each load may go wrong in its own way."""

    def __init__(self, monkeypatch, loads=("all",), broken_statement=None):
        self.loads, self.told, self.broken = list(loads), [], broken_statement
        self.write = self.sparkSession = self
        self.con = duckdb.connect()
        self.con.execute("CREATE SCHEMA mart; CREATE TABLE mart.out AS SELECT 'old' AS x FROM range(3)")
        self.get = {"rows": 10}
        monkeypatch.setattr(writers, "Observation", lambda name: self)
        monkeypatch.setattr(writers, "execute", self.execute)
        monkeypatch.setattr(writers, "count_jdbc", lambda spark, db, table: self.con.sql(f"SELECT COUNT(*) FROM {table}").fetchall()[0][0])

    def repartition(self, n):
        self.told.append(f"repartition {n}")
        return self

    def observe(self, observation, *columns):
        return self

    def mode(self, name):
        self.told.append(name)
        return self

    def format(self, name):
        return self

    def options(self, **options):
        self.options_given = options
        return self

    def save(self):
        how, table = self.loads.pop(0), self.options_given["dbtable"]
        self.told.append("load")
        self.con.execute(f"CREATE TABLE {table} AS SELECT 'new' AS x FROM range({dict(all=10, twice=14, none=0, lost=4)[how]})")
        if how == "lost":
            raise RuntimeError("lost executor")

    def execute(self, spark, connection, statements):
        self.con.execute("BEGIN")
        try:
            for text in statements:
                self.told.append(" ".join(text.split()[:2]))
                if text.startswith(self.broken or "-"):
                    raise RuntimeError("refused")
                self.con.execute(text)
            self.con.execute("COMMIT")
        except BaseException:
            self.con.execute("ROLLBACK")
            raise

    def held(self):
        return self.con.sql("SELECT x, COUNT(*) FROM mart.out GROUP BY x").fetchall(), [x for (x,) in self.con.sql("SELECT table_name FROM information_schema.tables").fetchall()]


def test_a_database_table_is_loaded_aside_and_swapped(monkeypatch):
    db = Loader(monkeypatch)
    writers.write_jdbc(db, DB, "mart.out", connections=4)
    assert db.told == ["repartition 4", "errorifexists", "load", "DROP TABLE", "ALTER TABLE"]
    assert db.held() == ([("new", 10)], ["out"])
    assert db.options_given["numPartitions"] == "4" and db.options_given["dbtable"].startswith("mart.out_load_")


def test_without_a_bound_the_partitions_stay(monkeypatch):
    db = Loader(monkeypatch)
    writers.write_jdbc(db, DB, "mart.out", connections=None)
    assert db.told[0] == "errorifexists" and "numPartitions" not in db.options_given


def test_a_failed_load_leaves_the_old_table(monkeypatch):
    db = Loader(monkeypatch, ["lost"])
    with pytest.raises(RuntimeError, match="lost executor"):
        writers.write_jdbc(db, DB, "mart.out")
    assert db.held() == ([("old", 3)], ["out"])


def test_a_load_with_repeated_rows_is_made_anew(monkeypatch):
    db = Loader(monkeypatch, ["twice", "all"])
    writers.write_jdbc(db, DB, "mart.out")
    assert db.held() == ([("new", 10)], ["out"]) and db.told.count("load") == 2


@pytest.mark.parametrize("how", ["twice", "none"])
def test_rows_that_do_not_agree_are_never_swapped_in(monkeypatch, how):
    db = Loader(monkeypatch, [how] * writers.LOADS)
    with pytest.raises(RuntimeError, match="the old table stays"):
        writers.write_jdbc(db, DB, "mart.out")
    assert db.held() == ([("old", 3)], ["out"])


def test_a_swap_that_is_refused_is_taken_back(monkeypatch):
    db = Loader(monkeypatch, broken_statement="ALTER")
    with pytest.raises(RuntimeError, match="refused"):
        writers.write_jdbc(db, DB, "mart.out")
    assert db.held() == ([("old", 3)], ["out"])


def test_names_of_loads_and_statements_of_databases():
    assert writers.renamed("public.out", "_x") == "public.out_x"
    assert writers.renamed('"my schema"."my out"', "_x") == '"my schema"."my out_x"'
    assert [writers.last_part(x) for x in ("out", "a.b.out", '"a"."b.c"', "[a].[b]", "`a`.`b`")] == ["out", "out", '"b.c"', "[b]", "`b`"]
    assert writers.swap_statements("mysql", "t", "l", "o")[1] == "RENAME TABLE t TO o, l TO t"
    assert writers.swap_statements("sqlserver", "dbo.[t]", "dbo.[l]", "o")[1] == "EXEC sp_rename 'dbo.[l]', 't'"
    assert writers.swap_statements("postgresql", "p.t", "p.l", "o") == ["DROP TABLE IF EXISTS p.t", "ALTER TABLE p.l RENAME TO t"]
