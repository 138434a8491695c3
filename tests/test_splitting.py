"""Ranges of a skewed key, against a stand-in that answers the questions from rows held here."""

import random

import duckdb
import pyarrow as pa
import pytest
from ordertide.sources import readers, splitting
from ordertide.sources.settings import Connection

DB = Connection("jdbc:postgresql://db:5432/shop", "ann", "hidden")


class Database:
    """Stands in for a session: answers bounds and counts, and notes how the table itself is read."""

    def __init__(self, keys, kind="BIGINT"):
        self.con = duckdb.connect()
        self.con.execute(f"CREATE TABLE orders (order_id {kind}, n INTEGER)")
        held = pa.table({"k": pa.array(keys, pa.float64() if kind == "DOUBLE" else pa.int64()), "n": range(len(keys))})
        self.con.register("held", held)
        self.con.execute("INSERT INTO orders SELECT k, n FROM held")
        self.asked, self.scans, self.read = [], [], self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options["dbtable"])
        return self

    def load(self):
        if not self.asked[-1].startswith("("):
            self.scans.append(self.asked.pop())
        return self

    def collect(self):
        return self.con.sql(f"SELECT * FROM {self.asked[-1]}").fetchall()

    def jdbc(self, url, table, predicates, properties):
        assert (url, properties["user"], properties["fetchsize"]) == (DB.url, "ann", "10000")
        self.scans.append(predicates)
        return self

    def rows_of(self, condition):
        return [n for (n,) in self.con.sql(f"SELECT n FROM orders WHERE ({condition})").fetchall()]


def split(keys, partitions=8, kind="BIGINT"):
    """The rows of each range, after each row was found in one."""
    spark = Database(keys, kind)
    readers.read_jdbc(spark, DB, "orders", readers.Split("order_id", partitions))
    (ranges,) = spark.scans
    parts = [spark.rows_of(x) for x in ranges]
    assert sorted(n for part in parts for n in part) == list(range(len(keys)))
    assert len(ranges) <= partitions
    return [len(x) for x in parts], spark


rng = random.Random(0)
SKEWED = {
    "even": list(range(4000)),
    "a far outlier": [*range(4000), 10**15],
    "crowded at the low end": [int(1.008**i) for i in range(4000)],
    "two clusters": [rng.randrange(1000) for _ in range(3000)] + [10**12 + rng.randrange(10) for _ in range(1000)],
    "negative": [-(x**3) for x in range(4000)],
    "whole range": [rng.randrange(-(2**62), 2**62) for _ in range(2000)] + list(range(2000)),
}


@pytest.mark.parametrize("name", SKEWED)
def test_ranges_hold_about_equally_many_rows(name):
    sizes, spark = split(SKEWED[name])
    assert len(sizes) == 8 and max(sizes) < 2 * len(SKEWED[name]) / 8
    assert len(spark.asked) <= 2 + splitting.LEVELS


def test_questions_and_answers_stay_small():
    keys = SKEWED["whole range"]
    spark = Database(keys)
    answers = []
    real = spark.collect
    spark.collect = lambda: answers.append(real()) or answers[-1]
    readers.read_jdbc(spark, DB, "orders", readers.Split("order_id", 8))
    assert max(map(len, answers)) <= 8 * 2 * splitting.BINS * 2
    assert all(x.startswith("(SELECT") and "GROUP BY" in x or "MIN(" in x for x in spark.asked)


def test_one_hot_key_is_a_range_by_itself_and_null_keys_are_read():
    keys = [7] * 3000 + list(range(1000)) + [None] * 50
    sizes, _ = split(keys)
    assert 3000 < max(sizes) < 3500


def test_few_rows_and_few_keys():
    assert split([5] * 10)[0] == [10]
    assert split([1, 2, 3])[0] == [1, 1, 1]
    assert sum(split([None, 1])[0]) == 2
    sizes, _ = split([x / 7 for x in range(2000)], kind="DOUBLE")
    assert len(sizes) == 8 and max(sizes) < 500


def test_empty_tables_and_other_kinds_of_keys():
    for keys, kind in (([], "BIGINT"), ([None], "BIGINT")):
        spark = Database(keys, kind)
        readers.read_jdbc(spark, DB, "orders", readers.Split("order_id", 8))
        assert spark.scans == ["orders"]
    assert splitting.balanced(lambda query: [], "orders", "day", "2020-01-01", "2021-01-01", 4) is None
    assert splitting.balanced(lambda query: [], "orders", "order_id", -(1 << 63), (1 << 63) - 1, 4) is None


def test_given_bounds_make_equal_ranges_without_a_question():
    spark = Database([1, 2, 3])
    readers.read_jdbc(spark, DB, "orders", readers.Split("order_id", 8, "1", "900"))
    assert (spark.asked, spark.scans) == ([], ["orders"])
