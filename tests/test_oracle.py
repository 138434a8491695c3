"""Every registered query against its SQL, value by value."""

import datetime as dt
import os
import subprocess
import sys

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import ROOT, SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(found):
    def mark(value):
        if isinstance(value, dt.datetime):
            value = value.date()
        return (value is not None, repr(value))

    return sorted(tuple(mark(v) for v in row) for row in found)


def test_every_query_has_sql():
    assert set(entry._own_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry._own_queries()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    expected = con.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    kinds = dict(zip(expected.columns, (TYPES.get(str(t), str(t)) for t in expected.types)))
    assert dict(df.dtypes) == kinds
    left = comparable(tuple(r) for r in df.select(*columns).collect())
    right = comparable(expected.project(", ".join(columns)).fetchall())
    assert left == right
    assert left


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_a_missing_package_of_the_text_operators_leaves_all_other_queries(tmp_path):
    """In a Python of its own, where one of their packages cannot be imported."""
    (tmp_path / "ahocorasick.py").write_text("raise ImportError('blocked')\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), len(e._own_queries()))"
    found = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True,
        env=os.environ | {"PYTHONPATH": str(tmp_path)},
    )
    registered, with_sql, own = map(int, found.stdout.split())
    assert registered == with_sql == own
