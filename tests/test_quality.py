from conftest import rows
from ordertide import schemas
from ordertide.operators import quality


def test_schema_report_lists_types_absences_extras_and_bad_values(spark):
    df = spark.createDataFrame(
        [("1", "x", 2.0, "n"), ("2", "5", None, "n")],
        "order_id string, quantity string, unit_price double, note string",
    )
    report = {r.column_name: tuple(r)[1:] for r in quality.schema_report(df, schemas.ORDER_DETAILS).collect()}
    assert report == {
        "order_id": ("bigint", "string", True, False, 2, 0),
        "product_id": ("bigint", None, False, False, 2, 0),
        "unit_price": ("double", "double", True, True, 2, 0),
        "quantity": ("int", "string", True, False, 2, 1),
        "discount": ("double", None, False, False, 2, 0),
        "note": (None, "string", True, False, 2, 0),
    }


def test_null_report_counts_nan_and_applies_thresholds(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "v double, t string"
    )
    assert rows(quality.null_report(df, {"t": 0.25}, default=0.1)) == [
        ("t", 4, 1, 0.25, 0.25, True),
        ("v", 4, 2, 0.5, 0.1, False),
    ]


def test_null_report_of_an_empty_table_passes(spark):
    df = spark.createDataFrame([], "v double")
    assert rows(quality.null_report(df)) == [("v", 0, 0, 0.0, 0.0, True)]


def test_integrity_report(spark):
    lines = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (2, 10), (8, 10), (None, 10)], "order_id bigint, product_id bigint"
    )
    orders = spark.createDataFrame([(1,), (2,), (2,)], "order_id bigint")
    products = spark.createDataFrame([(10,), (12,)], "product_id bigint")
    found = {r.check_name: (r.violations, r.passed) for r in quality.integrity_report(lines, orders, products).collect()}
    assert found == {
        "duplicate_order_lines": (1, False),
        "duplicate_orders": (1, False),
        "duplicate_products": (0, True),
        "lines_without_order": (2, False),
        "lines_without_product": (1, False),
    }


def test_row_counts(spark):
    found = quality.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(found) == [("a", 3), ("b", 0)]
