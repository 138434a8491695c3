import random

import pytest
from conftest import rows
from ordertide.operators import cleaning

RAW = "order_id string, product_id string, unit_price string, quantity string, discount string"


def raw(spark, *lines):
    return spark.createDataFrame(list(lines), RAW)


def test_exact_copies_collapse_and_missing_measures_become_zero(spark):
    df = raw(
        spark,
        ("7", "903", "2.75", "31", "0.125"),
        ("7", "903", "2.75", "31", "0.125"),
        ("8", "55", None, None, None),
    )
    assert rows(cleaning.clean_order_details(df)) == [
        (7, 903, 2.75, 31, 0.125),
        (8, 55, 0.0, 0, 0.0),
    ]
    untyped = cleaning.clean_order_details(df, typed_keys=False)
    assert rows(untyped)[0] == ("7", "903", 2.75, 31, 0.125)
    assert [t for _, t in untyped.dtypes] == ["string", "string", "double", "int", "double"]


def test_conflicting_copies_leave_the_same_row_on_every_run(spark):
    lines = [
        ("1", "1", "10.0", "1", "0.0"),
        ("1", "1", "9.0", "4", "0.1"),
        ("1", "1", "9.0", "3", "0.2"),
        ("1", "1", None, "1", "0.0"),
    ]
    for seed in range(4):
        random.Random(seed).shuffle(lines)
        kept = cleaning.clean_order_details(raw(spark, *lines).repartition(3))
        assert rows(kept) == [(1, 1, 9.0, 3, 0.2)]


def test_a_known_value_beats_a_missing_one(spark):
    df = raw(spark, ("1", "1", None, "1", "0"), ("1", "1", "8", None, "0"))
    assert rows(cleaning.clean_order_details(df)) == [(1, 1, 8.0, 0, 0.0)]


def test_keys_are_compared_after_typing(spark):
    df = raw(spark, ("1", "7", "2", "1", "0"), ("01", "7", "2", "1", "0"))
    assert cleaning.clean_order_details(df).count() == 1
    assert cleaning.clean_order_details(df, typed_keys=False).count() == 2


def test_missing_keys_form_one_group(spark):
    df = raw(spark, (None, "7", "2", "1", "0"), (None, "7", "3", "1", "0"))
    assert rows(cleaning.clean_order_details(df)) == [(None, 7, 2.0, 1, 0.0)]


def test_malformed_text_is_an_error_unless_lenient(spark):
    df = raw(spark, ("1", "7", "x", "1", "0"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.clean_order_details(df).collect()
    assert rows(cleaning.clean_order_details(df, lenient=True)) == [(1, 7, 0.0, 1, 0.0)]


def test_nan_measures_become_zero(spark):
    df = spark.createDataFrame(
        [(1, 7, 2.0, 1, float("nan"))],
        "order_id int, product_id int, unit_price double, quantity int, discount double",
    )
    assert rows(cleaning.clean_order_details(df)) == [(1, 7, 2.0, 1, 0.0)]


def test_further_line_columns_survive_and_settle_ties(spark):
    df = spark.createDataFrame(
        [("1", "7", "2", "1", "0", "b"), ("1", "7", "2", "1", "0", "a")], RAW + ", note string"
    )
    assert rows(cleaning.clean_order_details(df)) == [(1, 7, 2.0, 1, 0.0, "a")]


def test_ids_beyond_the_int_range_are_kept(spark):
    df = raw(spark, ("6000000000", "7", "2", "1", "0"))
    assert rows(cleaning.clean_order_details(df))[0][0] == 6_000_000_000


def test_orders_are_typed(spark):
    schema = "order_id string, customer_id int, employee_id string, order_date string, note string"
    df = spark.createDataFrame([("5", 3, "2", "1997-05-09", "n"), ("6", 3, None, None, "n")], schema)
    clean = cleaning.clean_orders(df)
    assert dict(clean.dtypes) == {
        "order_id": "bigint",
        "customer_id": "string",
        "employee_id": "bigint",
        "order_date": "date",
        "note": "string",
    }
    assert [str(v) for v in rows(clean)[0][:4]] == ["5", "3", "2", "1997-05-09"]
    bad = spark.createDataFrame([("5", 3, "2", "nope", "n")], schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.clean_orders(bad).collect()
    assert cleaning.clean_orders(bad, lenient=True).first()["order_date"] is None


def test_fulfillment_dates_are_typed_when_present(spark):
    df = spark.createDataFrame(
        [("5", "c", "2", "1997-05-09", "1997-06-01", None)],
        "order_id string, customer_id string, employee_id string, order_date string, "
        "required_date string, shipped_date string",
    )
    kinds = dict(cleaning.clean_orders(df).dtypes)
    assert kinds["required_date"] == kinds["shipped_date"] == "date"


def test_products_are_typed_and_trimmed(spark):
    df = spark.createDataFrame(
        [("7", "  steel nut ", "2", "3")],
        "product_id string, product_name string, category_id string, supplier_id string",
    )
    assert rows(cleaning.clean_products(df)) == [(7, "steel nut", 2, 3)]


def test_a_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="no column unit_price"):
        cleaning.clean_order_details(spark.createDataFrame([(1, 2)], "order_id int, product_id int"))


def test_column_names_match_without_case_and_whole_numbers_may_have_a_fraction_of_zero(spark):
    upper = "ORDER_ID string, PRODUCT_ID string, UNIT_PRICE string, QUANTITY string, DISCOUNT string"
    df = spark.createDataFrame([("4", "9", "1.5", "12.0", "0"), ("4", "9", "2.5", "3.7", "x")], upper)
    found = cleaning.clean_order_details(df, lenient=True)
    assert found.columns == ["order_id", "product_id", "unit_price", "quantity", "discount"]
    assert rows(found) == [(4, 9, 1.5, 12, 0.0)]
    parts = spark.createDataFrame([("4", "9", "1.5", "3.7", "0")], upper)
    assert rows(cleaning.clean_order_details(parts, lenient=True)) == [(4, 9, 1.5, 0, 0.0)]
