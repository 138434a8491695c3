"""What the physical plans must look like for the work to scale."""

import re

import __spark_entry__ as entry
import pytest
from conftest import SMALL
from ordertide.operators import cleaning, trends
from ordertide.plans import demand as plans
from ordertide.sources import retail, staging
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def tables(spark):
    return entry._tables(spark, SMALL)


def shuffles(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def keys(plan):
    return [re.sub(r"#\d+L?", "", s) for s in shuffles(plan)]


@pytest.mark.parametrize("name", list(entry._own_queries()))
def test_no_query_crosses_or_leaves_the_jvm(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert operator not in plan


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(cleaning.clean_order_details(retail.order_details(spark, SMALL)))
    final, exchange, partial = (plan.index(s) for s in ("1, Final", "Exchange hashpartitioning", "1, Partial"))
    assert final < exchange < partial
    assert len(shuffles(plan)) == 1


def test_scans_read_the_needed_columns_only(spark):
    plan = plan_of(plans.product_demand_monthly(*tables(spark)))
    scans = dict(re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", plan))
    columns = {t: {re.sub(r"#\d+L?", "", c) for c in cols.split(",")} for cols, t in scans.items()}
    assert columns == {
        "lineitem": {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"},
        "orders": {"o_orderkey", "o_orderdate"},
        "part": {"p_partkey", "p_name", "p_brand"},
    }


def test_a_product_filter_reaches_the_scan(spark):
    plan = plan_of(entry.queries()["monthly_for_product"](spark, SMALL))
    assert "EqualTo(l_partkey,2)" in plan


def test_a_category_filter_on_a_stored_table_reaches_the_scan(spark):
    stored = staging.staged(entry._monthly(spark, SMALL), "monthly")
    assert "EqualTo(category_id,1)" in plan_of(trends.select_products(stored, category_id=1))


def test_summary_moves_lines_twice_and_then_totals(no_broadcast):
    plan = plan_of(plans.product_demand_summary(*tables(no_broadcast)))
    lines_and_totals = ["order_id, product_id", "order_id", "product_id"]
    orders_and_products = ["order_id, _spread", "order_id", "product_id"]
    assert sorted(keys(plan)) == sorted(lines_and_totals + orders_and_products)
    assert "distinct" not in plan


def test_customer_totals_reuse_the_placement_by_order(no_broadcast):
    plan = plan_of(plans.demand_by_order_attribute(*tables(no_broadcast), "customer_id"))
    lines = ["order_id, product_id", "product_id", "order_id"]
    assert sorted(keys(plan)) == sorted([*lines, "product_id", "order_id", "customer_id"])


@pytest.mark.parametrize("name", ["category_summary", "category_demand_monthly"])
def test_category_reports_total_an_order_before_it_meets_the_orders(no_broadcast, name):
    """A hot order is one row per category at the join, in a session without the force setting."""
    plan = plan_of(entry.queries()[name](no_broadcast, SMALL))
    assert "order_id, category_id" in " ".join(keys(plan))


def test_building_a_query_writes_nothing(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("a write while building")

    monkeypatch.setattr(staging, "staged", fail)
    for name in ("demand_base", "demand_features", "supplier_summary", "category_share", "top_products_trend", "revenue_histogram"):
        assert entry.queries()[name](spark, SMALL).columns


def test_top_list_is_a_bounded_top_k_and_a_semi_join(spark):
    plan = plan_of(trends.keep_top_products(entry._monthly(spark, SMALL), 10))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)


def test_share_totals_are_aggregated_not_windowed(spark):
    plan = plan_of(trends.category_share(entry._monthly(spark, SMALL)))
    assert "windowspecdefinition(order_year_month" not in plan


def test_unneeded_supplier_join_disappears(spark):
    plan = plan_of(entry.queries()["product_demand_summary"](spark, SMALL))
    assert "l_suppkey" not in plan


def test_row_counts_read_no_columns(spark):
    plan = plan_of(entry.queries()["row_counts"](spark, SMALL))
    assert "FileScan parquet [l_" not in plan


@pytest.mark.parametrize("report", ["product_revenue", "product_demand_summary", "product_demand_monthly", "daily_product_demand"])
def test_totals_are_held_in_one_hash_table(spark, report):
    """Above the join with the products nothing is grouped once more."""
    plan = getattr(plans, report)(*tables(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join")]


def test_product_rows_that_repeat_count_each(spark):
    lines = spark.createDataFrame([(1, 7, 2.0, 3, 0.5)], "order_id long, product_id long, unit_price double, quantity long, discount double")
    orders = spark.createDataFrame([(1, "2020-02-03"), (1, "2020-02-03")], "order_id long, order_date string")
    orders = orders.withColumn("order_date", orders.order_date.cast("date"))
    rows = [(7, "a", 1), (7, "a", 1), (7, None, 1), (None, "a", 1)]
    products = spark.createDataFrame(rows, "product_id long, product_name string, category_id long")
    found = plans.product_demand_monthly(lines, orders, products).collect()
    assert {tuple(r)[4:] for r in found} == {("a", 1, 12, 12.0, 1), (None, 1, 6, 6.0, 1)}
    found = plans.product_demand_summary(lines, orders, products).collect()
    assert {tuple(r)[1:] for r in found} == {("a", 1, 12, 12.0, 1, 2.0), (None, 1, 6, 6.0, 1, 2.0)}


def test_monthly_orders_of_a_category_are_counted_without_a_table_of_orders(spark):
    monthly = plans.monthly_demand_by_product_attribute(*tables(spark), "category_id")
    assert "distinct" not in monthly._jdf.queryExecution().optimizedPlan().toString()
    lines = [(1, 7, 2.0, 3, 0.5), (1, 8, 1.0, 1, 0.0), (2, 7, 1.0, 5, 0.0)]
    lines = spark.createDataFrame(lines, "order_id long, product_id long, unit_price double, quantity long, discount double")
    orders = [(1, "2020-02-03"), (1, "2020-02-04"), (1, "2020-03-01"), (2, None), (None, "2020-02-03")]
    orders = spark.createDataFrame(orders, "order_id long, order_date string").selectExpr("order_id", "date(order_date) order_date")
    products = spark.createDataFrame([(7, "a", 1), (7, "b", 1), (8, "c", 1)], "product_id long, product_name string, category_id long")
    found = plans.monthly_demand_by_product_attribute(lines, orders, products, "category_id").collect()
    assert {tuple(r)[2:] for r in found} == {("2020-02", 1, 14, 14.0, 1), ("2020-03", 1, 7, 7.0, 1), (None, 1, 10, 10.0, 1)}


@pytest.mark.parametrize("report", ["product_demand_monthly", "daily_product_demand", "product_revenue"])
def test_a_task_of_the_totals_reads_little_unless_the_session_says_otherwise(spark, report):
    read, shuffled = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh = spark.newSession()
    getattr(plans, report)(*tables(fresh))
    assert (fresh.conf.get(read), fresh.conf.get(shuffled)) == ("16MB", "16MB")
    own = spark.newSession()
    own.conf.set(shuffled, "64MB")
    getattr(plans, report)(*tables(own))
    assert (own.conf.get(read), own.conf.get(shuffled)) == ("16MB", "64MB")


@pytest.mark.parametrize("report", ["demand_growth_by_name", "monthly_in_order", "top_products_by_revenue", "top_products_by_units"])
def test_a_small_fixed_number_of_shuffle_parts_does_not_make_tasks_larger(spark, report):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    entry.queries()[report](own, SMALL)
    # Parts of the totals, each of which Spark would join with others up to 16 MB.
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4kB")
    own.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1kB")
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    totals = entry._monthly(own, SMALL)
    assert totals.select(F.spark_partition_id()).distinct().count() > 8
    fixed = spark.newSession()
    fixed.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "3")
    entry._monthly(fixed, SMALL)
    assert fixed.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "3"
