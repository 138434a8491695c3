"""One key holding a third of the lines: results stay whole, and the work is split."""

import re

import pytest
from conftest import rows
from ordertide import schemas
from ordertide.operators import cleaning, demand, fulfillment, ordering, trends
from ordertide.plans import demand as plans
from ordertide.plans import jobs
from ordertide.sources import retail
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"

# Thresholds that make a third of 60,000 lines as extreme as a third of a large table.
SMALL_CLUSTER = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def skew_aware(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_CLUSTER}
    for name, value in SMALL_CLUSTER.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw lines with a hot order, a hot product, or a hot pair; orders; products."""
    folder = str(tmp_path_factory.mktemp("skew"))
    raw = retail.order_details(spark, FOLDER).repartition(8)
    hot = F.pmod(F.hash("order_id", "unit_price", "discount"), F.lit(3)) == 0
    order = F.when(hot, F.lit(5)).otherwise(F.col("order_id"))
    product = F.when(hot, F.lit(7)).otherwise(F.col("product_id"))
    own_product = F.when(hot, F.monotonically_increasing_id() + 100_000).otherwise(F.col("product_id"))
    raw.withColumns({"order_id": order, "product_id": own_product}).write.parquet(f"{folder}/order")
    raw.withColumn("product_id", product).write.parquet(f"{folder}/product")
    raw.withColumns({"order_id": order, "product_id": product}).write.parquet(f"{folder}/pair")
    cleaning.clean_orders(retail.orders(spark, FOLDER)).write.parquet(f"{folder}/orders")
    ids = spark.read.parquet(f"{folder}/order").select("product_id").distinct()
    ids.select(
        "product_id",
        F.concat(F.lit("n"), "product_id").alias("product_name"),
        (F.col("product_id") % 25).alias("category_id"),
        F.lit(1).cast("bigint").alias("supplier_id"),
    ).write.parquet(f"{folder}/products")
    return folder


def load(spark, folder, kind):
    lines = cleaning.clean_order_details(spark.read.parquet(f"{folder}/{kind}"))
    return lines, spark.read.parquet(f"{folder}/orders"), spark.read.parquet(f"{folder}/products")


def executed(df):
    found = rows(df)
    return found, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def exact(df):
    return df.select([c for c, t in df.dtypes if t != "double"])


@pytest.mark.parametrize("kind", ["order", "product", "pair"])
def test_results_are_whole_under_skew(skew_aware, stored, kind):
    tables = load(skew_aware, stored, kind)
    raw = skew_aware.read.parquet(f"{stored}/{kind}").toPandas()
    raw = raw.astype({"quantity": int}).sort_values(["unit_price", "quantity", "discount"])
    lines = raw.drop_duplicates(["order_id", "product_id"])
    orders = tables[1].toPandas()
    joined = lines.merge(orders, on="order_id")

    summary = plans.product_demand_summary(*tables)
    expected = joined.groupby("product_id").agg(u=("quantity", "sum"), n=("order_id", "nunique"))
    assert rows(summary.select("product_id", "total_demand_units", "order_count")) == sorted(
        (int(p), int(r.u), int(r.n)) for p, r in expected.iterrows()
    )
    features = demand.with_demand_features(demand.demand_base(*tables))
    assert features.count() == len(joined)
    for fused, generic in (
        (plans.product_demand_monthly(*tables), demand.product_demand_monthly(features)),
        (plans.demand_by_order_attribute(*tables, "customer_id"), demand.demand_by(features, "customer_id")),
    ):
        assert rows(exact(fused)) == rows(exact(generic))


def test_a_hot_order_is_split_in_its_join(skew_aware, stored):
    lines, orders, products = load(skew_aware, stored, "order")
    features = demand.with_demand_features(demand.demand_base(lines, orders, products))
    reports = {
        "summary": plans.product_demand_summary(lines, orders, products),
        "monthly": plans.product_demand_monthly(lines, orders, products),
        "base": features,
        "category": demand.demand_by(features, "category_id"),
    }
    split = {name: "SortMergeJoin(skew=true)" in executed(df)[1] for name, df in reports.items()}
    assert split == dict.fromkeys(reports, True)


def test_a_hot_product_is_split_or_totalled_first(skew_aware, stored):
    lines, orders, products = load(skew_aware, stored, "product")
    for df in (
        demand.demand_base(lines, orders, products),
        plans.demand_by_order_attribute(lines, orders, products, "customer_id"),
    ):
        assert "SortMergeJoin(skew=true)" in executed(df)[1]
    outcome = fulfillment.order_fulfillment(
        fulfillment.attach_shipments(orders, retail.shipments(skew_aware, FOLDER))
    )
    found, plan = executed(fulfillment.service_kpis_by_product(outcome, lines))
    assert "partial_count" in plan
    assert max(r[1] for r in found) > 10_000


def test_copies_of_one_line_shrink_before_the_shuffle(skew_aware, stored):
    lines, _, _ = load(skew_aware, stored, "pair")
    assert lines.where("order_id = 5 AND product_id = 7").count() == 1
    assert "row_number(), 1, Partial" in executed(lines)[1]


def test_schemas_match(skew_aware, stored):
    lines, _, _ = load(skew_aware, stored, "pair")
    assert [f.dataType for f in lines.schema] == [f.dataType for f in schemas.ORDER_DETAILS]


def test_a_hot_name_is_followed_over_ranges(skew_aware, stored, monkeypatch):
    """A third of the rows have one name; it fills several ranges, and growth equals the window's."""
    skew_aware.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = F.when(F.col("product_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("product_id") % 50))
    monthly = plans.product_demand_monthly(*load(skew_aware, stored, "product")).withColumn("product_name", hot)
    kept = []
    real = ordering.in_ranges
    monkeypatch.setattr(ordering, "in_ranges", lambda *a: kept.append(real(*a)) or kept[0])
    grown = trends.demand_growth(monthly, series=("product_name",)).select("order_year_month", "product_id", "demand_growth_rate")
    before = "lag(monthly_demand_units) OVER (PARTITION BY product_name ORDER BY order_year_month, product_id, category_id)"
    expected = monthly.selectExpr("order_year_month", "product_id", f"try_divide(monthly_demand_units, {before}) - 1")
    assert rows(grown) == rows(expected)
    assert kept[0].where("product_name = 'hot'").select("_range").distinct().count() > 2
    skew_aware.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    ("report", "by"),
    [("demand_summary", ("category_id",)), ("demand_summary", ("customer_id", "category_id")), ("category_demand_monthly", ())],
)
def test_jobs_total_a_hot_order_before_it_meets_the_orders(skew_aware, stored, report, by):
    """The registered plans, run as jobs: lines never meet the orders one by one."""
    sources = {
        "order_details": jobs.Source(path=f"{stored}/order"),
        "orders": jobs.Source(path=f"{stored}/orders"),
        "products": jobs.Source(path=f"{stored}/products"),
    }
    built = jobs.ReportJob(report, sources, jobs.Sink(path="o"), by=by).build(skew_aware)
    found, plan = executed(exact(built))
    levels = re.findall(r"HashAggregate\(keys=\[order_id#\d+L, category_id#\d+L\]", plan)
    assert levels, plan
    features = demand.with_demand_features(demand.demand_base(*load(skew_aware, stored, "order")))
    if by:
        assert found == rows(exact(demand.demand_by(features, *by)))
    else:
        monthly = demand.category_demand_monthly(features)
        assert [r[:6] for r in found] == rows(exact(monthly))
