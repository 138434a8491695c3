import __spark_entry__ as entry
import pytest
from conftest import ROOT, SMALL, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F
from ordertide import __main__ as cli
from ordertide.operators import quality
from ordertide.plans import jobs
from ordertide.sources import retail
from ordertide.sources.settings import Connection

DB = Connection("jdbc:postgresql://db:5432/shop", "ann", "hidden")
CONFIG = str(ROOT / "configs/base.yaml")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("inputs"))
    retail.order_details(spark, SMALL).write.parquet(f"{folder}/order_details.parquet")
    retail.orders(spark, SMALL).write.parquet(f"{folder}/orders.parquet")
    retail.products(spark, SMALL).write.parquet(f"{folder}/products.parquet")
    return folder


FIXED = [name for name, report in jobs.REPORTS.items() if report.schema is not None]


def parsed(*argv):
    return cli._parser().parse_args(list(argv))


@pytest.mark.parametrize(
    ("job", "message"),
    [
        (jobs.ReportJob("nope", {}, jobs.Sink(path="o")), "no report 'nope'"),
        (jobs.ReportJob("product_demand_base", {}, jobs.Sink(path="o")), "no source for order_details"),
        (
            jobs.ReportJob("product_demand_base", {n: jobs.Source(path="i") for n in jobs.INPUTS}, jobs.Sink()),
            "output path",
        ),
        (
            jobs.ReportJob("product_demand_base", {n: jobs.Source() for n in jobs.INPUTS}, jobs.Sink(path="o")),
            "input path",
        ),
        (jobs.TransformJob(jobs.Source(path="i"), lambda df: df, jobs.Sink(connection=DB)), "output path"),
        (jobs.TransformJob(jobs.Source(connection=DB), lambda df: df, jobs.Sink(path="o")), "input path"),
        (jobs.ChartsJob(jobs.Source(path="i"), "o", top_n=0), "start at 1"),
        (jobs.ProbeJob(jobs.Source()), "input path"),
        (
            jobs.ReportJob("product_demand_base", {}, jobs.Sink(path="o"), by=("x",)),
            "takes no grouping columns",
        ),
        (
            jobs.ReportJob("service_kpis", {}, jobs.Sink(path="o"), base=jobs.Source(path="i")),
            "cannot be built from a demand base",
        ),
        (jobs.AnalysisJob("nope", jobs.Source(path="i"), jobs.Sink(path="o")), "no analysis 'nope'"),
        (
            jobs.AnalysisJob("category_share", jobs.Source(path="i"), jobs.Sink(path="o"), focus_top=2),
            "is of all products",
        ),
        (
            jobs.AnalysisJob("period_summary", jobs.Source(path="i"), jobs.Sink(path="o"), focus_top=0),
            "start at 1",
        ),
        (jobs.QualityJob({}, "o"), "no source for order_details"),
        (jobs.ProbeJob(jobs.Source(path="i", file_format="xls")), "no file format 'xls'"),
    ],
)
def test_a_wrong_job_fails_before_spark_is_touched(job, message):
    with pytest.raises(ValueError, match=message):
        job.run(spark=None)


def test_every_report_runs_and_previews_the_stored_rows(spark, inputs, tmp_path, capsys):
    stored = {}
    for name in FIXED:
        args = parsed(name, "--config", CONFIG, "--input-folder", inputs,
                      "--output", str(tmp_path / name), "--limit", "3")
        stored[name] = cli.report_job(args).run(spark)
        assert stored[name].schema.fieldNames() == jobs.REPORTS[name].schema.fieldNames()
    assert capsys.readouterr().out.count("only showing top") == 0
    assert stored["product_demand_base"].count() == 5942

    for name in ("product_demand_summary", "product_demand_monthly", "supply_chain_pipeline"):
        args = parsed(name, "--config", CONFIG, "--base", str(tmp_path / "product_demand_base"),
                      "--output", str(tmp_path / f"{name}_again"), "--limit", "0", "--sorted")
        again = cli.report_job(args).run(spark)
        exact = [c for c, t in again.dtypes if t != "double"]
        assert rows(again.select(exact)) == rows(stored[name].select(exact))
    assert "+--" not in capsys.readouterr().out


def test_charts_job_writes_all_datasets(spark, inputs, tmp_path):
    monthly = str(tmp_path / "monthly")
    args = parsed("product_demand_monthly", "--config", CONFIG, "--input-folder", inputs,
                  "--output", monthly, "--limit", "0")
    cli.report_job(args).run(spark)
    args = parsed("charts", "--config", CONFIG, "--input", monthly,
                  "--output-dir", str(tmp_path / "charts"), "--top-n", "2")
    found = cli.charts_job(args).run(spark)
    trend = found["monthly_trend"]
    assert trend.select("product_id").distinct().count() == 2
    assert found["monthly_revenue_vs_demand"].count() == trend.count()
    for name in ("monthly_revenue_histogram", "monthly_demand_histogram"):
        assert sum(r.row_count for r in found[name].collect()) == trend.count()


@pytest.fixture(scope="module")
def shipped_inputs(spark, inputs, tmp_path_factory):
    from ordertide.operators.fulfillment import attach_shipments

    folder = str(tmp_path_factory.mktemp("shipped"))
    spark.read.parquet(f"{inputs}/order_details.parquet").write.parquet(f"{folder}/order_details.parquet")
    spark.read.parquet(f"{inputs}/products.parquet").write.parquet(f"{folder}/products.parquet")
    orders = attach_shipments(retail.orders(spark, SMALL), retail.shipments(spark, SMALL))
    orders.write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize(
    ("command", "by", "registered"),
    [
        ("daily_product_demand", [], "daily_product_demand"),
        ("category_demand_monthly", [], "category_demand_monthly"),
        ("demand_summary", ["category_id"], "category_summary"),
        ("demand_summary", ["customer_id"], "customer_summary"),
        ("demand_summary", ["customer_id", "category_id"], "customer_category_summary"),
        ("service_kpis", [], "service_kpis"),
        ("service_kpis", ["shipper"], "service_kpis_by_shipper"),
        ("service_kpis", ["product_id"], "service_kpis_by_product"),
        ("demand_and_service", ["shipper"], "shipper_summary"),
    ],
)
def test_keyed_reports_equal_the_registered_queries(
    spark, shipped_inputs, tmp_path, command, by, registered
):
    args = parsed(command, "--config", CONFIG, "--input-folder", shipped_inputs, "--limit", "0",
                  "--output", str(tmp_path / "out"), *(["--by", *by] if by else []))
    stored = cli.report_job(args).run(spark)
    expected = entry.queries()[registered](spark, SMALL)
    exact = [c for c, t in stored.dtypes if t != "double"]
    assert rows(stored.select(exact)) == rows(expected.select(exact))


def test_summary_by_an_order_and_a_product_column(spark, shipped_inputs, tmp_path):
    args = parsed("demand_summary", "--config", CONFIG, "--input-folder", shipped_inputs,
                  "--output", str(tmp_path / "out"), "--limit", "2", "--by", "shipper", "category_id")
    stored = cli.report_job(args).run(spark)
    assert stored.columns[:2] == ["shipper", "category_id"]
    assert stored.count() == 125


def test_the_growth_column_is_in_the_category_job(spark, shipped_inputs, tmp_path):
    args = parsed("category_demand_monthly", "--config", CONFIG, "--input-folder", shipped_inputs,
                  "--output", str(tmp_path / "out"), "--limit", "0")
    stored = cli.report_job(args).run(spark)
    assert stored.columns == entry.queries()["category_demand_monthly"](spark, SMALL).columns
    base = str(tmp_path / "base")
    cli.report_job(parsed("product_demand_base", "--config", CONFIG, "--input-folder", shipped_inputs,
                          "--output", base, "--limit", "0")).run(spark)
    again = cli.report_job(parsed("category_demand_monthly", "--config", CONFIG, "--base", base,
                                  "--output", str(tmp_path / "again"), "--limit", "0")).run(spark)
    exact = ["order_year_month", "category_id", "monthly_demand_units", "monthly_order_count", "demand_growth_rate"]
    assert rows(again.select(exact)) == rows(stored.select(exact))


@pytest.mark.parametrize("name", list(jobs.ANALYSES))
def test_analyses_of_a_stored_monthly_table(spark, inputs, tmp_path, name):
    monthly = str(tmp_path / "monthly")
    cli.report_job(parsed("product_demand_monthly", "--config", CONFIG, "--input-folder", inputs,
                          "--output", monthly, "--limit", "0")).run(spark)
    args = parsed(name, "--config", CONFIG, "--input", monthly, "--output", str(tmp_path / "out"),
                  "--limit", "0")
    stored = cli.analysis_job(args).run(spark)
    expected = entry.queries()[name](spark, SMALL)
    exact = [c for c, t in stored.dtypes if t != "double"]
    assert rows(stored.select(exact)) == rows(expected.select(exact))
    one = cli.analysis_job(parsed(name, "--config", CONFIG, "--input", monthly, "--limit", "0",
                                  "--output", str(tmp_path / "one"), "--product-id", "2")).run(spark)
    assert rows(one.select(exact)) == rows(stored.where("product_id = 2").select(exact))


def test_analyses_of_the_top_products_by_units(spark, inputs, tmp_path, capsys):
    monthly = str(tmp_path / "monthly")
    cli.report_job(parsed("product_demand_monthly", "--config", CONFIG, "--input-folder", inputs,
                          "--output", monthly, "--limit", "0")).run(spark)
    focused = entry.queries()["focus_top_units"](spark, SMALL)
    ids = {r.product_id for r in focused.select("product_id").distinct().collect()}
    for name in ("demand_growth", "period_summary"):
        args = parsed(name, "--config", CONFIG, "--input", monthly, "--output", str(tmp_path / name),
                      "--category-id", "1", "--focus-top", "2", "--limit", "200")
        stored = cli.analysis_job(args).run(spark)
        assert {r.product_id for r in stored.select("product_id").distinct().collect()} == ids
    assert stored.count() == 2
    shown = capsys.readouterr().out
    units = [r.total_demand_units for r in stored.collect()]
    assert shown.rindex(f"|{max(units)}") < shown.rindex(f"|{min(units)}")
    growth = spark.read.parquet(str(tmp_path / "demand_growth"))
    assert growth.count() == focused.count()


def test_lenient_reports_count_what_they_lose(spark, inputs, tmp_path, capsys):
    lines = spark.read.parquet(f"{inputs}/order_details.parquet").limit(3)
    text = lines.selectExpr("order_id AS ORDER_ID", "product_id", "unit_price", "discount",
                            "element_at(array('12.0', 'x', '3'), 1 + CAST(order_id % 3 AS INT)) AS quantity")
    text.write.parquet(str(tmp_path / "order_details.parquet"))
    sources = jobs.folder_sources(inputs) | {"order_details": jobs.Source(path=str(tmp_path / "order_details.parquet"))}
    bad = text.where("quantity = 'x'").count()
    job = jobs.ReportJob("product_demand_summary", sources, jobs.Sink(path=str(tmp_path / "out")), lenient=True)
    job.run(spark)
    found = spark.read.parquet(str(tmp_path / "out_cast_losses"))
    lost = {(r.table_name, r.column_name): (r.row_count, r.lost_values) for r in found.collect()}
    assert lost[("order_details", "quantity")] == (3, bad)
    assert sum(n for _, n in lost.values()) == bad
    assert "lost_values" in capsys.readouterr().out


def lossy(spark, inputs, folder):
    """The inputs with a third of their text spoilt, and what a scan of its own counts."""
    expected = {}
    for name in jobs.INPUTS:
        table = spark.read.parquet(f"{inputs}/{name}.parquet")
        spoilt = [F.when(F.hash(*table.columns) % 3 == 0, F.lit("x")).otherwise(F.col(c).cast("string")).alias(c) for c in table.columns]
        table.select(*spoilt).write.parquet(f"{folder}/{name}.parquet")
        lost = quality.cast_losses(spark.read.parquet(f"{folder}/{name}.parquet"), jobs.EXPECTED[name])
        expected |= {(name, r.column_name): (r.row_count, r.lost_values) for r in lost.collect()}
    return jobs.folder_sources(str(folder)), expected


@pytest.mark.parametrize(
    ("report", "by"),
    [("product_demand_monthly", ()), ("demand_summary", ("customer_id", "category_id")), ("service_kpis", ()), ("service_kpis", ("product_id",))],
)
def test_losses_are_counted_while_the_report_is_made(spark, shipped_inputs, tmp_path, report, by):
    sources, expected = lossy(spark, shipped_inputs, tmp_path / "in")
    job = jobs.ReportJob(report, sources, jobs.Sink(path=str(tmp_path / "out")), by=by, lenient=True, preview_rows=0)
    read = jobs.REPORTS[report].reads(by)
    plan = job.build(spark, {name: Observation(name) for name in read})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(read)
    for name in jobs.INPUTS:
        assert plan.count(f"CollectMetrics {name},") == (1 if name in read else 0)
    job.run(spark)
    found = spark.read.parquet(str(tmp_path / "out_cast_losses")).collect()
    assert {(r.table_name, r.column_name): (r.row_count, r.lost_values) for r in found} == expected
    assert sum(n for _, n in expected.values()) > 1000


def test_losses_of_inputs_that_a_run_passes_by(spark, inputs, tmp_path):
    sources, expected = lossy(spark, inputs, tmp_path / "in")
    spark.read.parquet(f"{tmp_path}/in/products.parquet").limit(0).write.parquet(f"{tmp_path}/none")
    sources |= {"products": jobs.Source(path=f"{tmp_path}/none")}
    job = jobs.ReportJob("product_demand_summary", sources, jobs.Sink(path=str(tmp_path / "out")), lenient=True, preview_rows=0)
    assert job.run(spark).count() == 0
    found = spark.read.parquet(str(tmp_path / "out_cast_losses")).collect()
    lost = {(r.table_name, r.column_name): (r.row_count, r.lost_values) for r in found}
    assert lost == {k: (0, 0) if k[0] == "products" else v for k, v in expected.items()}


def test_quality_job(spark, inputs, tmp_path, capsys):
    args = parsed("quality", "--config", CONFIG, "--input-folder", inputs,
                  "--output-dir", str(tmp_path / "q"), "--limit", "5")
    found = cli.quality_job(args).run(spark)
    assert len(found) == 7
    assert rows(found["integrity"].where("check_name = 'lines_without_order'")) == [
        ("lines_without_order", 0, True)
    ]
    assert found["orders_nulls"].where("NOT passed").count() == 0
    assert "duplicate_order_lines" in capsys.readouterr().out


def keep_good(df):
    return df.where("stars > 2")


def test_transform_job_from_csv(spark, tmp_path, capsys):
    source = tmp_path / "in.csv"
    source.write_text("review_id,stars\n10,5\n9,4\n8,1\n")
    args = parsed("transform", "--function", "test_jobs:keep_good", "--input", str(source),
                  "--output", str(tmp_path / "out"), "--order-by", "review_id")
    cli.transform_job(args).run(spark)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("10", "5"), ("9", "4")]
    shown = capsys.readouterr().out
    assert shown.index("|9 ") < shown.index("|10 ")


def test_probe_counts(spark, inputs, capsys):
    job = jobs.ProbeJob(jobs.Source(path=f"{inputs}/products.parquet"), preview_rows=2)
    assert job.run(spark) == 200
    assert "row count = 200" in capsys.readouterr().out


def test_transform_of_a_table_names_its_split(monkeypatch):
    for name in ("JDBC_URL", "DB_USER", "DB_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    argv = ("transform", "--function", "test_jobs:keep_good", "--jdbc-url", "jdbc:x",
            "--jdbc-input-table", "reviews", "--output", "out")
    with pytest.raises(ValueError, match="--split-column"):
        cli.transform_job(parsed(*argv))
    assert cli.transform_job(parsed(*argv, "--connections", "1")).source.split is None
    job = cli.transform_job(parsed(*argv, "--split-column", "review_id", "--connections", "4"))
    assert (job.source.split.column, job.source.split.partitions, job.sink.connections) == ("review_id", 4, 4)


def test_report_reads_the_configured_tables_over_jdbc(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "pw")
    job = cli.report_job(parsed("product_demand_monthly", "--config", CONFIG, "--connections", "8"))
    job.check()
    assert {n: s.table for n, s in job.sources.items()} == {
        "order_details": "public.order_details", "orders": "public.orders", "products": "public.products",
    }
    assert job.sources["products"].split.column == "product_id"
    assert job.sources["orders"].split.partitions == 8
    assert job.sink.path == "output/product_demand_monthly"
    job = cli.report_job(parsed("product_demand_monthly", "--config", CONFIG))
    assert job.sources["orders"].split.partitions == jobs.CONNECTIONS


def test_probe_settings_come_from_arguments_or_the_environment(monkeypatch):
    for name in ("JDBC_URL", "DB_USER", "DB_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    args = parsed("probe", "--jdbc-input-table", "orders", "--jdbc-url", "jdbc:x")
    with pytest.raises(ValueError, match="database user not found"):
        cli.probe_job(args)
    monkeypatch.setenv("DB_USER", "ann")
    job = cli.probe_job(args)
    assert (job.source.table, job.source.connection.user, job.preview_rows) == ("public.orders", "ann", 5)


def test_main_checks_opens_runs_and_stops(spark, tmp_path, monkeypatch):
    opened = []

    class Borrowed:
        def __getattr__(self, name):
            return getattr(spark, name)

        def stop(self):
            opened.append("stopped")

    monkeypatch.setattr(cli, "open_session", lambda *a: opened.append(a) or Borrowed())
    source = tmp_path / "in.csv"
    source.write_text("review_id,stars\n10,5\n")
    cli.main(["transform", "--function", "test_jobs:keep_good", "--input", str(source),
              "--output", str(tmp_path / "out"), "--limit", "0", "--jdbc-jar", "d.jar"])
    assert opened == [("ordertide-transform", "d.jar", {}), "stopped"]
