"""Spellings that name one table or folder, and look-alikes that do not."""

import pytest
from conftest import ROOT
from ordertide import __main__ as cli
from ordertide.plans import jobs
from ordertide.sources import identity
from ordertide.sources.settings import Connection

URL = "jdbc:postgresql://db:5432/shop"
CONFIG = str(ROOT / "configs/base.yaml")


@pytest.mark.parametrize(
    ("url", "table", "other_url", "other"),
    [
        (URL, "orders", URL, "public.orders"),
        (URL, "ORDERS", URL, '"public"."orders"'),
        (URL, "orders", URL + "?user=ann&password=x&sslmode=require", "public.orders"),
        (URL, "orders", "JDBC:PostgreSQL://DB/shop", "shop.public.orders"),
        (URL, "mart.orders", URL + "?currentSchema=mart,public", "orders"),
        (URL, "orders", "jdbc:postgresql://other,db:5432/shop", "orders"),
        ("jdbc:postgresql:shop", "orders", "jdbc:postgresql://127.0.0.1:5432/shop", "orders"),
        ("jdbc:postgresql://[::1]/shop", "orders", "jdbc:postgresql://localhost/shop", "orders"),
        ("jdbc:mysql://db/shop", "orders", "jdbc:mariadb://db:3306/shop", "`shop`.`orders`"),
        ("jdbc:mysql://db/shop", "orders", "jdbc:mysql://db/other", "shop.orders"),
        ("jdbc:sqlserver://db;databaseName=shop", "[public].[orders]", "jdbc:sqlserver://db:1433;database=shop", "orders"),
        ("jdbc:oracle:thin:@//db:1521/shop", "s.orders", "jdbc:oracle:thin:@db:1521:shop", "s.orders"),
        (URL, "(SELECT * FROM public.orders WHERE x > 1) o", URL, "public.orders"),
        ("jdbc:sqlite:/data/x.db", "orders", "jdbc:sqlite:/data/x.db", "orders"),
    ],
)
def test_one_table(url, table, other_url, other):
    assert identity.same_table(url, table, other_url, other)
    assert identity.same_table(other_url, other, url, table)


@pytest.mark.parametrize(
    ("url", "table", "other_url", "other"),
    [
        (URL, "orders", URL, "mart.orders"),
        (URL, "orders", URL, "orders_clean"),
        (URL, "orders", "jdbc:postgresql://db:5433/shop", "orders"),
        (URL, "orders", "jdbc:postgresql://db2:5432/shop", "orders"),
        (URL, "orders", "jdbc:postgresql://db:5432/other", "orders"),
        (URL, "orders", "jdbc:mysql://db:5432/shop", "orders"),
        (URL, "(SELECT * FROM orders) o", URL, "orders_clean"),
        ("jdbc:mysql://db/shop", "orders", "jdbc:mysql://db/other", "orders"),
        (URL, '"my.orders"', URL, "my.orders"),
    ],
)
def test_different_tables(url, table, other_url, other):
    assert not identity.same_table(url, table, other_url, other)
    assert not identity.same_table(other_url, other, url, table)


@pytest.mark.parametrize(
    ("path", "other"),
    [
        ("/data/in", "/data/in/"),
        ("/data/in", "file:///data/in"),
        ("/data/in", "file:/data/x/../in"),
        ("/data/in", "/data//./in"),
        ("data/in", "./data/in"),
        ("/data/in", "/data"),
        ("/data", "/data/in/part"),
        ("/data/*", "/data/in"),
        ("/data/{a,in}/x", "/data/in/x"),
        ("s3a://bucket/in", "s3://bucket/in/"),
        ("hdfs://name:8020/data/in", "hdfs://name/data/in"),
        ("hdfs://name/data/in", "/data/in"),
        ("/data/a%20b#1", "file:/data/a%20b#1/"),
    ],
)
def test_one_folder(path, other):
    assert identity.overlapping(path, other)
    assert identity.overlapping(other, path)


@pytest.mark.parametrize(
    ("path", "other"),
    [
        ("/data/in", "/data/inner"),
        ("/data/in", "/data/out"),
        ("s3a://one/in", "s3a://two/in"),
        ("hdfs://name/in", "s3a://name/in"),
        ("/data/*.csv", "/data/out"),
        ("/data/{a,b}", "/data/c"),
    ],
)
def test_different_folders(path, other):
    assert not identity.overlapping(path, other)
    assert not identity.overlapping(other, path)


def test_a_link_is_the_folder_it_leads_to(tmp_path):
    (tmp_path / "real").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "real")
    assert identity.overlapping(f"{tmp_path}/real", f"{tmp_path}/link")


def transform(*argv):
    args = ["transform", "--function", "test_jobs:keep_good", "--jdbc-url", URL, "--db-user", "ann", "--db-password", "x", "--connections", "1"]
    return cli.transform_job(cli._parser().parse_args([*args, *argv]))


@pytest.mark.parametrize("output", ["orders", "public.orders", '"public"."ORDERS"', "shop.public.orders"])
def test_transform_refuses_its_own_table_in_every_spelling(output):
    for source in ("orders", "public.orders"):
        job = transform("--jdbc-input-table", source, "--jdbc-output-table", output)
        with pytest.raises(ValueError, match="own table"):
            job.check()
    transform("--jdbc-input-table", "orders", "--jdbc-output-table", "mart.orders").check()


def test_transform_names_tables_with_their_schema():
    job = transform("--jdbc-input-table", "orders", "--jdbc-output-table", "clean")
    assert (job.source.table, job.sink.table) == ("public.orders", "public.clean")
    job = transform("--jdbc-input-table", "(SELECT 1) q", "--jdbc-output-table", "mart.clean")
    assert (job.source.table, job.sink.table) == ("(SELECT 1) q", "mart.clean")


DB = Connection(URL, "ann", "hidden")
TABLES = {name: jobs.Source(path=f"/data/{name}.parquet") for name in jobs.INPUTS}


@pytest.mark.parametrize(
    "job",
    [
        jobs.ReportJob("product_demand_base", TABLES, jobs.Sink(path="file:/data/orders.parquet/")),
        jobs.ReportJob("product_demand_base", TABLES, jobs.Sink(path="/data/x/../")),
        jobs.ReportJob("product_demand_summary", {}, jobs.Sink(path="/data/base/"), base=jobs.Source(path="/data/base")),
        jobs.ReportJob("product_demand_base", TABLES | {"orders": jobs.Source(DB, "orders")}, jobs.Sink(DB, "public.orders")),
        jobs.ReportJob("product_demand_base", TABLES | {"orders": jobs.Source(path="/data/o_cast_losses")}, jobs.Sink(path="/data/o"), lenient=True),
        jobs.AnalysisJob("period_summary", jobs.Source(path="/data/monthly"), jobs.Sink(path="/data/./monthly")),
        jobs.ChartsJob(jobs.Source(path="/data/charts/monthly_trend"), "/data/charts"),
        jobs.QualityJob(TABLES | {"orders": jobs.Source(path="/q/orders_nulls")}, "/q"),
        jobs.TransformJob(jobs.Source(path="/data/in/*"), lambda df: df, jobs.Sink(path="/data/in/x")),
    ],
)
def test_every_job_refuses_to_overwrite_its_input(job):
    with pytest.raises(ValueError, match="own table or folder"):
        job.check()
