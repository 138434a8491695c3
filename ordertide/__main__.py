"""Command line: ``python -m ordertide <command>``."""

from __future__ import annotations

import argparse
from importlib import import_module

from ordertide.plans import jobs
from ordertide.session import open_session
from ordertide.sources.settings import (
    DEFAULT_DRIVER,
    JAR_ENV,
    PASSWORD_ENV,
    URL_ENV,
    USER_ENV,
    Connection,
    Settings,
    load_settings,
    optional_path,
    qualified,
    required,
    setting,
)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ordertide", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    for name in jobs.REPORTS:
        report = commands.add_parser(name, help=f"write the {name} table")
        _common(report, preview=20)
        _inputs(report)
        report.add_argument("--output", help="output folder; default from the configuration")
        report.add_argument("--base", help="build from this stored demand base")
        report.add_argument("--by", nargs="+", default=[], help="grouping columns")
        report.add_argument("--sorted", action="store_true", help="sort the stored table too")
        report.add_argument("--lenient", action="store_true", help="malformed values become null")

    for name in jobs.ANALYSES:
        analysis = commands.add_parser(name, help=f"write {name} from the monthly table")
        analysis.add_argument("--config", default="configs/base.yaml")
        analysis.add_argument("--input", help="monthly table; default from the configuration")
        analysis.add_argument("--output", help="output folder; default from the configuration")
        analysis.add_argument("--category-id", type=int)
        analysis.add_argument("--product-id", type=int)
        analysis.add_argument("--top-n", type=int, default=10)
        analysis.add_argument("--focus-top", type=int, help="only the products with most units")
        analysis.add_argument("--limit", type=int, default=20, help="preview rows; 0 for none")

    checks = commands.add_parser("quality", help="write quality reports of the inputs")
    _common(checks, preview=20)
    _inputs(checks)
    checks.add_argument("--output-dir", help="output folder; default from the configuration")
    checks.add_argument("--null-threshold", type=float, default=0.0, help="permitted null share")

    chart = commands.add_parser("charts", help="write chart datasets from the monthly table")
    chart.add_argument("--config", default="configs/base.yaml")
    chart.add_argument("--input", help="monthly table; default from the configuration")
    chart.add_argument("--output-dir", help="output folder; default from the configuration")
    chart.add_argument("--top-n", type=int, default=10)
    chart.add_argument("--category-id", type=int)

    probe = commands.add_parser("probe", help="show and count a database table")
    _common(probe, preview=5)
    _database(probe)

    transform = commands.add_parser("transform", help="apply a function to a table")
    _common(transform, preview=20)
    _database(transform, table_required=False)
    transform.add_argument("--function", required=True, help="module:function")
    transform.add_argument("--input", help="input files")
    transform.add_argument("--input-format", choices=list(jobs.FILE_READERS), default="csv")
    transform.add_argument("--output", help="output Parquet folder")
    transform.add_argument("--jdbc-output-table")
    transform.add_argument("--split-column", help="split the input table by ranges of this column")
    transform.add_argument("--output-split-column", help="the same, to read the output table back")
    _connections(transform)
    transform.add_argument("--order-by", help="numeric column to sort the preview by")
    return parser


def _common(parser: argparse.ArgumentParser, preview: int) -> None:
    parser.add_argument("--limit", type=int, default=preview, help="preview rows; 0 for none")
    parser.add_argument("--app-name")
    parser.add_argument("--jdbc-jar", help=f"JDBC driver jar; default ${JAR_ENV}")
    parser.add_argument("--db-password")
    parser.add_argument("--db-password-env", default=None, help=f"default {PASSWORD_ENV}")


def _inputs(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--config", default="configs/base.yaml", help="YAML configuration")
    parser.add_argument("--input-folder", help="read <folder>/<table>.parquet, not JDBC")
    _connections(parser)


def _connections(parser: argparse.ArgumentParser) -> None:
    parser.add_argument(
        "--connections", type=int, default=jobs.CONNECTIONS, help="JDBC connections per table"
    )


def _database(parser: argparse.ArgumentParser, table_required: bool = True) -> None:
    parser.add_argument("--jdbc-url", help=f"default ${URL_ENV}")
    parser.add_argument("--jdbc-input-table", required=table_required)
    parser.add_argument("--jdbc-driver", default=DEFAULT_DRIVER)
    parser.add_argument("--db-user", help=f"default ${USER_ENV}")


def input_sources(args: argparse.Namespace, settings: Settings) -> dict[str, jobs.Source]:
    if args.input_folder:
        return jobs.folder_sources(args.input_folder)
    connection = settings.connection(args.db_password, args.db_password_env)
    return jobs.configured_sources(settings, connection, jobs.even_split(args.connections))


def report_job(args: argparse.Namespace) -> jobs.ReportJob:
    settings = load_settings(args.config)
    path = settings.path(jobs.REPORTS[args.command].path_name, args.output)
    return jobs.ReportJob(
        report=args.command,
        sources={} if args.base else input_sources(args, settings),
        sink=jobs.Sink(path=path),
        base=jobs.Source(path=args.base) if args.base else None,
        by=tuple(args.by),
        preview_rows=args.limit,
        ordered=args.sorted,
        lenient=args.lenient,
    )


def analysis_job(args: argparse.Namespace) -> jobs.AnalysisJob:
    settings = load_settings(args.config)
    return jobs.AnalysisJob(
        analysis=args.command,
        monthly=jobs.Source(path=settings.path("product_demand_monthly", args.input)),
        sink=jobs.Sink(path=settings.path(args.command, args.output)),
        category_id=args.category_id,
        product_id=args.product_id,
        top_n=args.top_n,
        preview_rows=args.limit,
        focus_top=args.focus_top,
    )


def quality_job(args: argparse.Namespace) -> jobs.QualityJob:
    settings = load_settings(args.config)
    return jobs.QualityJob(
        sources=input_sources(args, settings),
        folder=settings.path("quality", args.output_dir),
        null_threshold=args.null_threshold,
        preview_rows=args.limit,
    )


def charts_job(args: argparse.Namespace) -> jobs.ChartsJob:
    settings = load_settings(args.config)
    return jobs.ChartsJob(
        monthly=jobs.Source(path=settings.path("product_demand_monthly", args.input)),
        folder=settings.path("product_demand_monthly_charts", args.output_dir),
        top_n=args.top_n,
        category_id=args.category_id,
    )


def probe_job(args: argparse.Namespace) -> jobs.ProbeJob:
    connection = Connection(
        url=required(args.jdbc_url, URL_ENV, "JDBC URL", "--jdbc-url"),
        user=required(args.db_user, USER_ENV, "database user", "--db-user"),
        password=setting(args.db_password, args.db_password_env or PASSWORD_ENV),
        driver=args.jdbc_driver,
    )
    return jobs.ProbeJob(jobs.Source(connection, _qualified(args.jdbc_input_table)), args.limit)


def _qualified(table: str | None) -> str | None:
    """The table with its schema; nothing, and a query in parentheses, stay as they are."""
    return table if not table or table.lstrip().startswith("(") else qualified(table)


def transform_job(args: argparse.Namespace) -> jobs.TransformJob:
    url = setting(args.jdbc_url, URL_ENV)
    connection = url and Connection(
        url=url,
        user=setting(args.db_user, USER_ENV),
        password=setting(args.db_password, args.db_password_env or PASSWORD_ENV),
        driver=args.jdbc_driver,
    )
    if args.jdbc_input_table and not args.split_column and args.connections != 1:
        raise ValueError("give --split-column, or --connections 1 to read the table in one task")
    read, read_back = (
        jobs.readers.Split(column, args.connections) if column and args.connections > 1 else None
        for column in (args.split_column, args.output_split_column)
    )
    module, _, function = args.function.partition(":")
    return jobs.TransformJob(
        source=jobs.Source(
            connection or None, _qualified(args.jdbc_input_table), args.input, args.input_format, read
        ),
        transform=getattr(import_module(module), function or "transform"),
        sink=jobs.Sink(
            connection or None, _qualified(args.jdbc_output_table), args.output,
            connections=args.connections, split=read_back,
        ),
        preview_rows=args.limit,
        order_by_number=args.order_by,
    )


BUILDERS = {
    **dict.fromkeys(jobs.REPORTS, report_job),
    **dict.fromkeys(jobs.ANALYSES, analysis_job),
    "charts": charts_job,
    "probe": probe_job,
    "quality": quality_job,
    "transform": transform_job,
}


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    job = BUILDERS[args.command](args)
    job.check()
    jar = setting(optional_path(getattr(args, "jdbc_jar", None)), JAR_ENV)
    conf, name = {}, getattr(args, "app_name", None)
    if hasattr(args, "config"):
        spark_section = load_settings(args.config).spark
        conf = spark_section.get("conf") or {}
        name = name or spark_section.get("app_name")
    spark = open_session(name or f"ordertide-{args.command}", jar, conf)
    try:
        job.run(spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
