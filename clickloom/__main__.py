"""Command line of the jobs, also for spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from clickloom.functions.referers import FIXED_RULES, RULES
from clickloom.operators.reload import INDEX_CATEGORIES
from clickloom.plans import jobs
from clickloom.plans.etl import months_of_week
from clickloom.sources.raw_clicks import click_paths


REFERER_RULES = {"published": RULES, "any-prefix": FIXED_RULES}


def _category(text: str) -> tuple[str, str]:
    masthead, given, category = text.partition("=")
    if not given:
        raise argparse.ArgumentTypeError(f"{text!r} is not MASTHEAD=CATEGORY")
    return masthead, category


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom", description="Page-view analytics on Spark")
    commands = parser.add_subparsers(dest="job", required=True)

    raw = argparse.ArgumentParser(add_help=False)
    raw.add_argument("--root", required=True, help="folder of the raw click files")
    raw.add_argument("--month", nargs="+", help="MM-YYYY, or * for all; by default those of the week, if its year is given")
    raw.add_argument("--masthead", nargs="+", required=True)
    raw.add_argument("--output", required=True)
    raw.add_argument("--parse-partitions", type=int, help="tasks that parse lines, 0 for those that read them")

    etl = commands.add_parser("sessionise", parents=[raw], help="raw clicks to sessionised clicks")
    etl.add_argument("--week", type=int, required=True)
    etl.add_argument("--year", type=int)
    etl.add_argument("--separate", action="store_true", help="keep mastheads' sessions apart")
    etl.add_argument("--quarantine", help="folder for lines that are no click")
    etl.add_argument("--json", action="store_true", help="gzip JSON lines instead of parquet")
    etl.add_argument("--files", type=int, help="number of JSON files")
    etl.add_argument("--salt", default="", help="changes which views count as reloads")
    etl.add_argument(
        "--index-category", nargs="+", type=_category, metavar="MASTHEAD=CATEGORY",
        help="homepages that reload, in place of the built-in ones",
    )
    etl.add_argument("--referer-rules", choices=sorted(REFERER_RULES), default="published")
    etl.add_argument("--preview", type=int, default=0, help="print so many of the rows written")

    forecast = commands.add_parser("forecast", parents=[raw], help="monthly metrics by device")
    forecast.add_argument("--ip-file", required=True)
    forecast.add_argument("--country", default="AU")
    forecast.add_argument("--ip-column", default="IpAddress")
    forecast.add_argument("--default-ip", help="address of clicks that have none")

    for name, text in (
        ("brand-path", "paths between sites"),
        ("content", "sections and articles"),
        ("visitors", "weekly and daily visitor metrics"),
        ("segments", "visitor segments"),
    ):
        report = commands.add_parser(name, help=f"{text}, from sessionised clicks")
        report.add_argument("--input", required=True)
        report.add_argument("--json", action="store_true")
        report.add_argument("--masthead", help="read and label one masthead only")
        report.add_argument("--week", type=int)
        report.add_argument("--year", type=int)
        report.add_argument("--output", required=True)
        if name == "content":
            report.add_argument(
                "--session-key", default="sessionStart", choices=["sessionStart", "sessionId"],
                help="what tells visits apart; sessionId counts them exactly",
            )
    for command in commands.choices.values():
        command.add_argument("--shuffle-partitions", type=int, help="tasks of each shuffle")
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job in ("sessionise", "forecast") and not args.month:
        if getattr(args, "year", None) is None:
            parser.error("give --month, or --week and --year")
        args.month = months_of_week(args.week, args.year)
    spark = SparkSession.builder.appName(f"clickloom {args.job}").getOrCreate()
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.job in ("sessionise", "forecast"):
        paths = click_paths(args.root, args.month, args.masthead)
        if args.job == "sessionise":
            jobs.sessionise_files(
                spark, paths, args.output, args.week, args.year, not args.separate,
                args.quarantine, args.json, args.files, args.salt,
                dict(args.index_category or INDEX_CATEGORIES), REFERER_RULES[args.referer_rules],
                args.parse_partitions, args.preview,
            )
        else:
            jobs.forecast_report(
                spark, paths, args.ip_file, "+".join(args.masthead), args.output,
                args.country, args.default_ip, args.ip_column, args.parse_partitions,
            )
        return
    clicks = jobs.read_sessionised(spark, args.input, args.json, args.masthead, args.week, args.year)
    output = jobs.report_folder(args.output, args.week, args.year)
    label = args.masthead or "all"
    if args.job == "brand-path":
        jobs.brand_path_report(clicks, output)
    elif args.job == "content":
        jobs.content_reports(clicks, label, output, args.session_key)
    elif args.job == "visitors":
        jobs.visitor_reports(clicks, label, output)
    else:
        jobs.segment_reports(clicks, output)


if __name__ == "__main__":
    main()
