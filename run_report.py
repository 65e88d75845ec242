"""Run the performance analysis on a star schema or an export and write the report facts.

    run_report.py report --star FOLDER --as-of DATE --report FOLDER [--section NAME ...] [--filter COLUMN=VALUE ...]
    run_report.py report --export PATH ... --report FOLDER [--rejects FOLDER] ...
    run_report.py check --star FOLDER --out FOLDER       quality checks: check, target, observed, passed
    run_report.py validate --star FOLDER --out FOLDER    validation totals and sales by year
    run_report.py export --star FOLDER --as-of DATE --out FOLDER
    run_report.py views --star FOLDER --as-of DATE [--schema NAME]
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from salescope.config import AnalysisConfig, Thresholds
from salescope.operators import dimensions, facts, report
from salescope.plans import star_checks
from salescope.plans.performance import Performance
from salescope.session import tune
from salescope.sources import export, scratch, star, views


def enriched(spark: SparkSession, folder: str, as_of: dt.date) -> DataFrame:
    """The enriched fact of the raw star tables, and all views on them by name in the session."""
    raw = star.read_star(spark, folder)
    parts = {
        "vw_Sales": facts.sales_fact(raw["sales"]),
        "vw_Date": dimensions.date_dimension(raw["date"]),
        "vw_Product": dimensions.product_dimension(raw["product"]),
        "vw_Customer": dimensions.customer_dimension(raw["customer"], raw["geography"], as_of),
        "vw_Territory": dimensions.territory_dimension(raw["territory"]),
    }
    fact = facts.enriched(facts.star_join(*parts.values()))
    promotions = dimensions.promotion_dimension(raw["promotion"])
    star.register_views({**parts, "vw_Promotion": promotions, "vw_AI_Sales_Raw": fact})
    return fact


def settings(path: str | None, filters: list[str]) -> AnalysisConfig:
    """The analysis settings of a JSON file with fields of ``AnalysisConfig``, and the filters of the command."""
    known = {}
    if path:
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
    names = {field.name for field in dataclasses.fields(AnalysisConfig)}
    if set(known) - names:
        raise ValueError(f"unknown settings: {', '.join(sorted(set(known) - names))}")
    known = {name: tuple(value) if isinstance(value, list) else value for name, value in known.items()}
    if "thresholds" in known:
        known["thresholds"] = Thresholds(**known["thresholds"])
    chosen = dict(item.split("=", 1) for item in filters)
    return dataclasses.replace(AnalysisConfig(), **{**known, "active_filters": {**known.get("active_filters", {}), **chosen}})


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    day = {"type": dt.date.fromisoformat, "help": "day the ages refer to"}

    made = commands.add_parser("report", help="write the report facts")
    source = made.add_mutually_exclusive_group(required=True)
    source.add_argument("--star", help="folder with one folder per raw star table")
    source.add_argument("--export", nargs="+", help="export paths; the first that exists is read")
    made.add_argument("--as-of", **day)
    made.add_argument("--filter", action="append", default=[], metavar="COLUMN=VALUE")
    made.add_argument("--settings", help="JSON file with dimensions, thresholds, sizes and the like")
    made.add_argument("--section", action="append", help="renew only this section of the report; may be repeated")
    made.add_argument("--rejects", help="folder for the counts of figures of an export that could not be read")
    made.add_argument("--report", required=True, help="folder for the report facts")

    for name, text in (("check", "quality checks"), ("validate", "totals"), ("export", "line-grain export")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--star", required=True)
        command.add_argument("--out", required=True)
        if name == "export":
            command.add_argument("--as-of", required=True, **day)
    command = commands.add_parser("views", help="views in the catalog")
    command.add_argument("--star", required=True)
    command.add_argument("--as-of", required=True, **day)
    command.add_argument("--schema", default="bi")

    given = sys.argv[1:] if argv is None else argv
    if given and given[0] in ("--star", "--export", "--report", "--as-of", "--filter"):
        given = ["report", *given]
    args = parser.parse_args(given)
    if args.command == "report" and args.star and args.as_of is None:
        parser.error("--star needs --as-of, so that ages do not change with the day of the run")
    return args


def make_report(spark: SparkSession, args: argparse.Namespace) -> None:
    config = settings(args.settings, args.filter)
    if args.star:
        sales = enriched(spark, args.star, args.as_of)
    else:
        sales, rejects = export.load_checked(spark, args.export)
        if args.rejects:
            rejects.coalesce(1).write.mode("overwrite").parquet(args.rejects)
    report.write_facts(Performance(sales, config).report_text(args.section), args.report, args.section)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "report":
        make_report(spark, args)
    elif args.command == "check":
        star_checks.checks(star.read_star(spark, args.star)).coalesce(1).write.mode("overwrite").parquet(args.out)
    elif args.command == "validate":
        for name, table in star_checks.validation(star.read_star(spark, args.star)).items():
            table.coalesce(1).write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.command == "export":
        export.export_sales(enriched(spark, args.star, args.as_of), args.out)
    else:
        views.create_views(spark, args.star, args.as_of, args.schema)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    shared = SparkSession.getActiveSession() is not None
    spark = tune(SparkSession.builder.appName("sales-report").getOrCreate())
    try:
        run(spark, args)
    finally:
        # In a session of somebody else, others may still read what is stored.
        if not shared:
            scratch.release(spark)


if __name__ == "__main__":
    main()
