"""Command line of the jobs, for ``spark-submit`` or ``python -m roomlens``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from roomlens.plans import detection, insights, profile, reporting, warehouse
from roomlens.session import configure
from roomlens.sources import readers
from roomlens.sources.scratch import scratch_scope, shared_table


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roomlens", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    explore = jobs.add_parser("profile", help="profile the raw files")
    build = jobs.add_parser("warehouse", help="build the star schema from the raw files")
    explore.add_argument("--out", required=True, help="folder of the results")
    explore.add_argument("--run-date", required=True, help="date of the run, 'yyyy-MM-dd'")
    for job in (explore, build):
        job.add_argument("--events", required=True, help="clickstream CSV")
        job.add_argument("--products", required=True, help="catalogue CSV")
    build.add_argument("--root", required=True, help="folder of the tables")
    build.add_argument("--run-ts", required=True, help="load time, 'yyyy-MM-dd HH:mm:ss'")

    load = jobs.add_parser("load", help="add a batch of events to the fact; prints the dates it touched")
    load.add_argument("--events", required=True, help="clickstream CSV of the batch")
    load.add_argument("--root", required=True, help="folder of the tables")
    load.add_argument("--run-ts", required=True, help="load time, 'yyyy-MM-dd HH:mm:ss'")

    for name in ("report", "insights", "detect"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of the tables")
        job.add_argument("--out", required=True, help="folder of the results")
        job.add_argument("--run-date", required=True, help="date of the run, 'yyyy-MM-dd'")
        if name == "detect":
            job.add_argument("--run-ts", required=True, help="alert time, 'yyyy-MM-dd HH:mm:ss'")
            job.add_argument("--since", help="first date to read; days before keep their stored measures")
        if name != "insights":
            job.add_argument("--dates", type=dates, help="dates to read, as 'load' prints them; others keep what is stored")
    return top


def dates(text: str) -> list[date | None]:
    """Comma-separated dates; 'none' stands for events without a date."""
    return [None if part == "none" else date.fromisoformat(part) for part in text.split(",") if part]


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    configure(spark)
    if args.job == "profile":
        events = shared_table(readers.read_events_csv(spark, args.events), "raw-events")
        products = shared_table(readers.read_products_csv(spark, args.products), "raw-products")
        profile.write(profile.raw_events(events), f"{args.out}/events", args.run_date)
        profile.write(profile.raw_products(products), f"{args.out}/products", args.run_date)
        return
    if args.job == "warehouse":
        house = warehouse.build(spark, args.events, args.products, args.root, args.run_ts)
        warehouse.write_checks(house, args.run_ts[:10])
        warehouse.table_counts(house).show(truncate=False)
        return
    house = warehouse.Warehouse(spark, args.root)
    if args.job == "load":
        touched = warehouse.load(house, args.events, args.run_ts)
        print(",".join("none" if day is None else day.isoformat() for day in touched))
        return
    fact = house.table("fact_user_events")
    if args.job == "report":
        reporting.run(fact, args.out, args.run_date, dates=args.dates)
    elif args.job == "insights":
        insights.run(fact, args.out, args.run_date)
    else:
        detection.run(fact, args.out, args.run_date, args.run_ts, since=args.since, dates=args.dates).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"roomlens-{args.job}").getOrCreate()
    with scratch_scope(spark):
        run(spark, args)


if __name__ == "__main__":
    main()
