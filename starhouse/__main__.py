"""Command line: land pages, refresh the core, run any plan on the published version.

    python -m starhouse land    PAGES LANDED
    python -m starhouse refresh LANDED ROOT
    python -m starhouse run     NAME ROOT [--landed LANDED] [--out PATH]
    python -m starhouse list

Master, memory and partitions come from the submitter and Spark's defaults file.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starhouse.plans.catalog import PLANS
from starhouse.plans.landing import land_pages, landed_stage
from starhouse.plans.refresh import refresh_core
from starhouse.plans.warehouse import PublishedWarehouse
from starhouse.profile import HEALTH


#: Rows printed without --out.
SHOWN = 50


def session() -> SparkSession:
    """The session as configured; no setting is made here."""
    return SparkSession.builder.appName("starhouse").getOrCreate()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starhouse")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("land", help="landed JSON pages to CSV files")
    land.add_argument("pages")
    land.add_argument("landed")
    refresh = commands.add_parser("refresh", help="rebuild and publish the core from CSV files")
    refresh.add_argument("landed")
    refresh.add_argument("root")
    run = commands.add_parser("run", help="run one plan on the published core")
    run.add_argument("name", choices=sorted(PLANS))
    run.add_argument("root")
    run.add_argument("--landed", help="CSV folder, for plans that read staging")
    run.add_argument("--out", help="write Parquet here instead of printing")
    commands.add_parser("list", help="names of all plans")
    args = parser.parse_args(argv)

    if args.command == "list":
        print("\n".join(sorted(PLANS)))
        return
    spark = session()
    if args.command == "land":
        land_pages(spark, HEALTH, args.pages, args.landed)
    elif args.command == "refresh":
        stage = landed_stage(spark, args.landed)
        refresh_core(spark, HEALTH, stage, args.root, verbose=True).show()
    else:
        stage = landed_stage(spark, args.landed) if args.landed else None
        result = PLANS[args.name](PublishedWarehouse(spark, HEALTH, args.root, stage))
        if args.out:
            result.write.parquet(args.out)
        else:
            shown = result.limit(SHOWN + 1).collect()
            for row in [result.columns, *shown[:SHOWN]]:
                print(" | ".join("" if value is None else str(value) for value in row))
            if len(shown) > SHOWN:
                print(f"(first {SHOWN} rows; there are more, use --out for all)")


if __name__ == "__main__":
    main()
