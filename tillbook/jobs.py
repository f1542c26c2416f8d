"""Commands for spark-submit: generate feeds, load them, build marts.

    spark-submit tillbook/jobs.py generate --start 2025-01-01 --end 2026-04-14 --orders 300 --out DIR
    spark-submit tillbook/jobs.py load --warehouse DIR --orders-2023 A.csv --orders-2025 B.csv ...
    spark-submit tillbook/jobs.py marts --share 0.40
    spark-submit tillbook/jobs.py refresh --warehouse DIR --share 0.40 --since 6
    spark-submit tillbook/jobs.py ids --warehouse DIR
    spark-submit tillbook/jobs.py expire --warehouse DIR --keep 3 --older-than-hours 24
    spark-submit tillbook/jobs.py restore --warehouse DIR --number 7
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from tillbook.session import SETTINGS  # noqa: E402
from tillbook.plans import ingest, refresh, synthetic  # noqa: E402
from tillbook.sources import tables, versions  # noqa: E402
from tillbook.sources.scratch import clear_scratch  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillbook")
    commands = parser.add_subparsers(dest="command", required=True)
    generate = commands.add_parser("generate", help="write synthetic feeds as CSV")
    generate.add_argument("--start", type=date.fromisoformat, required=True)
    generate.add_argument("--end", type=date.fromisoformat, required=True)
    generate.add_argument("--orders", type=int, required=True)
    generate.add_argument("--items", help="parquet of recurring supplies")
    generate.add_argument("--out", required=True)
    marts = commands.add_parser("marts", help="save facts and dimensions as tables")
    marts.add_argument("--share", required=True, help="the workers' share of revenue, 0 to 1")
    load = commands.add_parser("load", help="validate the feeds and publish the tables and views")
    load.add_argument("--warehouse", required=True)
    load.add_argument(
        "--multiline", action="append", default=[], choices=[f.name for f in fields(ingest.FeedPaths)],
        help="a feed whose cells hold line breaks; may be given several times",
    )
    load.add_argument("--max-rejects", type=int, default=0, help="lines that may be broken without failing the load")
    refresh = commands.add_parser("refresh", help="write the periods of the marts that loads have touched")
    refresh.add_argument("--warehouse", required=True)
    refresh.add_argument("--share", required=True)
    refresh.add_argument("--since", type=int, help="manifest that the marts were last built from")
    ids = commands.add_parser("ids", help="give orders ids that stay")
    ids.add_argument("--warehouse", required=True)
    expire = commands.add_parser("expire", help="delete files of former loads that no kept manifest names")
    expire.add_argument("--warehouse", required=True)
    expire.add_argument("--keep", type=int, default=3, help="newest manifests that stay")
    expire.add_argument("--older-than-hours", type=float, default=24.0)
    restore = commands.add_parser("restore", help="make an earlier load's files the tables again")
    restore.add_argument("--warehouse", required=True)
    restore.add_argument("--number", type=int, required=True)
    for feed in fields(ingest.FeedPaths):
        load.add_argument("--" + feed.name.replace("_", "-"), required=True)
    return parser


def _generate(spark: SparkSession, args: argparse.Namespace) -> None:
    orders = synthetic.generate_orders(spark, args.start, args.end, args.orders)
    tables.save_csv(orders, f"{args.out}/synthetic_orders")
    if args.items:
        items = spark.read.parquet(args.items)
        supplies = synthetic.generate_supplies(items, args.start, args.end)
        tables.save_csv(supplies, f"{args.out}/synthetic_supplies")


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = ingest.FeedPaths(**{f.name: getattr(args, f.name) for f in fields(ingest.FeedPaths)})
    for title, frame in ingest.load(spark, paths, args.warehouse, args.multiline, args.max_rejects).items():
        print(title)
        frame.show(truncate=False)
    ingest.stage(spark)


def run(spark: SparkSession, argv: list[str]) -> None:
    """One command; its scratch files go whether it succeeds or fails."""
    args = _parser().parse_args(argv)
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    try:
        if args.command == "generate":
            _generate(spark, args)
        elif args.command == "marts":
            ingest.build_marts(spark, args.share)
        elif args.command == "refresh":
            print(refresh.refresh_marts(spark, args.warehouse, args.share, args.since))
        elif args.command == "ids":
            print(refresh.assign_order_ids(spark, args.warehouse))
        elif args.command == "expire":
            for gone in versions.expire(spark, args.warehouse, args.keep, args.older_than_hours):
                print(gone)
        elif args.command == "restore":
            versions.restore(spark, args.warehouse, args.number)
        else:
            _load(spark, args)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tillbook").getOrCreate(), sys.argv[1:])
