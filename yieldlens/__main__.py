"""The two batch jobs from the command line: spark-submit ... or python -m yieldlens {mine,recommend} --help"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from yieldlens.functions.threshold import MinUtility
from yieldlens.plans.pipeline import Settings, run_batch, serve
from yieldlens.sources.tables import load_clicks


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="yieldlens")
    commands = parser.add_subparsers(dest="command", required=True)
    mine = commands.add_parser("mine", help="items, matrix and recommendations from click and purchase files")
    mine.add_argument("clicks")
    mine.add_argument("purchases")
    mine.add_argument("out", help="folder for the results")
    least = mine.add_mutually_exclusive_group()
    least.add_argument("--min-utility", default="1000", help="as an amount")
    least.add_argument("--min-share", help="as a share of the total utility")
    mine.add_argument("--nonnegative", action="store_true", help="promise that no utility is negative")
    mine.add_argument("--rows", type=int, help="use the first rows of each file only")
    ask = commands.add_parser("recommend", help="recommendation lists for clicks from a stored matrix")
    ask.add_argument("matrix")
    ask.add_argument("clicks")
    ask.add_argument("out")
    for command, top_k in ((mine, 3), (ask, 5)):
        command.add_argument("--top-k", type=int, default=top_k)
        command.add_argument("--format", default="csv", help="of the click and purchase files")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = SparkSession.builder.appName("yieldlens").getOrCreate()
    if args.command == "mine":
        least = MinUtility.of_share(args.min_share) if args.min_share else MinUtility.of_amount(args.min_utility)
        settings = Settings(least, args.top_k, args.nonnegative)
        for stage, rows in run_batch(spark, args.clicks, args.purchases, args.out, settings, args.format, args.rows).items():
            print(f"{stage}: {rows} rows")
    else:
        clicks = load_clicks(spark, args.clicks, args.format)
        serve(spark, args.matrix, clicks, args.top_k).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
