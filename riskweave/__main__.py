"""Run one job: ``spark-submit ... -m riskweave`` or ``python -m riskweave <job> --help``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from riskweave.plans import jobs
from riskweave.session import delete_scratch, get_spark


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="riskweave")
    main.add_argument("--local", type=int, metavar="CORES", help="run on this machine")
    main.add_argument("--run-ts", default=datetime.now().isoformat(" ", "seconds"))
    commands = main.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        for path in paths:
            command.add_argument(path)
        return command

    build = job("build", "source_root", "mart_root")
    build.add_argument("--as-of", help="day account ages refer to (default: the run's)")
    build.add_argument("--gate", action="store_true", help="stop if a quality check fails")
    build.add_argument(
        "--most-skew", type=int, metavar="SECONDS", help="stop if the sources' files lie further apart"
    )
    build.add_argument("--publish", action="store_true", help="also store the inner layers")
    train = job("train", "mart_root", "model_path")
    train.add_argument(
        "--choose-threshold", action="store_true", help="predict from the score of highest F1"
    )
    train.add_argument("--least-recall", type=float, default=0.0, help="what that score must reach")
    score = job("score", "mart_root", "alerts_path")
    score.add_argument("--model", help="stored model; the rules are used without one")
    score.add_argument("--append-all", action="store_true", help="repeat stored alerts")
    report = job("report", "alerts_path")
    report.add_argument("--top", type=int, default=10)
    notify = job("notify", "alerts_path", "feed_path")
    notify.add_argument("--once-per-customer", action="store_true")
    return main


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = get_spark("riskweave", args.local)
    try:
        run(spark, args)
    finally:
        delete_scratch(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "build":
        as_of = args.as_of or args.run_ts[:10]
        warehouse = jobs.build_marts(
            spark, args.source_root, args.mart_root, args.run_ts, as_of, args.gate, args.most_skew
        )
        if args.publish:
            jobs.publish_layers(spark, warehouse)
    elif args.job == "train":
        jobs.train_model(
            spark, args.mart_root, args.model_path, args.choose_threshold, args.least_recall
        ).show()
    elif args.job == "score":
        jobs.score_marts(
            spark,
            args.mart_root,
            args.alerts_path,
            args.run_ts,
            args.model,
            not args.append_all,
        )
    elif args.job == "report":
        jobs.report_top_customers(spark, args.alerts_path, args.top).show(args.top)
    elif args.job == "notify":
        jobs.write_notifications(spark, args.alerts_path, args.feed_path, args.once_per_customer)


if __name__ == "__main__":
    main()
