"""Command line: ``python -m liftlens <command>`` (or via spark-submit).

Commands mirror the batch jobs: ``build`` (five warehouse tables), ``analyze``
(CSV exports + report), ``quality`` (exit code 1 when a check fails) and
``run-all``. The Spark session comes from the environment (spark-submit
settings on a cluster); nothing here picks a master.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from liftlens.config import ExperimentConfig
from liftlens.operators.quality import DataQualityError
from liftlens.plans.job import build_warehouse, export_reports, run_quality
from liftlens.sources.events import driver_events, read_ndjson_events


def _events(spark: SparkSession, args) -> DataFrame:
    if args.events:
        return read_ndjson_events(spark, args.events)
    return driver_events(spark, args.tables)


def _config(args) -> ExperimentConfig:
    return ExperimentConfig(lookback_days=args.lookback_days)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="liftlens")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "analyze", "quality", "run-all"):
        c = sub.add_parser(name)
        c.add_argument("--warehouse", required=True, help="folder of the five tables (shared storage)")
        c.add_argument("--lookback-days", type=int, default=7)
        if name in ("build", "run-all"):
            src = c.add_mutually_exclusive_group(required=True)
            src.add_argument("--events", help="NDJSON event files (file or folder)")
            src.add_argument("--tables", help="folder with the benchmark events.parquet")
        if name in ("analyze", "run-all"):
            c.add_argument("--reports", required=True, help="output folder of the CSV reports")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("liftlens").getOrCreate()
    config = _config(args)
    if args.command in ("build", "run-all"):
        build_warehouse(_events(spark, args), args.warehouse, config)
        print(f"warehouse: five tables in {args.warehouse}")
    if args.command in ("analyze", "run-all"):
        report = export_reports(spark, args.warehouse, args.reports, config)
        print(f"Reports written to {args.reports} ({report.count()} experiments)")
    if args.command in ("quality", "run-all"):
        failed = [r.failure_message for r in
                  run_quality(spark, args.warehouse).where("NOT passed").collect()]
        for message in failed:
            print(f"check failed: {message}")
        if failed:
            return 1
        print("quality: every check passed")
    return 0


def run() -> None:
    try:
        sys.exit(main())
    except DataQualityError as exc:  # pragma: no cover - main returns codes instead
        print(exc)
        sys.exit(1)
