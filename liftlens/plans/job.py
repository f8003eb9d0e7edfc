"""Batch jobs: build the warehouse, export reports, run the quality gate.

Each warehouse table is written whole, as a new version, and read back before
the next one is derived from it; readers are switched to all new versions at
once when the last is written (``sources.tables``). The stored tables are the
lineage cut: when an executor is lost, Spark re-reads the stored input of the
current step instead of recomputing the chain from the raw events. The
warehouse folder must be shared storage on a cluster (the caller passes it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from liftlens.config import DEFAULT_CONFIG, ExperimentConfig
from liftlens.operators.cells import metric_cells
from liftlens.operators.conversions import attribute_conversions
from liftlens.operators.exposures import first_exposures
from liftlens.operators.inference import experiment_report, summary_enriched
from liftlens.operators.metrics import daily_metrics, summary_metrics
from liftlens.operators.quality import ObservedChecks, quality_checks, raise_on_failure
from liftlens.operators.staging import stage_events
from liftlens.schema import CHECKOUT_EVENT, EXPOSURE_EVENT
from liftlens.sources.tables import Build, read_table, write_csv


@dataclass(frozen=True)
class Warehouse:
    staged: DataFrame
    exposures: DataFrame
    conversions: DataFrame
    daily: DataFrame
    summary: DataFrame
    cells: DataFrame


def open_warehouse(spark: SparkSession, warehouse_dir: str) -> Warehouse:
    """Scan the stored tables."""
    return Warehouse(
        staged=read_table(spark, warehouse_dir, "stg_events"),
        exposures=read_table(spark, warehouse_dir, "experiment_exposures"),
        conversions=read_table(spark, warehouse_dir, "experiment_conversions"),
        daily=read_table(spark, warehouse_dir, "experiment_metrics_daily"),
        summary=read_table(spark, warehouse_dir, "experiment_metrics_summary"),
        cells=read_table(spark, warehouse_dir, "experiment_metric_cells"),
    )


def build_warehouse(raw_events: DataFrame, warehouse_dir: str,
                    config: ExperimentConfig = DEFAULT_CONFIG,
                    checks: ObservedChecks | None = None) -> Warehouse:
    """Build the five tables and the cells, each from the stored previous one.

    ``checks`` collects the figures of the quality checks while writing.
    """
    spark = raw_events.sparkSession
    with Build(spark, warehouse_dir) as build:
        build.write(stage_events(raw_events), "stg_events", checks and checks.of_staged)
        _derive(build, config, checks)
    return open_warehouse(spark, warehouse_dir)


def build_from_staged(spark: SparkSession, warehouse_dir: str,
                      config: ExperimentConfig = DEFAULT_CONFIG) -> Warehouse:
    """Build the tables after the stored staging (by ``build_warehouse`` or by the stream)."""
    with Build(spark, warehouse_dir) as build:
        _derive(build, config)
    return open_warehouse(spark, warehouse_dir)


def _derive(build: Build, config: ExperimentConfig, checks: ObservedChecks | None = None) -> None:
    exposures = first_exposures(build.read("stg_events", only=[EXPOSURE_EVENT]))
    if checks:
        exposures = checks.numbered(exposures, ["experiment_key", "user_id"], "exposure_ts")
    build.write(exposures, "experiment_exposures", checks and checks.of_exposures)
    build.write(attribute_conversions(build.read("experiment_exposures"),
                                      build.read("stg_events", only=[CHECKOUT_EVENT]),
                                      config.lookback_days, config), "experiment_conversions")
    conversions = build.read("experiment_conversions")
    build.write(daily_metrics(conversions), "experiment_metrics_daily")
    summary = summary_metrics(conversions)
    if checks:
        summary = checks.numbered(summary, ["variant"], "experiment_key")
    build.write(summary, "experiment_metrics_summary", checks and checks.of_summary)
    build.write(metric_cells(conversions), "experiment_metric_cells")


def export_reports(spark: SparkSession, warehouse_dir: str, report_dir: str,
                   config: ExperimentConfig = DEFAULT_CONFIG) -> DataFrame:
    """Enriched summary CSV, daily CSV and the per-experiment report table.

    Returns the report (one row per experiment: rates, uplift, z, p).
    """
    wh = open_warehouse(spark, warehouse_dir)
    base = report_dir.rstrip("/")
    write_csv(summary_enriched(wh.summary), f"{base}/experiment_summary",
              ["experiment_key", "variant"])
    write_csv(wh.daily, f"{base}/experiment_daily_metrics",
              ["experiment_key", "exposure_date", "variant"])
    report = experiment_report(wh.summary, config.lookback_days)
    write_csv(report, f"{base}/experiment_report", ["experiment_key"])
    return report


def run_quality(spark: SparkSession, warehouse_dir: str) -> DataFrame:
    """The five checks over the stored tables (one row per check)."""
    wh = open_warehouse(spark, warehouse_dir)
    return quality_checks(wh.staged, wh.exposures, wh.summary)


def run_all(raw_events: DataFrame, warehouse_dir: str, report_dir: str,
            config: ExperimentConfig = DEFAULT_CONFIG) -> DataFrame:
    """Build, export, then gate on quality (reports exist even if a check fails).

    The checks are observed on the rows while they are written, so no table is
    scanned for them. Returns the check table; raises ``DataQualityError`` if
    any check failed.
    """
    spark = raw_events.sparkSession
    observed = ObservedChecks()
    build_warehouse(raw_events, warehouse_dir, config, observed)
    export_reports(spark, warehouse_dir, report_dir, config)
    checks = observed.rows(spark)
    raise_on_failure(checks)
    return checks
