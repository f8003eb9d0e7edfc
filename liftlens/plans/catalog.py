"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the benchmark ``events`` table of ``sf_dir`` (mapped to
product events by ``liftlens.sources.driver_events``) and runs over all of
its rows. Slice queries use experiment ``exp_1``; ``*_slice`` selects
countries IN, US, DE and devices mobile, desktop; ``snapshot_no_data``
selects a country that never occurs. Slices read a stored table of cells, and
``warehouse_*`` the tables of a stored warehouse, which are built when first
asked for (``plans.stored``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.config import DEFAULT_CONFIG
from liftlens.functions.rounding import round_half_away
from liftlens.operators import (
    Slice, attribute_conversions, checkout_events, control_metrics, experiment_report,
    experiment_snapshot, filter_options, filtered_daily, filtered_summary, metric_cells,
    quality_checks, repeated_exposures, segment_metrics, significance, slice_snapshot, stage_events,
    summary_enriched, variant_metrics, window_checkouts,
)
from liftlens.operators.order import with_position
from liftlens.plans.chain import Tables, build_tables
from liftlens.plans.stored import ndjson_events as stored_ndjson
from liftlens.plans.stored import stored_cells, stored_warehouse
from liftlens.sources.events import driver_events, events_as_text

# The slice every slice query asks for.
SLICE_EXPERIMENT = "exp_1"
SLICE_COUNTRIES = ("IN", "US", "DE")
SLICE_DEVICES = ("mobile", "desktop")
NO_DATA_COUNTRIES = ("ZZ",)
WHOLE = Slice(SLICE_EXPERIMENT)
PART = Slice(SLICE_EXPERIMENT, SLICE_COUNTRIES, SLICE_DEVICES)

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str, lookback_days: int | None = None) -> Tables:
    return build_tables(driver_events(spark, sf_dir), DEFAULT_CONFIG, lookback_days,
                        lambda *names: driver_events(spark, sf_dir, *names))


def staged_events(spark, sf_dir):
    return _tables(spark, sf_dir).staged


def ndjson_events(spark, sf_dir):
    return stage_events(events_as_text(_tables(spark, sf_dir).staged))


def first_exposures_q(spark, sf_dir):
    return _tables(spark, sf_dir).exposures


def checkout_events_q(spark, sf_dir):
    return checkout_events(_tables(spark, sf_dir).checkouts_staged)


def window_checkouts_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return window_checkouts(t.exposures, t.checkouts_staged)


def conversions_subcent(spark, sf_dir):
    """Attribution of revenue with fractions of a cent."""
    t = _tables(spark, sf_dir)
    staged = t.measured_staged.withColumn("revenue", F.expr("round(revenue * 1.005D, 3)"))
    return attribute_conversions(t.exposures, staged, with_exposure_events=True)


def conversions_7d(spark, sf_dir):
    return _tables(spark, sf_dir, 7).conversions


def conversions_1d(spark, sf_dir):
    return _tables(spark, sf_dir, 1).conversions


def daily_metrics_q(spark, sf_dir):
    return _tables(spark, sf_dir).daily


def variant_metrics_q(spark, sf_dir):
    return variant_metrics(_tables(spark, sf_dir).conversions)


def control_metrics_q(spark, sf_dir):
    return control_metrics(variant_metrics(_tables(spark, sf_dir).conversions))


def summary_metrics_q(spark, sf_dir):
    return _tables(spark, sf_dir).summary


def significance_q(spark, sf_dir):
    return significance(_tables(spark, sf_dir).summary)


def summary_enriched_q(spark, sf_dir):
    return summary_enriched(_tables(spark, sf_dir).summary)


def experiment_report_q(spark, sf_dir):
    return experiment_report(_tables(spark, sf_dir).summary, DEFAULT_CONFIG.lookback_days)


def experiment_snapshot_q(spark, sf_dir):
    return experiment_snapshot(_tables(spark, sf_dir).summary)


def metric_cells_q(spark, sf_dir):
    """The cells, revenue as a double (one sum of exact cents each)."""
    cells = metric_cells(_tables(spark, sf_dir).conversions)
    return cells.withColumn("revenue", F.col("revenue").cast("double"))


def filter_options_q(spark, sf_dir):
    return filter_options(stored_cells(spark, sf_dir))


def filtered_summary_all(spark, sf_dir):
    return filtered_summary(stored_cells(spark, sf_dir), WHOLE)


def filtered_summary_slice(spark, sf_dir):
    return filtered_summary(stored_cells(spark, sf_dir), PART)


def filtered_daily_all(spark, sf_dir):
    return filtered_daily(stored_cells(spark, sf_dir), WHOLE)


def filtered_daily_slice(spark, sf_dir):
    return filtered_daily(stored_cells(spark, sf_dir), PART)


def segment_country(spark, sf_dir):
    return segment_metrics(stored_cells(spark, sf_dir), "country", WHOLE)


def segment_device(spark, sf_dir):
    return segment_metrics(stored_cells(spark, sf_dir), "device_type", WHOLE)


def segment_country_slice(spark, sf_dir):
    return segment_metrics(stored_cells(spark, sf_dir), "country", PART)


def experiment_snapshot_slice(spark, sf_dir):
    return slice_snapshot(filtered_summary_slice(spark, sf_dir), SLICE_EXPERIMENT)


def snapshot_no_data(spark, sf_dir):
    nothing = Slice(SLICE_EXPERIMENT, NO_DATA_COUNTRIES)
    return slice_snapshot(filtered_summary(stored_cells(spark, sf_dir), nothing), SLICE_EXPERIMENT)


def daily_ordered(spark, sf_dir):
    return with_position(_tables(spark, sf_dir).daily, ["experiment_key", "exposure_date", "variant"])


def summary_ordered(spark, sf_dir):
    return with_position(_tables(spark, sf_dir).summary, ["experiment_key", "variant"])


def segment_ordered(spark, sf_dir):
    return with_position(segment_country(spark, sf_dir), ["segment", "variant"])


def ndjson_file(spark, sf_dir):
    return stage_events(stored_ndjson(spark, sf_dir))


def warehouse_staged(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).staged


def warehouse_conversions(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).conversions


def warehouse_summary(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).summary


def warehouse_slice(spark, sf_dir):
    return filtered_summary(stored_warehouse(spark, sf_dir).cells, PART)


def warehouse_quality(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    return quality_checks(stored.staged, stored.exposures, stored.summary)


def quality_checks_q(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return quality_checks(t.staged, t.exposures, t.summary)


def duplicate_exposures(spark, sf_dir):
    return repeated_exposures(_tables(spark, sf_dir).staged)


def rounding_check(spark, sf_dir):
    """Half-away decimal rounding of doubles at 2 and 4 places."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    third = F.col("value") / F.lit(3.0)
    scaled = F.col("value") * F.lit(1.005)
    return ev.select(
        "event_id", "value",
        round_half_away(third, 2).alias("third_2dp"),
        round_half_away(third, 4).alias("third_4dp"),
        round_half_away(scaled, 2).alias("scaled_2dp"),
        round_half_away(scaled, 4).alias("scaled_4dp"),
    )


QUERIES: dict[str, Query] = {
    "staged_events": staged_events,
    "ndjson_events": ndjson_events,
    "first_exposures": first_exposures_q,
    "checkout_events": checkout_events_q,
    "window_checkouts": window_checkouts_q,
    "conversions_subcent": conversions_subcent,
    "conversions_7d": conversions_7d,
    "conversions_1d": conversions_1d,
    "daily_metrics": daily_metrics_q,
    "variant_metrics": variant_metrics_q,
    "control_metrics": control_metrics_q,
    "summary_metrics": summary_metrics_q,
    "significance": significance_q,
    "summary_enriched": summary_enriched_q,
    "experiment_report": experiment_report_q,
    "experiment_snapshot": experiment_snapshot_q,
    "metric_cells": metric_cells_q,
    "filter_options": filter_options_q,
    "filtered_summary_all": filtered_summary_all,
    "filtered_summary_slice": filtered_summary_slice,
    "filtered_daily_all": filtered_daily_all,
    "filtered_daily_slice": filtered_daily_slice,
    "segment_country": segment_country,
    "segment_device": segment_device,
    "segment_country_slice": segment_country_slice,
    "experiment_snapshot_slice": experiment_snapshot_slice,
    "snapshot_no_data": snapshot_no_data,
    "daily_ordered": daily_ordered,
    "summary_ordered": summary_ordered,
    "segment_ordered": segment_ordered,
    "ndjson_file": ndjson_file,
    "warehouse_staged": warehouse_staged,
    "warehouse_conversions": warehouse_conversions,
    "warehouse_summary": warehouse_summary,
    "warehouse_slice": warehouse_slice,
    "warehouse_quality": warehouse_quality,
    "quality_checks": quality_checks_q,
    "duplicate_exposures": duplicate_exposures,
    "rounding_check": rounding_check,
}
