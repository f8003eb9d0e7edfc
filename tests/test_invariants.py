"""Invariants that must hold at every scale (checked on sf0.01)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from liftlens.operators import filtered_summary, segment_metrics, variant_metrics
from liftlens.plans.chain import build_tables
from liftlens.sources import driver_events


@pytest.fixture(scope="module")
def t7(spark):
    t = build_tables(driver_events(spark, SF01))
    t.conversions.cache()
    yield t
    t.conversions.unpersist()


def _totals(df):
    r = df.agg(F.sum("exposed_users").alias("n"), F.sum("converters").alias("c")).first()
    return r.n, r.c


def test_one_conversion_row_per_exposure(t7):
    assert t7.conversions.count() == t7.exposures.count() == 442
    assert t7.conversions.select("experiment_key", "user_id").distinct().count() == 442


def test_daily_sums_to_summary(t7):
    assert _totals(t7.daily) == _totals(t7.summary)


def test_segments_sum_to_total(t7):
    for exp in ("exp_0", "exp_1", "exp_2"):
        total = _totals(filtered_summary(t7.conversions, exp))
        for dim in ("country", "device_type"):
            assert _totals(segment_metrics(t7.conversions, dim, exp)) == total


def test_control_lifts_are_zero(t7):
    for r in t7.summary.where(F.col("variant") == "control").collect():
        assert (r.absolute_lift, r.relative_lift_pct, r.rpu_lift) == (0.0, 0.0, 0.0)


def test_shorter_window_converts_subset(spark, t7):
    t1 = build_tables(driver_events(spark, SF01), lookback_days=1)
    c7 = {(r.experiment_key, r.user_id) for r in t7.conversions.where("conversion_ts IS NOT NULL").collect()}
    c1 = {(r.experiment_key, r.user_id) for r in t1.conversions.where("conversion_ts IS NOT NULL").collect()}
    assert c1 <= c7 and len(c1) < len(c7)


def test_converters_bounded(t7):
    assert t7.summary.where("converters > exposed_users").count() == 0
    assert variant_metrics(t7.conversions).where("converters > exposed_users").count() == 0


def test_expected_counts_sf001(t7):
    got = {(r.experiment_key, r.variant): (r.exposed_users, r.converters, r.total_revenue)
           for r in t7.summary.collect()}
    assert got == {
        ("exp_0", "control"): (74, 27, 1605.79), ("exp_0", "treatment"): (74, 39, 2932.99),
        ("exp_1", "control"): (72, 37, 2149.43), ("exp_1", "treatment"): (74, 21, 1032.41),
        ("exp_2", "control"): (73, 26, 1690.74), ("exp_2", "treatment"): (75, 29, 1906.40),
    }
