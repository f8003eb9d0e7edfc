"""Hand-made edge cases; expected values written by hand (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import checkout, exposure, other, ts
from liftlens.operators import (
    experiment_report, experiment_snapshot, filter_options, filtered_summary,
    quality_checks, segment_metrics, slice_snapshot,
)
from liftlens.operators.quality import DataQualityError, raise_on_failure
from liftlens.plans.chain import build_tables


def tables(raw_df, lookback=7):
    return build_tables(raw_df, lookback_days=lookback)


def conv_rows(t):
    return {(r.experiment_key, r.user_id): r for r in t.conversions.collect()}


def test_window_edges(raw):
    rows = [
        exposure("e1", "u1", "x", "control", ts()),
        checkout("c0", "u1", ts(micros=-1), 1.0),
        checkout("c1", "u1", ts(), 2.0),
        checkout("c2", "u1", ts(days=7, micros=-1), 4.0),
        checkout("c3", "u1", ts(days=7), 8.0),
    ]
    r = conv_rows(tables(raw(rows)))[("x", "u1")]
    assert r.conversion_ts == ts()
    assert r.revenue == 6.0


def test_lookback_parameter(raw):
    rows = [exposure("e1", "u1", "x", "control", ts()),
            checkout("c1", "u1", ts(days=2), 3.0)]
    assert conv_rows(tables(raw(rows), 1))[("x", "u1")].conversion_ts is None
    assert conv_rows(tables(raw(rows), 3))[("x", "u1")].conversion_ts == ts(days=2)


def test_null_time_exposure_sorts_last(raw):
    rows = [exposure("a", "u1", "x", "control", None),
            exposure("b", "u1", "x", "treatment", ts(hours=5))]
    [r] = tables(raw(rows)).exposures.collect()
    assert r.variant == "treatment" and r.exposure_ts == ts(hours=5)


def test_tied_exposures_break_on_event_id(raw):
    rows = [exposure("b", "u1", "x", "treatment", ts()),
            exposure("a", "u1", "x", "control", ts())]
    [r] = tables(raw(rows)).exposures.collect()
    assert r.variant == "control"


def test_null_variant_dropped_before_ranking(raw):
    rows = [exposure("a", "u1", "x", None, ts()),
            exposure("b", "u1", None, "control", ts(hours=1)),
            exposure("c", "u1", "x", "treatment", ts(hours=2))]
    [r] = tables(raw(rows)).exposures.collect()
    assert r.variant == "treatment" and r.exposure_ts == ts(hours=2)


def test_moved_user_keeps_first_attributes(raw):
    rows = [exposure("a", "u1", "x", "control", ts(), "IN", "mobile"),
            exposure("b", "u1", "x", "control", ts(days=1), "US", "desktop")]
    [r] = tables(raw(rows)).exposures.collect()
    assert (r.country, r.device_type) == ("IN", "mobile")


def test_one_checkout_counts_in_two_experiments(raw):
    rows = [exposure("a", "u1", "x", "control", ts()),
            exposure("b", "u1", "y", "treatment", ts(hours=1)),
            checkout("c", "u1", ts(hours=3), 10.0)]
    conv = conv_rows(tables(raw(rows)))
    assert conv[("x", "u1")].revenue == 10.0 and conv[("y", "u1")].revenue == 10.0


def test_null_revenue_still_converts(raw):
    rows = [exposure("a", "u1", "x", "control", ts()),
            checkout("c", "u1", ts(hours=3), None)]
    r = conv_rows(tables(raw(rows)))[("x", "u1")]
    assert r.conversion_ts == ts(hours=3) and r.revenue == 0.0


def test_null_user(raw):
    rows = [exposure("a", None, "x", "control", ts()),
            checkout("c", None, ts(hours=3), 5.0)]
    t = tables(raw(rows))
    [r] = t.conversions.collect()
    assert r.user_id is None and r.conversion_ts is None and r.revenue == 0.0


def test_round_tie(raw):
    rows = [exposure("a", "u1", "x", "control", ts()),
            checkout("c", "u1", ts(hours=3), 1.005)]
    t = tables(raw(rows))
    assert conv_rows(t)[("x", "u1")].revenue == 1.0


def _two_arm_rows(control_conv, control_n, treat_conv, treat_n, extra_variant=None):
    rows, n = [], 0
    for variant, conv, total in (("control", control_conv, control_n),
                                 ("treatment", treat_conv, treat_n)):
        for i in range(total):
            n += 1
            u = f"{variant[0]}{i}"
            rows.append(exposure(f"e{n}", u, "x", variant, ts(hours=i % 24)))
            if i < conv:
                rows.append(checkout(f"k{n}", u, ts(days=1, hours=i % 24), 10.0))
    if extra_variant:
        for i in range(3):
            n += 1
            rows.append(exposure(f"e{n}", f"o{i}", "x", extra_variant, ts()))
    return rows


def test_no_control(raw):
    rows = _two_arm_rows(0, 0, 2, 4)
    t = tables(raw(rows))
    [s] = t.summary.collect()
    assert s.variant == "treatment"
    assert s.absolute_lift is None and s.relative_lift_pct is None and s.rpu_lift is None
    [snap] = experiment_snapshot(t.summary).collect()
    assert snap.winner == "No data" and snap.exposed_users == 0 and snap.z_score is None
    assert snap.decision == "No data matched the selected filters."


def test_zero_control_rate(raw):
    t = tables(raw(_two_arm_rows(0, 5, 3, 5)))
    s = {r.variant: r for r in t.summary.collect()}
    assert s["treatment"].relative_lift_pct is None
    assert s["treatment"].absolute_lift == 0.6
    [rep] = experiment_report(t.summary).collect()
    assert rep.uplift_pp is None and rep.control_rate == 0.0
    [snap] = experiment_snapshot(t.summary).collect()
    assert snap.uplift_pp == 60.0 and snap.relative_lift_pct is None


@pytest.mark.parametrize("conv", [0, 4])
def test_all_or_none_convert(raw, conv):
    t = tables(raw(_two_arm_rows(conv, 4, conv, 4)))
    [snap] = experiment_snapshot(t.summary).collect()
    assert snap.z_score is None and snap.p_value is None
    assert snap.winner == "Inconclusive"


def test_third_variant(raw):
    t = tables(raw(_two_arm_rows(1, 4, 3, 4, extra_variant="other")))
    s = {r.variant: r for r in t.summary.collect()}
    assert set(s) == {"control", "treatment", "other"}
    assert s["control"].absolute_lift == 0.0 and s["control"].relative_lift_pct == 0.0
    [snap] = experiment_snapshot(t.summary).collect()
    assert snap.exposed_users == 8


def test_snapshot_decisions(raw):
    win = tables(raw(_two_arm_rows(5, 60, 30, 60)))
    [snap] = experiment_snapshot(win.summary).collect()
    assert snap.winner == "Treatment wins" and snap.p_value < 0.05 and snap.uplift_pp > 0
    lose = tables(raw(_two_arm_rows(30, 60, 5, 60)))
    [snap] = experiment_snapshot(lose.summary).collect()
    assert snap.winner == "Control wins"
    assert snap.decision == "Control performs better, so the treatment should not be shipped as-is."


def test_null_country_filters(raw):
    rows = [exposure("a", "u1", "x", "control", ts(), None, "mobile"),
            exposure("b", "u2", "x", "treatment", ts(), "IN", "mobile")]
    conv = tables(raw(rows)).conversions
    assert filtered_summary(conv, "x").agg(F.sum("exposed_users")).first()[0] == 2
    assert filtered_summary(conv, "x", ["IN"]).agg(F.sum("exposed_users")).first()[0] == 1
    assert filtered_summary(conv, "x", [], ["mobile"]).agg(F.sum("exposed_users")).first()[0] == 2
    opts = [(r.dimension, r.value) for r in filter_options(conv).collect()]
    assert opts == [("country", "IN"), ("country", None), ("device_type", "mobile")]


def test_empty_staging(raw):
    t = tables(raw([]))
    checks = {r.check_name: r for r in quality_checks(t.staged, t.exposures, t.summary).collect()}
    failed = {k for k, r in checks.items() if not r.passed}
    assert failed == {"staging_not_empty", "variants_present"}
    with pytest.raises(DataQualityError, match="stg_events is empty"):
        raise_on_failure(quality_checks(t.staged, t.exposures, t.summary))
    [snap] = slice_snapshot(filtered_summary(t.conversions, "x"), "x").collect()
    assert snap.winner == "No data" and snap.experiment_key == "x"


def test_bad_dimension(raw):
    conv = tables(raw(_two_arm_rows(1, 2, 1, 2))).conversions
    with pytest.raises(ValueError, match="no segments by 'variant'"):
        segment_metrics(conv, "variant", "x")


def test_other_events_ignored(raw):
    rows = [exposure("a", "u1", "x", "control", ts()),
            other("b", "u1", "checkout_started", ts(hours=1)),
            other("c", "u1", "page_view", ts(hours=2))]
    [r] = tables(raw(rows)).conversions.collect()
    assert r.conversion_ts is None


def test_timestamps_are_ntz(raw):
    t = tables(raw([exposure("a", "u1", "x", "control", dt.datetime(2026, 3, 29, 1, 30))]))
    assert dict(t.exposures.dtypes)["exposure_ts"] == "timestamp_ntz"
    assert t.daily.first().exposure_date == dt.date(2026, 3, 29)
