"""Rounding, erfc and the two-proportion test (the reference's own two cases)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from liftlens.functions import erfc, round_half_away, with_two_proportion_test


def _test(spark, rows):
    df = spark.createDataFrame(rows, "cc long, cn long, tc long, tn long")
    out = with_two_proportion_test(df, "cc", "cn", "tc", "tn").collect()
    return [(r.z_score, r.p_value) for r in out]


def test_reference_case_clear_lift(spark):
    [(z, p)] = _test(spark, [(80, 1000, 125, 1000)])
    assert z is not None and p is not None
    assert z > 0 and p < 0.01
    assert z == 3.3176 and p == 0.000908


def test_reference_snapshot_counts(spark):
    [(z, p)] = _test(spark, [(90, 1000, 130, 1000)])
    assert z == 2.8586 and p == 0.004255


def test_degenerate_inputs_give_null(spark):
    rows = [(0, 0, 5, 10), (5, 10, 0, 0), (0, 10, 0, 10), (10, 10, 10, 10)]
    assert _test(spark, rows) == [(None, None)] * 4


def test_missing_arm_gives_null(spark):
    df = spark.createDataFrame([(None, None, 5, 10)], "cc long, cn long, tc long, tn long")
    r = with_two_proportion_test(df, "cc", "cn", "tc", "tn").first()
    assert r.z_score is None and r.p_value is None


def test_matches_python_math(spark):
    cases = [(27, 74, 39, 74), (37, 72, 21, 74), (26, 73, 29, 75), (338, 741, 336, 740),
             (1, 3, 2, 3), (5, 100000, 9, 100000), (400, 1000, 900, 1000)]
    got = _test(spark, cases)
    for (cc, cn, tc, tn), (z, p) in zip(cases, got):
        p1, p2 = cc / cn, tc / tn
        pooled = (cc + tc) / (cn + tn)
        var = pooled * (1 - pooled) * (1 / cn + 1 / tn)
        zz = (p2 - p1) / math.sqrt(var)
        assert z == pytest.approx(round(zz, 4), abs=1e-12)
        assert p == pytest.approx(round(math.erfc(abs(zz) / math.sqrt(2)), 6), abs=1e-12)


def test_erfc_accuracy(spark):
    xs = spark.range(0, 12000).select((F.col("id") / F.lit(1000.0)).alias("x"))
    rows = xs.select("x", erfc("x").alias("e")).collect()
    worst = 0.0
    for r in rows:
        exact = math.erfc(r.x)
        if exact > 1e-300:
            worst = max(worst, abs(r.e - exact) / exact)
    assert worst < 1e-12


def test_round_half_away_scaled_double(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,), (-0.125,), (None,)], "v double")
    out = [r[0] for r in df.select(round_half_away(F.col("v"), 2)).collect()]
    # 1.005 * 100 = 100.49999999999999 -> 1.0 (not 1.01); 0.125 * 100 = 12.5 -> 0.13
    assert out == [1.0, 2.68, -1.0, 0.13, -0.13, None]


def test_reference_snapshot_operator(spark):
    """The reference's snapshot case: summary rows in, decision out."""
    from liftlens.operators import slice_snapshot
    summary = spark.createDataFrame(
        [("control", 1000, 90, 0.09, 8.2, 0.0), ("treatment", 1000, 130, 0.13, 10.1, 44.44)],
        "variant string, exposed_users long, converters long, conversion_rate double, "
        "revenue_per_user double, relative_lift_pct double")
    [snap] = slice_snapshot(summary, "homepage").collect()
    assert snap.winner == "Treatment wins"
    assert snap.p_value is not None and snap.p_value < 0.05
    assert snap.uplift_pp == 4.0
    assert (snap.z_score, snap.p_value) == (2.8586, 0.004255)
    assert snap.exposed_users == 2000 and snap.rpu_lift == 1.9
    assert snap.relative_lift_pct == 44.44 and snap.experiment_key == "homepage"


def test_significant_but_zero_uplift_is_inconclusive(spark):
    """Rates equal at 4 dp, counts far apart enough for p < 0.05 (N22)."""
    from liftlens.operators import slice_snapshot
    summary = spark.createDataFrame(
        [("control", 2_000_000_000, 1_000_000_000, 0.5, 1.0, 0.0),
         ("treatment", 2_000_000_000, 1_000_080_000, 0.5, 1.0, 0.0)],
        "variant string, exposed_users long, converters long, conversion_rate double, "
        "revenue_per_user double, relative_lift_pct double")
    [snap] = slice_snapshot(summary, "x").collect()
    assert snap.p_value < 0.05 and snap.uplift_pp == 0.0
    assert snap.winner == "Inconclusive"
    assert snap.decision.startswith("Treatment is directionally positive")


def test_config_validation():
    from liftlens.config import ExperimentConfig
    with pytest.raises(ValueError):
        ExperimentConfig(lookback_days=-1)
