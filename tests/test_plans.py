"""Plan shape of every registered query: what must (not) appear at scale."""

from __future__ import annotations

import json

import pytest

from conftest import SF001
from liftlens.plans.catalog import QUERIES


def _plan(spark, name, broadcast=True):
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF001)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_python(spark, name):
    plan = _plan(spark, name, broadcast=False)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    # every window is partitioned (no "move all data to a single partition")
    optimized = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan()
    windows = [n for n in json.loads(optimized.toJSON()) if n["class"].endswith("logical.Window")]
    assert all(n["partitionSpec"] for n in windows), name


def test_conversion_join_plan(spark):
    plan = _plan(spark, "conversions_7d", broadcast=False)
    # first exposure limited per group before the shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the time-binned sort-merge join, its matches combined map-side
    assert "SortMergeJoin" in plan and "_bin" in plan
    assert "partial_sum(cast(_revenue" in plan
    # exposures, both sides of the join, the aggregate
    assert plan.count("Exchange hashpartitioning") == 4
    assert "Subquery" not in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("name", ["conversions_7d", "conversions_1d", "conversions_subcent",
                                  "daily_metrics", "summary_metrics"])
def test_exposures_are_computed_once(spark, name):
    """On a default session: one ranking of the exposures, two scans of the events."""
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == "true"
    plan = _plan(spark, name, broadcast=False)
    assert plan.count("Window [row_number()") == 1
    assert plan.count("FileScan") == 2


def test_exposures_of_a_lazy_slice_are_computed_once(spark):
    from liftlens.operators import filtered_summary, segment_metrics
    from liftlens.plans.chain import build_tables
    from liftlens.sources import driver_events
    t = build_tables(driver_events(spark, SF001))
    for df in (filtered_summary(t.conversions, "exp_1", ["IN"], ["mobile"]),
               segment_metrics(t.conversions, "country", "exp_1")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [row_number()") == 1 and plan.count("FileScan") == 2


@pytest.mark.parametrize("name,kind", [("first_exposures", "signup"),
                                       ("checkout_events", "purchase")])
def test_event_filters_reach_the_scan(spark, name, kind):
    plan = _plan(spark, name)
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "event_type" in pushed and kind in pushed


def test_quality_uses_hash_aggregates(spark):
    assert "ObjectHashAggregate" not in _plan(spark, "quality_checks", broadcast=False)


def test_partitioned_writes_are_rebalanced(spark, tmp_path):
    from liftlens.plans.chain import build_tables
    from liftlens.sources import driver_events
    from liftlens.sources.tables import partition_of
    from pyspark.sql import functions as F
    t = build_tables(driver_events(spark, SF001))
    for df, column in ((t.staged, "event_name"), (t.conversions, "experiment_key")):
        plan = (df.withColumn("part", partition_of(F.col(column))).hint("rebalance", "part")
                ._jdf.queryExecution().executedPlan().toString())
        assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_metrics_partial_aggregation(spark):
    plan = _plan(spark, "summary_metrics", broadcast=False)
    assert "partial_count" in plan and "partial_sum" in plan
