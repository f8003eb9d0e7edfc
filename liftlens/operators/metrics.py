"""Daily, per-variant and summary metrics over attributed conversions.

All metric definitions live in ``_AGGREGATES`` / ``metric_exprs`` and are
shared by the warehouse tables and the slice/segment operators: exposed users
(rows), converters (rows with a conversion time), conversion rate (4 dp),
total revenue and revenue per user (2 dp). Rates and per-user revenue are
computed from the aggregated counts, so one partial + final aggregate does it
all. Expressions are SQL text: one driver call per projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.functions.rounding import exact_sum_sql
from liftlens.functions.rounding import round_half_away_sql as rha
from liftlens.schema import CONTROL

METRIC_NAMES = ("exposed_users", "converters", "conversion_rate",
                "total_revenue", "revenue_per_user")
LIFT_NAMES = ("absolute_lift", "relative_lift_pct", "rpu_lift")

# Revenue is summed exactly, as DECIMAL, and turned into a double once. A double
# SUM depends on the order rows arrive in, i.e. on partitioning, and that last bit
# decides the 2-dp rounding of revenue per user at exact ties (324.36 / 8 = 40.545).
# Attributed revenue is summed the same way, so no metric depends on the plan.
_AGGREGATES = (
    "count(1) AS _n",
    "count(conversion_ts) AS _conv",
    f"{exact_sum_sql('revenue')} AS _rev",
)


def metric_exprs(include_total: bool = True) -> list[str]:
    """SQL text of the metrics, from the sums _n, _conv and _rev."""
    exprs = [
        "_n AS exposed_users",
        "_conv AS converters",
        f"{rha('try_divide(CAST(_conv AS DOUBLE), CAST(_n AS DOUBLE))', 4)} AS conversion_rate",
    ]
    if include_total:
        exprs.append(f"{rha('_rev', 2)} AS total_revenue")
    exprs.append(f"{rha('try_divide(_rev, CAST(_n AS DOUBLE))', 2)} AS revenue_per_user")
    return exprs


def grouped_metrics(conversions: DataFrame, keys: list[str],
                    include_total: bool = True) -> DataFrame:
    """The shared metric set, one row per group of ``keys`` (column names)."""
    agg = conversions.groupBy(*keys).agg(*[F.expr(a) for a in _AGGREGATES])
    return agg.selectExpr(*[f"`{k}`" for k in keys], *metric_exprs(include_total))


def daily_metrics(conversions: DataFrame) -> DataFrame:
    """Metrics by (experiment_key, exposure_date, variant)."""
    dated = conversions.withColumn("exposure_date", F.to_date("exposure_ts"))
    return grouped_metrics(dated, ["experiment_key", "exposure_date", "variant"])


def variant_metrics(conversions: DataFrame) -> DataFrame:
    """Metrics by (experiment_key, variant)."""
    return grouped_metrics(conversions, ["experiment_key", "variant"])


def control_metrics(variants: DataFrame) -> DataFrame:
    """The control arm's rate and revenue per user, one row per experiment."""
    return (variants.where(F.col("variant") == F.lit(CONTROL))
            .selectExpr("experiment_key",
                        "conversion_rate AS control_conversion_rate",
                        "revenue_per_user AS control_revenue_per_user"))


def lift_exprs(rate: str, rpu: str, control_rate: str, control_rpu: str) -> list[str]:
    """Lifts against control, computed from the already rounded metrics.

    Relative lift is NULL when the control rate is 0; all three are NULL
    when there is no control arm.
    """
    relative = (f"CASE WHEN {control_rate} = 0.0D THEN CAST(NULL AS DOUBLE) "
                f"ELSE (try_divide({rate}, {control_rate}) - 1.0D) * 100.0D END")
    return [
        f"{rha(f'{rate} - {control_rate}', 4)} AS absolute_lift",
        f"{rha(relative, 2)} AS relative_lift_pct",
        f"{rha(f'{rpu} - {control_rpu}', 2)} AS rpu_lift",
    ]


def with_lifts(variants: DataFrame, partition: list[str]) -> DataFrame:
    """Add lifts against the control row of the same ``partition``.

    The control values are read with a windowed conditional max rather than
    a self-join: the input is already aggregated (one row per variant), and
    at most one control row exists per partition.
    """
    over = (f"OVER (PARTITION BY {', '.join(f'`{p}`' for p in partition)})"
            if partition else "OVER ()")
    control = f"'{CONTROL}'"
    with_control = variants.selectExpr(
        "*",
        f"max(CASE WHEN variant = {control} THEN conversion_rate END) {over} AS _c_rate",
        f"max(CASE WHEN variant = {control} THEN revenue_per_user END) {over} AS _c_rpu")
    cols = [f"`{c}`" for c in variants.columns]
    return with_control.selectExpr(*cols, *lift_exprs(
        "conversion_rate", "revenue_per_user", "_c_rate", "_c_rpu"))


def summary_metrics(conversions: DataFrame) -> DataFrame:
    """Per-variant metrics with absolute, relative and revenue lift vs control."""
    return with_lifts(variant_metrics(conversions), ["experiment_key"])
