"""Attribution of checkouts to exposures inside a lookback window.

An exposure converts when the user completes a checkout at a time ``t`` with
``exposure_ts <= t < exposure_ts + lookback``. The conversion time is the
earliest such checkout; revenue sums all of them (NULL revenue counts as 0,
the checkout still converts). One checkout can convert the same user in
several experiments.

Plan (one pass, four exchanges counting that of the exposures):

1. Time is cut into bins of ``lookback`` days. A window of that length lies in
   two bins, so an exposure is listed under both and a checkout under its own.
   The join key is (user, bin): an exposure meets the checkouts of two bins,
   not a user's whole history, and a heavy user is spread over bins.
2. An inner sort-merge join on (user, bin) with the window as residual
   condition. Beside the checkouts its other side holds *anchors*: the exposure
   events, without revenue. Every exposure meets its own event there (the one
   of its time), so those without a checkout come out of the inner join too,
   and nothing has to be joined back. It needs nothing of a key together afterwards, so
   adaptive execution can split either side of a key that is still too large.
3. One aggregate per exposure, combined on the map side. Anchors carry NULLs,
   which MIN and SUM pass over, so how many of them an exposure meets is of no
   consequence.

Revenue is summed as DECIMAL, turned into a double once and rounded once, so
it does not depend on how rows are split or ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.config import DEFAULT_CONFIG, ExperimentConfig
from liftlens.functions.rounding import exact_sum_sql, round_half_away_sql
from liftlens.schema import CHECKOUT_EVENT, EXPOSURE_COLUMNS, EXPOSURE_EVENT

_KEYS = ["experiment_key", "user_id"]


def checkout_events(staged: DataFrame) -> DataFrame:
    """Completed checkouts: user_id, conversion_ts, revenue (NULL -> 0)."""
    return (staged.where(F.col("event_name") == F.lit(CHECKOUT_EVENT))
            .selectExpr("user_id", "event_ts AS conversion_ts",
                        "coalesce(revenue, 0.0D) AS revenue"))


def _bin(ts: str, days: int) -> str:
    return f"CAST(floor(unix_date(CAST({ts} AS DATE)) / {days}) AS INT)"


def _by_bin(exposures: DataFrame, days: int, columns: list[str]) -> DataFrame:
    """Every exposure under both bins that its window touches.

    The key is never NULL: a missing user gets one that no checkout has, a
    missing time the first bin.
    """
    at = _bin("exposure_ts", days)
    return exposures.selectExpr(
        *columns, "coalesce(concat('u', user_id), '') AS _user",
        f"explode(array(coalesce({at}, 0), coalesce({at} + 1, 1))) AS _bin")


def _inside(days: int) -> str:
    return f"_ts >= exposure_ts AND _ts < exposure_ts + make_dt_interval({days})"


def _matches(exposures: DataFrame, checkouts: DataFrame, days: int) -> DataFrame:
    """(exposure key, conversion_ts, revenue) of every checkout inside a window."""
    left = _by_bin(exposures, days, [*_KEYS, "exposure_ts"])
    right = (checkouts.where("conversion_ts IS NOT NULL AND user_id IS NOT NULL")
             .selectExpr("concat('u', user_id) AS _c_user", "conversion_ts AS _ts", "revenue",
                         f"{_bin('conversion_ts', days)} AS _c_bin"))
    window = F.expr(f"_user = _c_user AND _bin = _c_bin AND {_inside(days)}")
    return left.join(right, window).selectExpr(*_KEYS, "_ts AS conversion_ts", "revenue")


def _checkouts_and_anchors(exposures: DataFrame, staged: DataFrame, days: int,
                           with_exposure_events: bool) -> DataFrame:
    """(_checkout, _c_user, _c_bin, _ts, _revenue): checkouts, and anchors of the exposures."""
    checkout = f"event_name = '{CHECKOUT_EVENT}'"
    usable = f"{checkout} AND event_ts IS NOT NULL AND user_id IS NOT NULL"
    anchor = (f"event_name = '{EXPOSURE_EVENT}' AND experiment_key IS NOT NULL "
              "AND variant IS NOT NULL")
    columns = ["coalesce(concat('u', user_id), '') AS _c_user",
               f"coalesce({_bin('event_ts', days)}, 0) AS _c_bin", "event_ts AS _ts"]
    revenue = "coalesce(revenue, 0.0D)"
    if with_exposure_events:
        return staged.where(f"({usable}) OR ({anchor})").selectExpr(
            f"{checkout} AS _checkout", *columns, f"CASE WHEN {checkout} THEN {revenue} END AS _revenue")
    anchors = exposures.selectExpr("user_id", "exposure_ts AS event_ts").selectExpr(
        "false AS _checkout", *columns, "CAST(NULL AS DOUBLE) AS _revenue")
    return staged.where(usable).selectExpr(
        "true AS _checkout", *columns, f"{revenue} AS _revenue").union(anchors)


def attribute_conversions(exposures: DataFrame, staged: DataFrame,
                          lookback_days: int | None = None,
                          config: ExperimentConfig = DEFAULT_CONFIG,
                          with_exposure_events: bool = False) -> DataFrame:
    """One row per exposure: the exposure columns + conversion_ts + revenue.

    ``exposures`` has one row per (experiment_key, user_id). An empty window
    (``lookback_days=0``) converts nobody. ``with_exposure_events`` says that
    ``staged`` holds the exposure events that ``exposures`` were taken from, as
    well as the checkouts: the anchors are then read from it and ``exposures``
    once; otherwise ``exposures`` are read twice (right for a stored table).
    """
    days = int(config.lookback_days if lookback_days is None else lookback_days)
    exposures = exposures.select(*EXPOSURE_COLUMNS)
    if days == 0:
        return exposures.selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS conversion_ts",
                                    "0.0D AS revenue")
    right = _checkouts_and_anchors(exposures, staged, days, with_exposure_events)
    meets = F.expr("_user = _c_user AND _bin = _c_bin "
                   f"AND CASE WHEN _checkout THEN {_inside(days)} ELSE _ts <=> exposure_ts END")
    per_exposure = (_by_bin(exposures, days, EXPOSURE_COLUMNS).join(right, meets)
                    .groupBy(*EXPOSURE_COLUMNS)
                    .agg(F.expr("min(CASE WHEN _checkout THEN _ts END) AS conversion_ts"),
                         F.expr(f"{exact_sum_sql('_revenue')} AS revenue")))
    revenue = round_half_away_sql("coalesce(revenue, 0.0D)", 2)
    return per_exposure.selectExpr(*EXPOSURE_COLUMNS, "conversion_ts", f"{revenue} AS revenue")


def window_checkouts(exposures: DataFrame, staged: DataFrame,
                     lookback_days: int | None = None,
                     config: ExperimentConfig = DEFAULT_CONFIG) -> DataFrame:
    """The exposure-checkout join counted: (experiment_key, user_id) of converted exposures with
    the number of checkouts in their window, the first and the last of them."""
    days = int(config.lookback_days if lookback_days is None else lookback_days)
    if days == 0:
        return exposures.where("false").selectExpr(
            *_KEYS, "0L AS checkouts", "exposure_ts AS first_ts", "exposure_ts AS last_ts")
    return (_matches(exposures.select(*EXPOSURE_COLUMNS), checkout_events(staged), days)
            .groupBy(*_KEYS)
            .agg(F.expr("count(1) AS checkouts"), F.expr("min(conversion_ts) AS first_ts"),
                 F.expr("max(conversion_ts) AS last_ts")))
