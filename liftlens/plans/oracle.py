"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written against the raw benchmark views (``events`` ...) so that DuckDB
recomputes everything from scratch. Formulated separately from the Spark
operators (QUALIFY for the first exposure, FILTER aggregates for the arms,
a Simpson-rule integral for erfc) so that agreement means something.
"""

from __future__ import annotations

from liftlens.plans.catalog import (
    NO_DATA_COUNTRIES, SLICE_COUNTRIES, SLICE_DEVICES, SLICE_EXPERIMENT,
)


# ROUND(SUM(revenue), 2) and its relatives, with the sum over DECIMAL so that it is the sum.
REV = "CAST(sum(CAST(revenue AS DECIMAL(38, 6))) AS DOUBLE)"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _against_control(variants: str) -> str:
    """Variant rows beside the control of their experiment, read by a filtered window."""
    return f"""
  SELECT * EXCLUDE (base_rate, base_rpu),
         round(conversion_rate - base_rate, 4) AS absolute_lift,
         round(100 * (conversion_rate / nullif(base_rate, 0) - 1), 2) AS relative_lift_pct,
         round(revenue_per_user - base_rpu, 2) AS rpu_lift
  FROM (
    SELECT *, min(conversion_rate) FILTER (variant = 'control') OVER arm AS base_rate,
           min(revenue_per_user) FILTER (variant = 'control') OVER arm AS base_rpu
    FROM {variants} WINDOW arm AS (PARTITION BY experiment_key)
  )"""


def _chain(lookback_days: int = 7, revenue: str = "revenue") -> str:
    """CTEs: stg_events, experiment_exposures, checkouts, experiment_conversions,
    variant_metrics, experiment_metrics_summary."""
    return f"""
src AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
stg_events AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    CAST(user_id AS VARCHAR) AS user_id,
    'session_' || CAST(user_id AS VARCHAR) AS session_id,
    CASE
      WHEN event_type = 'purchase' AND k < 20 THEN 'checkout_completed'
      WHEN event_type = 'purchase' THEN 'checkout_started'
      WHEN event_type = 'signup' THEN 'experiment_exposure'
      WHEN event_type = 'view' THEN 'page_view'
      WHEN event_type = 'click' THEN 'app_open'
      ELSE event_type
    END AS event_name,
    ts AS event_ts,
    CASE WHEN event_type = 'signup' AND k < 95 THEN 'exp_' || CAST(k % 3 AS VARCHAR) END
      AS experiment_key,
    CASE WHEN event_type = 'signup' AND (k < 90 OR k >= 95)
         THEN CASE WHEN (user_id + k % 3) % 2 = 0 THEN 'control' ELSE 'treatment' END
    END AS variant,
    (['IN', 'US', 'DE', 'GB', 'CA'])[user_id % 5 + 1] AS country,
    (['mobile', 'desktop', 'tablet'])[user_id % 3 + 1] AS device_type,
    CASE WHEN event_type = 'purchase' AND k < 20 AND k <> 0 THEN value END AS revenue
  FROM src
),
experiment_exposures AS (
  SELECT experiment_key, user_id, variant, country, device_type, event_ts AS exposure_ts
  FROM stg_events
  WHERE event_name = 'experiment_exposure'
    AND experiment_key IS NOT NULL AND variant IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY experiment_key, user_id
    ORDER BY event_ts ASC NULLS LAST, event_id ASC NULLS LAST) = 1
),
checkouts AS (
  SELECT user_id, event_ts AS conversion_ts, COALESCE({revenue}, 0.0) AS revenue
  FROM stg_events
  WHERE event_name = 'checkout_completed'
),
experiment_conversions AS (
  SELECT e.experiment_key, e.user_id, e.variant, e.country, e.device_type, e.exposure_ts,
         min(c.conversion_ts) AS conversion_ts,
         round(COALESCE(CAST(sum(CAST(c.revenue AS DECIMAL(38, 6))) AS DOUBLE), 0.0), 2) AS revenue
  FROM experiment_exposures AS e
  LEFT JOIN checkouts AS c
    ON c.user_id = e.user_id
   AND c.conversion_ts >= e.exposure_ts
   AND c.conversion_ts < e.exposure_ts + INTERVAL {int(lookback_days)} DAY
  GROUP BY ALL
),
variant_metrics AS (
  SELECT experiment_key, variant,
         count(*) AS exposed_users,
         count(conversion_ts) AS converters,
         round(count(conversion_ts)::DOUBLE / count(*), 4) AS conversion_rate,
         round({REV}, 2) AS total_revenue,
         round({REV} / count(*), 2) AS revenue_per_user
  FROM experiment_conversions
  GROUP BY experiment_key, variant
),
experiment_metrics_summary AS ({_against_control("variant_metrics")}
)"""


def _with(*extra: str, lookback_days: int = 7, revenue: str = "revenue") -> str:
    parts = [_chain(lookback_days, revenue)] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def _ztest(source: str, name: str) -> str:
    """CTE ``name``: z (unrounded) and p via Simpson's rule over the arms in ``source``.

    erfc(y) = 2/sqrt(pi) * integral_y^(y+8) exp(-t^2) dt, 2000 steps of 0.004.
    """
    return f"""
{name}_z AS (
  SELECT *,
    CASE WHEN least(control_users, treatment_users) > 0 AND variance > 0
         THEN (p2 - p1) / sqrt(variance) END AS z_raw
  FROM (
    SELECT *,
      control_converters::DOUBLE / control_users AS p1,
      treatment_converters::DOUBLE / treatment_users AS p2,
      pooled * (1 - pooled) * ((1 / control_users::DOUBLE) + (1 / treatment_users::DOUBLE))
        AS variance
    FROM (
      SELECT *,
        (control_converters + treatment_converters)::DOUBLE
          / nullif(control_users + treatment_users, 0) AS pooled
      FROM {source}
    )
  )
),
{name}_tail AS (
  SELECT z.test_id,
    2 / sqrt(pi()) * 0.004 / 3 * sum(
      (CASE WHEN s.i = 0 OR s.i = 2000 THEN 1 WHEN s.i % 2 = 1 THEN 4 ELSE 2 END)
      * exp(-pow(abs(z.z_raw) / sqrt(2) + 0.004 * s.i, 2))) AS p_raw
  FROM {name}_z AS z, range(0, 2001) AS s(i)
  WHERE z.z_raw IS NOT NULL
  GROUP BY z.test_id
),
{name} AS (
  SELECT z.*, round(z.z_raw, 4) AS z_score, round(t.p_raw, 6) AS p_value
  FROM {name}_z AS z LEFT JOIN {name}_tail AS t ON t.test_id = z.test_id
)"""


_ARMS = """
arms AS (
  SELECT experiment_key AS test_id, experiment_key,
    max(converters) FILTER (WHERE variant = 'control') AS control_converters,
    max(exposed_users) FILTER (WHERE variant = 'control') AS control_users,
    max(converters) FILTER (WHERE variant = 'treatment') AS treatment_converters,
    max(exposed_users) FILTER (WHERE variant = 'treatment') AS treatment_users,
    max(conversion_rate) FILTER (WHERE variant = 'control') AS control_rate,
    max(conversion_rate) FILTER (WHERE variant = 'treatment') AS treatment_rate,
    max(revenue_per_user) FILTER (WHERE variant = 'control') AS control_rpu,
    max(revenue_per_user) FILTER (WHERE variant = 'treatment') AS treatment_rpu,
    max(relative_lift_pct) FILTER (WHERE variant = 'treatment') AS treatment_relative_lift
  FROM {source}
  {group}
)"""


def _slice_where(countries=None, devices=None) -> str:
    where = [f"experiment_key = '{SLICE_EXPERIMENT}'"]
    if countries:
        where.append(f"country IN ({_in_list(countries)})")
    if devices:
        where.append(f"device_type IN ({_in_list(devices)})")
    return " AND ".join(where)


def _metric_select(keys: str, where: str, include_total: bool = True) -> str:
    """Per-group metrics over experiment_conversions (the slice variant)."""
    total = f"round({REV}, 2) AS total_revenue,\n  " if include_total else ""
    return f"""
SELECT {keys},
  count(*) AS exposed_users,
  count(conversion_ts) AS converters,
  round(count(conversion_ts)::DOUBLE / count(*), 4) AS conversion_rate,
  {total}round({REV} / count(*), 2) AS revenue_per_user
FROM experiment_conversions
WHERE {where}
GROUP BY ALL"""


def _slice_summary(countries=None, devices=None) -> str:
    variants = _metric_select("experiment_key, variant", _slice_where(countries, devices))
    return f"""
slice_variants AS ({variants}
),
slice_summary AS ({_against_control("slice_variants")}
)"""


def _slice_daily(countries=None, devices=None) -> str:
    return _with() + _metric_select("CAST(exposure_ts AS DATE) AS exposure_date, variant",
                                    _slice_where(countries, devices))


def _segments(dimension: str, countries=None, devices=None) -> str:
    return _with() + _metric_select(f"{dimension} AS segment, variant",
                                    _slice_where(countries, devices), include_total=False)


def _snapshot_select(key_expr: str) -> str:
    """Snapshot fields over CTE ``snap`` (arms + z-test)."""
    present = "(control_users IS NOT NULL AND treatment_users IS NOT NULL)"
    uplift = "round((treatment_rate - control_rate) * 100, 2)"
    sig = "(p_value IS NOT NULL AND p_value < 0.05)"
    return f"""
SELECT {key_expr} AS experiment_key,
  CASE WHEN NOT {present} THEN 'No data'
       WHEN {sig} AND {uplift} > 0 THEN 'Treatment wins'
       WHEN {sig} AND {uplift} < 0 THEN 'Control wins'
       ELSE 'Inconclusive' END AS winner,
  CASE WHEN {present} THEN control_users + treatment_users ELSE 0::BIGINT END AS exposed_users,
  CASE WHEN {present} THEN control_rate END AS control_rate,
  CASE WHEN {present} THEN treatment_rate END AS treatment_rate,
  CASE WHEN {present} THEN {uplift} END AS uplift_pp,
  CASE WHEN {present} THEN round(treatment_relative_lift, 2) END AS relative_lift_pct,
  CASE WHEN {present} THEN control_rpu END AS control_rpu,
  CASE WHEN {present} THEN treatment_rpu END AS treatment_rpu,
  CASE WHEN {present} THEN round(treatment_rpu - control_rpu, 2) END AS rpu_lift,
  CASE WHEN {present} THEN z_score END AS z_score,
  CASE WHEN {present} THEN p_value END AS p_value,
  CASE WHEN NOT {present} THEN 'No data matched the selected filters.'
       WHEN {sig} AND {uplift} > 0
         THEN 'Treatment outperforms control with statistically significant conversion lift.'
       WHEN {sig} AND {uplift} < 0
         THEN 'Control performs better, so the treatment should not be shipped as-is.'
       ELSE 'Treatment is directionally positive, but the result is not yet statistically significant.'
  END AS decision
FROM snap"""


def _summary_snapshot(countries=None, devices=None) -> str:
    arms = _ARMS.format(source="slice_summary", group="")
    return (_with(_slice_summary(countries, devices), arms.replace(
        "experiment_key AS test_id, experiment_key,", "1 AS test_id,"), _ztest("arms", "snap"))
        + _snapshot_select(f"'{SLICE_EXPERIMENT}'"))


_QUALITY = """
SELECT 'staging_not_empty' AS check_name, count(*) AS observed, count(*) > 0 AS passed,
  CASE WHEN count(*) = 0 THEN 'stg_events is empty' END AS failure_message
FROM stg_events
UNION ALL
SELECT 'exposures_not_null', count(*), count(*) = 0,
  CASE WHEN count(*) > 0 THEN 'experiment_exposures contains null experiment fields' END
FROM experiment_exposures
WHERE experiment_key IS NULL OR variant IS NULL OR exposure_ts IS NULL
UNION ALL
SELECT 'exposures_unique', count(*), count(*) = 0,
  CASE WHEN count(*) > 0 THEN 'duplicate user exposures detected' END
FROM (SELECT experiment_key, user_id FROM experiment_exposures GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL
SELECT 'variants_present', count(DISTINCT variant), count(DISTINCT variant) >= 2,
  CASE WHEN count(DISTINCT variant) < 2 THEN 'expected both control and treatment variants' END
FROM experiment_exposures
UNION ALL
SELECT 'converters_bounded', count(*), count(*) = 0,
  CASE WHEN count(*) > 0 THEN 'converters exceed exposed users' END
FROM experiment_metrics_summary WHERE converters > exposed_users"""


ORACLE_SQL: dict[str, str] = {
    "staged_events": _with() + "SELECT * FROM stg_events",
    "ndjson_events": _with() + "SELECT * FROM stg_events",
    "first_exposures": _with() + "SELECT * FROM experiment_exposures",
    "checkout_events": _with() + "SELECT * FROM checkouts",
    "window_checkouts": _with() + """
SELECT e.experiment_key, e.user_id, count(*) AS checkouts, min(c.conversion_ts) AS first_ts,
       max(c.conversion_ts) AS last_ts
FROM experiment_exposures AS e
JOIN checkouts AS c
  ON c.user_id = e.user_id
 AND c.conversion_ts >= e.exposure_ts
 AND c.conversion_ts < e.exposure_ts + INTERVAL 7 DAY
GROUP BY ALL""",
    "conversions_subcent": _with(revenue="round(revenue * 1.005, 3)")
    + "SELECT * FROM experiment_conversions",
    "conversions_7d": _with() + "SELECT * FROM experiment_conversions",
    "conversions_1d": _with(lookback_days=1) + "SELECT * FROM experiment_conversions",
    "daily_metrics": _with() + f"""
SELECT experiment_key, CAST(exposure_ts AS DATE) AS exposure_date, variant,
  count(*) AS exposed_users,
  count(conversion_ts) AS converters,
  round(count(conversion_ts)::DOUBLE / count(*), 4) AS conversion_rate,
  round({REV}, 2) AS total_revenue,
  round({REV} / count(*), 2) AS revenue_per_user
FROM experiment_conversions
GROUP BY 1, 2, 3""",
    "variant_metrics": _with() + "SELECT * FROM variant_metrics",
    "control_metrics": _with() + """
SELECT experiment_key, conversion_rate AS control_conversion_rate,
       revenue_per_user AS control_revenue_per_user
FROM variant_metrics WHERE variant = 'control'""",
    "summary_metrics": _with() + "SELECT * FROM experiment_metrics_summary",
    "significance": _with(_ARMS.format(source="experiment_metrics_summary",
                                       group="GROUP BY experiment_key"),
                          _ztest("arms", "sig")) + """
SELECT experiment_key, control_converters, control_users, treatment_converters,
       treatment_users, z_score, p_value
FROM sig""",
    "summary_enriched": _with(_ARMS.format(source="experiment_metrics_summary",
                                           group="GROUP BY experiment_key"),
                              _ztest("arms", "sig")) + """
SELECT s.*, g.z_score, g.p_value
FROM experiment_metrics_summary AS s LEFT JOIN sig AS g USING (experiment_key)""",
    "experiment_report": _with(_ARMS.format(source="experiment_metrics_summary",
                                            group="GROUP BY experiment_key"),
                               _ztest("arms", "sig")) + """
SELECT experiment_key, 7 AS lookback_days, control_rate, treatment_rate,
  CASE WHEN control_rate IS NOT NULL AND control_rate <> 0 AND treatment_rate IS NOT NULL
       THEN round((treatment_rate - control_rate) * 100, 2) END AS uplift_pp,
  z_score, p_value
FROM sig""",
    "experiment_snapshot": _with(_ARMS.format(source="experiment_metrics_summary",
                                              group="GROUP BY experiment_key"),
                                 _ztest("arms", "snap")) + _snapshot_select("experiment_key"),
    "filter_options": _with() + """
SELECT DISTINCT 'country' AS dimension, country AS value FROM experiment_conversions
UNION
SELECT DISTINCT 'device_type' AS dimension, device_type AS value FROM experiment_conversions""",
    "metric_cells": _with() + f"""
SELECT experiment_key, CAST(exposure_ts AS DATE) AS exposure_date, variant, country, device_type,
  count(*) AS exposed_users, count(conversion_ts) AS converters, {REV} AS revenue
FROM experiment_conversions
GROUP BY ALL""",
    "filtered_summary_all": _with(_slice_summary()) + "SELECT * FROM slice_summary",
    "filtered_summary_slice": _with(_slice_summary(SLICE_COUNTRIES, SLICE_DEVICES))
    + "SELECT * FROM slice_summary",
    "filtered_daily_all": _slice_daily(),
    "filtered_daily_slice": _slice_daily(SLICE_COUNTRIES, SLICE_DEVICES),
    "segment_country": _segments("country"),
    "segment_device": _segments("device_type"),
    "segment_country_slice": _segments("country", SLICE_COUNTRIES, SLICE_DEVICES),
    "experiment_snapshot_slice": _summary_snapshot(SLICE_COUNTRIES, SLICE_DEVICES),
    "snapshot_no_data": _summary_snapshot(NO_DATA_COUNTRIES),
    "daily_ordered": _with() + f"""
SELECT *, row_number() OVER (ORDER BY experiment_key ASC NULLS LAST,
                             exposure_date ASC NULLS LAST, variant ASC NULLS LAST) AS position
FROM ({_metric_select("experiment_key, CAST(exposure_ts AS DATE) AS exposure_date, variant",
                      "TRUE")})""",
    "summary_ordered": _with() + """
SELECT *, row_number() OVER (ORDER BY experiment_key ASC NULLS LAST, variant ASC NULLS LAST)
  AS position
FROM experiment_metrics_summary""",
    "segment_ordered": _with() + f"""
SELECT *, row_number() OVER (ORDER BY segment ASC NULLS LAST, variant ASC NULLS LAST) AS position
FROM ({_metric_select("country AS segment, variant", _slice_where(), include_total=False)})""",
    "ndjson_file": _with() + "SELECT * FROM stg_events",
    "warehouse_staged": _with() + "SELECT * FROM stg_events",
    "warehouse_conversions": _with() + "SELECT * FROM experiment_conversions",
    "warehouse_summary": _with() + "SELECT * FROM experiment_metrics_summary",
    "warehouse_slice": _with(_slice_summary(SLICE_COUNTRIES, SLICE_DEVICES))
    + "SELECT * FROM slice_summary",
    "quality_checks": _with() + _QUALITY,
    "warehouse_quality": _with() + _QUALITY,
    "duplicate_exposures": _with() + """
SELECT experiment_key, user_id, count(*) AS exposure_events
FROM stg_events
WHERE event_name = 'experiment_exposure' AND experiment_key IS NOT NULL AND variant IS NOT NULL
GROUP BY 1, 2
HAVING count(*) > 1""",
    "rounding_check": """
SELECT event_id, value,
  round(value / 3.0, 2) AS third_2dp, round(value / 3.0, 4) AS third_4dp,
  round(value * 1.005, 2) AS scaled_2dp, round(value * 1.005, 4) AS scaled_4dp
FROM events""",
}
