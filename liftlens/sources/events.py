"""Event sources.

``read_ndjson_events`` is the production source: newline-delimited JSON with a
declared schema. ``driver_events`` maps the benchmark ``events`` table
(event_id, ts, user_id, event_type, value, props) onto the same raw event
schema so every query can run on the shared test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.schema import (
    CHECKOUT_EVENT, EXPOSURE_EVENT, RAW_TEXT_EVENTS, STAGED_COLUMNS,
)

# Text layout of timestamps written to JSON: ISO date, space, time with
# microseconds. Reading uses Spark's default parser, which accepts this and
# the text without fraction (or with a 'T' separator).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# The mapping from benchmark events to product events.
EVENT_NAME_MAP = {
    "signup": "experiment_exposure",
    "view": "page_view",
    "click": "app_open",
}
COMPLETED_BELOW_K = 20          # purchases with k < 20 are completed checkouts
EXPERIMENT_BELOW_K = 95         # signups with k < 95 carry an experiment key
VARIANT_NULL_FROM_K = 90        # signups with 90 <= k < 95 carry no variant
N_EXPERIMENTS = 3
COUNTRIES = ("IN", "US", "DE", "GB", "CA")
DEVICES = ("mobile", "desktop", "tablet")


def read_ndjson_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan newline-delimited JSON events; every value is read as text.

    Staging casts the text (quoted numbers and zone suffixes included), and a
    value that cannot be cast fails there. FAILFAST makes a malformed line
    fail the read.
    """
    return spark.read.schema(RAW_TEXT_EVENTS).option("mode", "FAILFAST").json(path)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick_sql(index: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN {_sql_str(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def canonical_events(events: DataFrame) -> DataFrame:
    """Benchmark ``events`` rows -> raw product events (one row each).

    Expressed as SQL text in one projection: a single call builds the whole
    mapping (the Column API would take hundreds of driver round trips).
    """
    k = "_k"
    events = events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS _k")
    completed = f"(event_type = 'purchase' AND {k} < {COMPLETED_BELOW_K})"
    renames = " ".join(f"WHEN event_type = {_sql_str(a)} THEN {_sql_str(b)}"
                       for a, b in EVENT_NAME_MAP.items())
    arm = (f"CASE WHEN pmod(user_id + pmod({k}, {N_EXPERIMENTS}), 2) = 0 "
           f"THEN 'control' ELSE 'treatment' END")
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS STRING) AS user_id",
        "concat('session_', CAST(user_id AS STRING)) AS session_id",
        f"CASE WHEN {completed} THEN 'checkout_completed' "
        f"WHEN event_type = 'purchase' THEN 'checkout_started' {renames} "
        f"ELSE event_type END AS event_name",
        "ts AS event_ts",
        f"CASE WHEN event_type = 'signup' AND {k} < {EXPERIMENT_BELOW_K} "
        f"THEN concat('exp_', CAST(pmod({k}, {N_EXPERIMENTS}) AS STRING)) END AS experiment_key",
        f"CASE WHEN event_type = 'signup' AND ({k} < {VARIANT_NULL_FROM_K} "
        f"OR {k} >= {EXPERIMENT_BELOW_K}) THEN {arm} END AS variant",
        f"{_pick_sql(f'pmod(user_id, {len(COUNTRIES)})', COUNTRIES)} AS country",
        f"{_pick_sql(f'pmod(user_id, {len(DEVICES)})', DEVICES)} AS device_type",
        f"CASE WHEN {completed} AND {k} <> 0 THEN value END AS revenue",
    )


# Event types of the benchmark table that can become an event of this name.
_TYPES_OF = {EXPOSURE_EVENT: ("signup", EXPOSURE_EVENT), CHECKOUT_EVENT: ("purchase", CHECKOUT_EVENT)}


def driver_events(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Raw product events derived from ``<sf_dir>/events.parquet``.

    With ``names`` only the rows that can become events of these names: a plain
    predicate on ``event_type``, which the Parquet scan takes.
    """
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if names:
        events = events.where(F.col("event_type").isin(
            *[kind for name in names for kind in _TYPES_OF[name]]))
    return canonical_events(events)


def event_lines(events: DataFrame) -> DataFrame:
    """Each event as a JSON line, column ``value``.

    The lines mix the notations of a product log: every third time has the
    suffix Z, every third an offset of two hours, and every second revenue is
    in quotes.
    """
    n = "pmod(xxhash64(event_id), 6)"
    at = f"date_format(event_ts, '{JSON_TIMESTAMP_FORMAT}')"
    later = f"date_format(event_ts + INTERVAL 2 HOURS, '{JSON_TIMESTAMP_FORMAT}')"
    time = (f"CASE pmod({n}, 3) WHEN 0 THEN {at} "
            f"WHEN 1 THEN concat(replace({at}, ' ', 'T'), 'Z') "
            f"ELSE concat({later}, '+02:00') END")
    quoted = f"to_json(named_struct('revenue', CASE WHEN pmod({n}, 2) = 0 THEN string(revenue) END))"
    plain = f"to_json(named_struct('revenue', CASE WHEN pmod({n}, 2) = 1 THEN revenue END))"
    rest = [c for c in STAGED_COLUMNS if c not in ("event_ts", "revenue")]
    fields = ", ".join(f"'{c}', {c}" for c in rest)
    body = f"to_json(named_struct({fields}, 'event_ts', {time}))"
    money = f"CASE WHEN pmod({n}, 2) = 0 THEN {quoted} ELSE {plain} END"
    line = (f"concat(substring({body}, 1, length({body}) - 1), CASE WHEN revenue IS NULL THEN '' "
            f"ELSE concat(',', substring({money}, 2, length({money}) - 2)) END, '}}')")
    return events.select(F.expr(line).alias("value"))


def events_as_text(events: DataFrame) -> DataFrame:
    """Each event as a JSON line (``event_lines``) parsed back to text columns."""
    parsed = F.from_json("value", RAW_TEXT_EVENTS, {"mode": "FAILFAST"})
    return event_lines(events).select(parsed.alias("e")).select("e.*")
