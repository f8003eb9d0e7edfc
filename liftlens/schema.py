"""Schemas of the raw, staged and derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw event file: one JSON object per line. Declared up front so the reader
# makes no inference pass and the types cannot drift between files.
RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("experiment_key", T.StringType()),
    T.StructField("variant", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
])

STAGED_TYPES = {f.name: f.dataType for f in RAW_EVENTS.fields}
STAGED_COLUMNS = [f.name for f in RAW_EVENTS.fields]

# The same columns as text: values of a JSON line as they are written.
RAW_TEXT_EVENTS = T.StructType([T.StructField(c, T.StringType()) for c in STAGED_COLUMNS])

# Stored tables, as declared when they are read back.
EXPOSURES = T.StructType([
    *[T.StructField(c, T.StringType())
      for c in ("experiment_key", "user_id", "variant", "country", "device_type")],
    T.StructField("exposure_ts", T.TimestampNTZType()),
])
CONVERSIONS = T.StructType([
    *EXPOSURES.fields,
    T.StructField("conversion_ts", T.TimestampNTZType()),
    T.StructField("revenue", T.DoubleType()),
])
_METRICS = [
    T.StructField("exposed_users", T.LongType()),
    T.StructField("converters", T.LongType()),
    T.StructField("conversion_rate", T.DoubleType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("revenue_per_user", T.DoubleType()),
]
DAILY = T.StructType([
    T.StructField("experiment_key", T.StringType()),
    T.StructField("exposure_date", T.DateType()),
    T.StructField("variant", T.StringType()),
    *_METRICS,
])
SUMMARY = T.StructType([
    T.StructField("experiment_key", T.StringType()),
    T.StructField("variant", T.StringType()),
    *_METRICS,
    *[T.StructField(c, T.DoubleType())
      for c in ("absolute_lift", "relative_lift_pct", "rpu_lift")],
])

CELL_KEYS = ("experiment_key", "exposure_date", "variant", "country", "device_type")
CELLS = T.StructType([
    *[T.StructField(c, T.DateType() if c == "exposure_date" else T.StringType())
      for c in CELL_KEYS],
    T.StructField("exposed_users", T.LongType()),
    T.StructField("converters", T.LongType()),
    T.StructField("revenue", T.DecimalType(38, 18)),
])

EXPOSURE_COLUMNS = EXPOSURES.fieldNames()
CONVERSION_COLUMNS = CONVERSIONS.fieldNames()

# Event names the queries read.
EXPOSURE_EVENT = "experiment_exposure"
CHECKOUT_EVENT = "checkout_completed"
CONTROL = "control"
TREATMENT = "treatment"

# Dimensions a segment breakdown may use.
SEGMENT_DIMENSIONS = ("country", "device_type")
