"""Typed staging of raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from liftlens.schema import STAGED_COLUMNS, STAGED_TYPES

# A time of day followed by a zone: Z, UTC or an offset.
_ZONED = "rlike(trim({c}), '[0-9]:[0-9]{{2}}.*(Z|UTC|[+-][0-9]{{1,2}}(:?[0-9]{{2}})?)$')"


def _timestamp_of_text(column: str) -> str:
    """SQL text: a timestamp without zone; text with a zone is converted to UTC."""
    micros = f"unix_micros(CAST(trim({column}) AS TIMESTAMP))"
    utc = ("TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
           f"CAST({micros} AS DECIMAL(20, 0)) / 1000000)")
    return (f"CASE WHEN {_ZONED.format(c=column)} THEN {utc} "
            f"ELSE CAST({column} AS TIMESTAMP_NTZ) END")


def _cast(column: str, is_text: bool) -> str:
    kind = STAGED_TYPES[column]
    quoted = f"`{column}`"
    if isinstance(kind, T.TimestampNTZType) and is_text:
        return _timestamp_of_text(quoted)
    value = f"CAST({quoted} AS {kind.simpleString()})"
    if isinstance(kind, T.DoubleType):
        return (f"CASE WHEN isnan({value}) OR abs({value}) = CAST('Infinity' AS DOUBLE) "
                f"THEN CAST(raise_error('{column} is not finite') AS DOUBLE) ELSE {value} END")
    return value


def stage_events(raw: DataFrame) -> DataFrame:
    """Cast the ten raw columns to their staged types (8 string, 1 timestamp, 1 double).

    Casts are ANSI: a value that cannot be converted fails the job rather
    than becoming NULL, and so does a revenue that is not finite. Raw columns
    may be text: numbers in quotes are cast, times with a zone become UTC.
    """
    text = {f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)}
    return raw.selectExpr(*[f"{_cast(c, c in text)} AS `{c}`" for c in STAGED_COLUMNS])
