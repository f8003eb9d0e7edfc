"""First exposure of each user to each experiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.schema import EXPOSURE_COLUMNS, EXPOSURE_EVENT


def exposure_events(staged: DataFrame) -> DataFrame:
    """Exposure events that name both an experiment and a variant.

    Invalid exposures are dropped *before* ranking, so a later valid
    exposure can still be a user's first.
    """
    return staged.where(
        (F.col("event_name") == F.lit(EXPOSURE_EVENT))
        & F.col("experiment_key").isNotNull()
        & F.col("variant").isNotNull()
    )


def first_exposures(staged: DataFrame) -> DataFrame:
    """One row per (experiment_key, user_id): the earliest valid exposure.

    Order: event time ascending with NULL times last, then event_id, variant,
    country and device as tie-breaks. Country and device come from the chosen row.

    Plan: ``row_number() = 1`` becomes a WindowGroupLimit, which Spark runs
    partially *before* the shuffle (each map task keeps one row per group),
    so a user with millions of exposures ships one row per task, not all.
    """
    w = Window.partitionBy("experiment_key", "user_id").orderBy(
        *[F.col(c).asc_nulls_last()
          for c in ("event_ts", "event_id", "variant", "country", "device_type")])
    return (exposure_events(staged)
            .select(*EXPOSURE_COLUMNS[:-1], "event_ts", "event_id")
            .withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") == 1)
            .select(*EXPOSURE_COLUMNS[:-1], F.col("event_ts").alias("exposure_ts")))


def duplicate_groups(df: DataFrame, keys: Sequence[str], count_name: str = "row_count") -> DataFrame:
    """Groups of ``keys`` that occur more than once (GROUP BY ... HAVING COUNT(*) > 1)."""
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def repeated_exposures(staged: DataFrame) -> DataFrame:
    """Users exposed to an experiment more than once (valid exposure events)."""
    return duplicate_groups(exposure_events(staged), ["experiment_key", "user_id"],
                            "exposure_events")

