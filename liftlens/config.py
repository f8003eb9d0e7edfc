"""Run settings and session helpers."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from liftlens.sources.store import remove, remove_at_exit


@dataclass(frozen=True)
class ExperimentConfig:
    """Parameters of one measurement run.

    ``lookback_days``: checkouts count for an exposure when
    ``exposure_ts <= checkout_ts < exposure_ts + lookback_days``.
    """

    lookback_days: int = 7

    def __post_init__(self) -> None:
        if self.lookback_days < 0:
            raise ValueError("lookback_days must be >= 0")


DEFAULT_CONFIG = ExperimentConfig()


def build_session(master: str | None = None, cores: int | None = None,
                  app_name: str = "liftlens") -> SparkSession:
    """Session used by tests and the bench (local mode).

    On a cluster the caller's own session is used instead; nothing in the
    operators depends on these settings except that AQE is expected to be on.
    """
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        # Constraint propagation re-derives IsNotNull filters through every
        # aliased CASE expression and costs 0.1-0.3 s of optimizer time per
        # query here; the operators state their null filters explicitly.
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LIFTLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests, local runs) is
    ``fallback`` installed as the checkpoint directory.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if fallback is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; pass a shared fallback folder")
        spark.sparkContext.setCheckpointDir(fallback)
        spark.conf.set("spark.checkpoint.dir", fallback)
        configured = fallback
    return configured


def materialize(df: DataFrame, name: str, base_dir: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under the shared checkpoint folder; (the table read back, its path).

    This cuts lineage: a lost executor re-reads the written table instead of
    recomputing the whole upstream plan. ``discard`` removes the folder.
    """
    spark = df.sparkSession
    base = base_dir or checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``materialize`` wrote."""
    remove(spark, path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends.

    In the folder of ``spark.checkpoint.dir``, or that of the warehouse where it is unset.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir"))
    path = f"{base.rstrip('/')}/liftlens-{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path
