"""Stored results that several queries read: cells and warehouses of an input, built once.

A result is kept for the input as it is: the paths, lengths and modification
times of its files. If these change, it is built anew. The folders are in the
session's shared storage and are removed when the driver ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from liftlens.config import scratch_folder
from liftlens.operators.cells import metric_cells
from liftlens.plans.chain import build_tables
from liftlens.plans.job import Warehouse, build_warehouse, open_warehouse
from liftlens.schema import CELLS
from liftlens.sources.events import driver_events, event_lines, read_ndjson_events
from liftlens.sources.store import exists, files_state

#: (application, kind, input folder) -> (state of the input, folder of the result).
_KEPT: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def _kept(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], object]) -> str:
    """The folder of a result, built if there is none for the input as it is."""
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    state = files_state(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    found = _KEPT.get(key)
    if found is None or found[0] != state or not exists(spark, found[1]):
        path = scratch_folder(spark, kind)
        build(path)
        _KEPT[key] = (state, path)
    return _KEPT[key][1]


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the benchmark events, as a stored table."""
    def build(path: str) -> None:
        tables = build_tables(driver_events(spark, sf_dir),
                              events_named=lambda *names: driver_events(spark, sf_dir, *names))
        metric_cells(tables.conversions).write.parquet(path)
    return spark.read.schema(CELLS).parquet(_kept(spark, sf_dir, "cells", build))


def ndjson_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark events, written as NDJSON files and read back (raw columns, as text)."""
    def build(path: str) -> None:
        event_lines(driver_events(spark, sf_dir)).write.text(path)
    return read_ndjson_events(spark, _kept(spark, sf_dir, "ndjson", build))


def stored_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of the benchmark events, built from NDJSON files."""
    def build(path: str) -> None:
        build_warehouse(ndjson_events(spark, sf_dir), path)
    return open_warehouse(spark, _kept(spark, sf_dir, "warehouse", build))
