"""Stored tables: versioned Parquet warehouse tables, and CSV exports.

A warehouse is a folder. Every write of a table goes to a new folder
``<table>/v-<id>``; the file ``CURRENT`` names the version of each table that
readers use, and is replaced by one rename. A build writes all its tables first
and then switches that file once, so a build that dies, before or between or
during writes, leaves the old tables as they were, and nobody sees a mixture.
The version before the current one stays for readers that have opened it; older
ones, and folders of builds that died, go with the next switch. One build at a
time writes to a warehouse.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.schema import CELLS, CONVERSIONS, DAILY, EXPOSURES, RAW_EVENTS, SUMMARY
from liftlens.sources import store

# The warehouse tables, in build order, with their declared schemas: the
# types of stored values are never inferred.
SCHEMAS = {
    "stg_events": RAW_EVENTS,
    "experiment_exposures": EXPOSURES,
    "experiment_conversions": CONVERSIONS,
    "experiment_metrics_daily": DAILY,
    "experiment_metrics_summary": SUMMARY,
    "experiment_metric_cells": CELLS,
}
WAREHOUSE_TABLES = tuple(SCHEMAS)

# Storage layout: staged events by event name (later steps read two of them),
# conversions by experiment (slices read one). The column itself stays in the
# files; the folder is named by a hash of it, which any key survives: '', '007',
# a date, or a key with '/' and '='.
PARTITIONED_BY = {"stg_events": "event_name", "experiment_conversions": "experiment_key"}
_PARTITION = "part"


_POINTER = "CURRENT"


def _pointer(spark: SparkSession, warehouse_dir: str) -> dict[str, dict[str, str]]:
    """{"tables": {name: folder}, "previous": {name: folder}}, folders within the warehouse."""
    text = store.read_text(spark, f"{warehouse_dir.rstrip('/')}/{_POINTER}")
    return json.loads(text) if text else {"tables": {}, "previous": {}}


def table_path(warehouse_dir: str, name: str) -> str:
    """The folder of a table's versions; a stream appends its files to this folder itself."""
    return f"{warehouse_dir.rstrip('/')}/{name}"


def current_path(spark: SparkSession, warehouse_dir: str, name: str) -> str:
    """The folder of the version that readers use (of a stream's table: its folder)."""
    folder = _pointer(spark, warehouse_dir)["tables"].get(name, name)
    return f"{warehouse_dir.rstrip('/')}/{folder}"


def publish(spark: SparkSession, warehouse_dir: str, written: dict[str, str]) -> None:
    """Make folders the current versions of their tables, in one step; drop old versions."""
    before = _pointer(spark, warehouse_dir)["tables"]
    tables = {**before, **written}
    previous = {name: before[name] for name in written if name in before}
    store.replace_json(spark, f"{warehouse_dir.rstrip('/')}/{_POINTER}",
                       {"tables": tables, "previous": previous})
    keep = {*tables.values(), *previous.values()}
    for name in written:
        for version in store.names(spark, table_path(warehouse_dir, name)):
            if version.startswith("v-") and f"{name}/{version}" not in keep:
                store.remove(spark, f"{table_path(warehouse_dir, name)}/{version}")


class Build:
    """New versions of some tables, published together when the block ends without an error.

        with Build(spark, warehouse_dir) as build:
            build.write(staged, "stg_events")
            build.write(first_exposures(build.read("stg_events")), "experiment_exposures")
    """

    def __init__(self, spark: SparkSession, warehouse_dir: str):
        self.spark, self.warehouse_dir = spark, warehouse_dir.rstrip("/")
        self.written: dict[str, str] = {}

    def __enter__(self) -> Build:
        return self

    def write(self, df: DataFrame, name: str,
              observed: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Store a new version; ``observed`` may add metrics to what is written."""
        folder = f"{name}/v-{uuid.uuid4().hex}"
        _write(df, f"{self.warehouse_dir}/{folder}", name, observed)
        self.written[name] = folder

    def read(self, name: str, only: Sequence[str] | None = None) -> DataFrame:
        """A table of this build, or else its current version."""
        if name not in self.written:
            return read_table(self.spark, self.warehouse_dir, name, only)
        return _read(self.spark, f"{self.warehouse_dir}/{self.written[name]}", name, only)

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            publish(self.spark, self.warehouse_dir, self.written)
        else:
            for folder in self.written.values():
                store.remove(self.spark, f"{self.warehouse_dir}/{folder}")


def partition_of(value: Column) -> Column:
    """Folder name of a partition value (two values may share a folder)."""
    return F.concat(F.lit("p"), F.lower(F.hex(F.xxhash64(value))))


def _write(df: DataFrame, path: str, name: str,
           observed: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write a table's rows to a new folder.

    A partitioned table is rebalanced by its partition first: adaptive
    execution then merges small partitions and splits large ones, so files
    are neither many nor huge. Metrics are observed after that, in the stage
    that writes: a stage that is run again for a lost executor counts nothing twice.
    """
    fields, column = SCHEMAS[name].fieldNames(), PARTITIONED_BY.get(name)
    if column:
        df = df.withColumn(_PARTITION, partition_of(F.col(column))).hint("rebalance", _PARTITION)
        fields = [*fields, _PARTITION]
    writer = (observed(df) if observed else df).select(*fields).write
    if column:
        writer = writer.partitionBy(_PARTITION)
    writer.parquet(path)


def _read(spark: SparkSession, path: str, name: str, only: Sequence[str] | None) -> DataFrame:
    schema, column = SCHEMAS[name], PARTITIONED_BY.get(name)
    stored = T.StructType([*schema.fields, T.StructField(_PARTITION, T.StringType())])
    rows = spark.read.schema(stored if column else schema).parquet(path)
    if only is not None and column:
        keep = F.lit(False)
        for value in only:
            keep |= (F.col(_PARTITION) == partition_of(F.lit(value))) & (F.col(column) == value)
        rows = rows.where(keep)
    return rows.select(*schema.fieldNames())


def write_table(df: DataFrame, warehouse_dir: str, name: str) -> None:
    """Replace one warehouse table whole: readers see the old version or the new one."""
    with Build(df.sparkSession, warehouse_dir) as build:
        build.write(df, name)


def read_table(spark: SparkSession, warehouse_dir: str, name: str,
               only: Sequence[str] | None = None) -> DataFrame:
    """Scan the current version of a warehouse table with its declared schema.

    ``only``: values of the partition column to keep; other folders are not read.
    """
    return _read(spark, current_path(spark, warehouse_dir, name), name, only)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """CSV export in ``order_by`` order (nulls last): part files in ``path``, and one file.

    For the aggregate exports (one row per experiment/day/variant). The global
    sort range-partitions the rows, so part files are written in order and no
    task has to hold the whole table. ``<path>.csv`` has the header once and the
    rows of all parts in order; it appears by a rename, whole.
    """
    ordered = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    ordered.write.mode("overwrite").option("header", True).csv(path)
    head = (",".join(df.columns) + "\n").encode()
    store.join_files(df.sparkSession, head, path, ".csv", f"{path}.csv")
