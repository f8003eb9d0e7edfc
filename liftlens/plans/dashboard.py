"""Everything a dashboard view needs for one slice of an experiment.

All frames are sums over the same additive cells, cut by the same ``Slice``, so
they agree with each other and with the warehouse tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from liftlens.config import discard, materialize
from liftlens.operators.cells import are_cells, metric_cells
from liftlens.operators.inference import slice_snapshot
from liftlens.operators.slices import (
    Slice, filter_options, filtered_daily, filtered_summary, segment_metrics,
)


@dataclass(frozen=True)
class SliceView:
    options: DataFrame
    summary: DataFrame
    daily: DataFrame
    segments: DataFrame
    snapshot: DataFrame


def slice_view(rows: DataFrame, part: Slice, segment_dimension: str = "country") -> SliceView:
    """The frames of a slice; ``rows`` are cells or attributed conversions."""
    summary = filtered_summary(rows, part)
    return SliceView(
        options=filter_options(rows, part.experiment_key),
        summary=summary,
        daily=filtered_daily(rows, part),
        segments=segment_metrics(rows, segment_dimension, part),
        snapshot=slice_snapshot(summary, part.experiment_key),
    )


class DashboardSession:
    """Serves many slices from one table of cells.

    Attributed conversions are rolled up to cells, and these are written once
    under ``spark.checkpoint.dir``: a slice then reads a few rows and no slice
    computes the attribution again; a lost executor re-reads the cells. Cells
    of a warehouse (``open_warehouse(...).cells``) are served as they are.
    ``close`` (or leaving a ``with`` block) removes what was written.
    """

    def __init__(self, rows: DataFrame, experiment_key: str):
        self._copy = None
        if not are_cells(rows):
            rows, self._copy = materialize(metric_cells(rows), "cells")
        self.cells = rows
        self.experiment_key = experiment_key

    def close(self) -> None:
        if self._copy:
            discard(self.cells.sparkSession, self._copy)
            self._copy = None

    def __enter__(self) -> DashboardSession:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()

    def view(self, countries: Iterable[str] | None = None, devices: Iterable[str] | None = None,
             segment_dimension: str = "country") -> SliceView:
        return slice_view(self.cells, Slice.of(self.experiment_key, countries, devices),
                          segment_dimension)
