"""Dashboard slices, re-aggregated from additive cells.

A ``Slice`` owns the selection (an experiment, countries, devices) and cuts it
out of a table; the views below are sums over what it cut out. They take
stored cells (``operators.metric_cells``) or attributed conversions, which are
rolled up to cells first, so both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.operators.cells import are_cells, metric_cells, metrics_of_cells
from liftlens.operators.metrics import with_lifts
from liftlens.schema import SEGMENT_DIMENSIONS


@dataclass(frozen=True)
class Slice:
    """One experiment (None: all rows), narrowed to values of its dimensions.

    No values of a dimension mean no filter on it; given values never match a
    NULL. The dimensions are combined with AND.
    """

    experiment_key: str | None = None
    countries: tuple[str, ...] = ()
    devices: tuple[str, ...] = ()

    @classmethod
    def of(cls, part: Slice | str | None, countries: Iterable[str] | None = None,
           devices: Iterable[str] | None = None) -> Slice:
        """``part`` itself if it is a slice, else the slice of that experiment."""
        if isinstance(part, Slice):
            return part
        return cls(part, tuple(countries or ()), tuple(devices or ()))

    def cut(self, rows: DataFrame) -> DataFrame:
        """The rows of this slice; a filter on plain columns, which a scan takes."""
        if self.experiment_key is not None:
            rows = rows.where(F.col("experiment_key") == F.lit(self.experiment_key))
        for column, values in zip(SEGMENT_DIMENSIONS, (self.countries, self.devices)):
            if values:
                rows = rows.where(F.col(column).isin(*values))
        return rows

    def cells(self, rows: DataFrame) -> DataFrame:
        """The cells of this slice, from cells or from attributed conversions."""
        mine = self.cut(rows)
        return mine if are_cells(rows) else metric_cells(mine)


def apply_filters(rows: DataFrame, countries: Iterable[str] | None = None,
                  devices: Iterable[str] | None = None) -> DataFrame:
    """The rows with one of the countries and one of the devices."""
    return Slice.of(None, countries, devices).cut(rows)


def _ordered(metrics: DataFrame, *columns: str) -> DataFrame:
    """The aggregated rows in the order a dashboard shows them, NULL last."""
    return metrics.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def filter_options(rows: DataFrame, part: Slice | str | None = None) -> DataFrame:
    """Distinct values offered by the filters, long form: (dimension, value).

    Both dimensions come out of one scan and one distinct aggregate; rows are
    ordered by dimension, then value with NULL last.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value"))
                      for c in SEGMENT_DIMENSIONS])
    found = Slice.of(part).cut(rows).select(F.inline(pairs)).distinct()
    return _ordered(found, "dimension", "value")


def filtered_summary(rows: DataFrame, part: Slice | str, *selection, **named) -> DataFrame:
    """Per-variant metrics and lifts of a slice of one experiment.

    Variants stay in the result when the slice has no control row (lifts are
    then NULL).
    """
    cells = Slice.of(part, *selection, **named).cells(rows)
    # one experiment: grouping by its key too makes the lift window a partitioned one
    variants = metrics_of_cells(cells, ["experiment_key", "variant"])
    return _ordered(with_lifts(variants, ["experiment_key"]), "variant")


def filtered_daily(rows: DataFrame, part: Slice | str, *selection, **named) -> DataFrame:
    """Daily metrics by (exposure_date, variant) of a slice of one experiment."""
    keys = ["exposure_date", "variant"]
    return _ordered(metrics_of_cells(Slice.of(part, *selection, **named).cells(rows), keys), *keys)


def segment_metrics(rows: DataFrame, dimension: str, part: Slice | str, *selection,
                    **named) -> DataFrame:
    """Metrics by (segment, variant) of a slice, segment being country or device_type."""
    if dimension not in SEGMENT_DIMENSIONS:
        raise ValueError(f"no segments by {dimension!r}; choose from {SEGMENT_DIMENSIONS}")
    cells = Slice.of(part, *selection, **named).cells(rows)
    keys = ["segment", "variant"]
    return _ordered(metrics_of_cells(cells.withColumn("segment", F.col(dimension)), keys,
                                     include_total=False), *keys)
