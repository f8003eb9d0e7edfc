"""The five-table chain as lazy DataFrames.

stg_events -> experiment_exposures -> experiment_conversions ->
experiment_metrics_daily / experiment_metrics_summary. Each table is
defined on first use only, and nothing runs until an action; Catalyst sees
the whole chain and prunes what a query does not use.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from liftlens.config import DEFAULT_CONFIG, ExperimentConfig
from liftlens.operators.conversions import attribute_conversions
from liftlens.operators.exposures import first_exposures
from liftlens.operators.metrics import daily_metrics, summary_metrics
from liftlens.operators.staging import stage_events
from liftlens.schema import CHECKOUT_EVENT, EXPOSURE_EVENT


class Tables:
    """``events_named(*names)`` may give the raw events of some names, where a source can read
    these without reading the others; by default all raw events are read and filtered."""

    def __init__(self, raw_events: DataFrame, config: ExperimentConfig = DEFAULT_CONFIG,
                 lookback_days: int | None = None,
                 events_named: Callable[..., DataFrame] | None = None):
        self.raw_events = raw_events
        self.events_named = events_named or (lambda *names: raw_events)
        self.config = config
        self.lookback_days = config.lookback_days if lookback_days is None else lookback_days

    @cached_property
    def staged(self) -> DataFrame:
        return stage_events(self.raw_events)

    @cached_property
    def exposures(self) -> DataFrame:
        return first_exposures(stage_events(self.events_named(EXPOSURE_EVENT)))

    @cached_property
    def checkouts_staged(self) -> DataFrame:
        return stage_events(self.events_named(CHECKOUT_EVENT))

    @cached_property
    def measured_staged(self) -> DataFrame:
        """The staged exposure events and checkouts."""
        return stage_events(self.events_named(EXPOSURE_EVENT, CHECKOUT_EVENT))

    @cached_property
    def conversions(self) -> DataFrame:
        return attribute_conversions(self.exposures, self.measured_staged, self.lookback_days,
                                     self.config, with_exposure_events=True)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_metrics(self.conversions)

    @cached_property
    def summary(self) -> DataFrame:
        return summary_metrics(self.conversions)


def build_tables(raw_events: DataFrame, config: ExperimentConfig = DEFAULT_CONFIG,
                 lookback_days: int | None = None,
                 events_named: Callable[..., DataFrame] | None = None) -> Tables:
    return Tables(raw_events, config, lookback_days, events_named)
