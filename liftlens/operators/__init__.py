"""DataFrame-in, DataFrame-out operators of the experiment measurement."""

from liftlens.operators.cells import metric_cells, metrics_of_cells
from liftlens.operators.conversions import (
    attribute_conversions, checkout_events, window_checkouts,
)
from liftlens.operators.exposures import (
    duplicate_groups, exposure_events, first_exposures, repeated_exposures,
)
from liftlens.operators.inference import (
    experiment_report, experiment_snapshot, significance, slice_snapshot, summary_enriched,
)
from liftlens.operators.metrics import (
    control_metrics, daily_metrics, grouped_metrics, summary_metrics, variant_metrics,
)
from liftlens.operators.quality import DataQualityError, quality_checks, raise_on_failure
from liftlens.operators.slices import (
    Slice, apply_filters, filter_options, filtered_daily, filtered_summary, segment_metrics,
)
from liftlens.operators.staging import stage_events

__all__ = [
    "attribute_conversions", "checkout_events", "window_checkouts",
    "duplicate_groups", "exposure_events", "first_exposures", "repeated_exposures",
    "experiment_report", "experiment_snapshot", "significance", "slice_snapshot",
    "summary_enriched", "control_metrics", "daily_metrics", "grouped_metrics",
    "summary_metrics", "variant_metrics", "DataQualityError", "quality_checks",
    "raise_on_failure", "apply_filters", "filter_options", "filtered_daily",
    "filtered_summary", "segment_metrics", "stage_events", "Slice", "metric_cells",
    "metrics_of_cells",
]
