"""liftlens: controlled-experiment measurement on Spark DataFrames.

Raw product events go in; first exposures, windowed conversion attribution,
daily / per-variant / per-segment metrics, lifts against control, a
two-proportion z-test, a winner decision and data-quality checks come out.
Every operator takes and returns DataFrames and is planned by Catalyst.
"""

from liftlens.config import ExperimentConfig

__all__ = ["ExperimentConfig"]
