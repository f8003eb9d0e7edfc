"""Column-level helpers (JVM-side expressions, no UDFs)."""

from liftlens.functions.rounding import round_half_away, round_half_away_sql
from liftlens.functions.stats import erfc, erfc_sql, with_two_proportion_test

__all__ = ["round_half_away", "round_half_away_sql", "erfc", "erfc_sql", "with_two_proportion_test"]
