"""Decimal rounding of doubles.

Spark's ``round(x, n)`` rounds the decimal text of ``x`` (so 1.005 -> 1.01),
while the metric definitions round the *scaled double* half away from zero
(1.005 * 100 = 100.49999999999999 -> 100 -> 1.0). Scaling first and rounding
to an integer reproduces the latter exactly: at scale 0 the decimal text of a
double ends in ``.5`` only when the double is exactly a half.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away_sql(expr: str, digits: int) -> str:
    """SQL text rounding the double ``expr`` to ``digits`` decimals, half away from zero."""
    scale = f"{float(10 ** digits)!r}D"
    return f"(round(({expr}) * {scale}, 0) / {scale})"


def exact_decimal_sum_sql(column: str) -> str:
    """SQL text: the exact sum of a double column, as DECIMAL(38, 18).

    The range of revenue: digits after the 18th decimal place are rounded away,
    and a value or a sum of 1e20 or more fails the job under ANSI rules.
    """
    return f"sum(CAST({column} AS DECIMAL(38, 18)))"


def exact_sum_sql(column: str) -> str:
    """SQL text: the sum of a double column, exact (as DECIMAL), as a double."""
    return f"CAST({exact_decimal_sum_sql(column)} AS DOUBLE)"


def round_half_away(col: Column | str, digits: int) -> Column:
    """Column form of ``round_half_away_sql``; a string is a SQL expression."""
    if isinstance(col, str):
        return F.expr(round_half_away_sql(col, digits))
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)
