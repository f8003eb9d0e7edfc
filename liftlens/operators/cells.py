"""Additive cells: the roll-up that every slice is re-aggregated from.

A cell is one (experiment, exposure date, variant, country, device) with the
exposed users, the converters and the exact DECIMAL sum of their revenue. All
three add up, so any selection, segment, day or variant total is a sum over
cells and equals the figure computed from the attributed conversions, to the
last digit. The number of cells depends on the dimensions, not on the users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.functions.rounding import exact_decimal_sum_sql
from liftlens.operators.metrics import metric_exprs
from liftlens.schema import CELL_KEYS, CELLS


def metric_cells(conversions: DataFrame) -> DataFrame:
    """Attributed conversions rolled up to cells (one aggregate, combined on the map side)."""
    return (conversions.withColumn("exposure_date", F.to_date("exposure_ts"))
            .groupBy(*CELL_KEYS)
            .agg(F.expr("count(1) AS exposed_users"), F.expr("count(conversion_ts) AS converters"),
                 F.expr(f"{exact_decimal_sum_sql('revenue')} AS revenue"))
            .select(*CELLS.fieldNames()))


def are_cells(rows: DataFrame) -> bool:
    return set(CELLS.fieldNames()) <= set(rows.columns)


def metrics_of_cells(cells: DataFrame, keys: list[str], include_total: bool = True) -> DataFrame:
    """The shared metric set, one row per group of ``keys`` of the cells."""
    sums = cells.groupBy(*keys).agg(
        F.expr("sum(exposed_users) AS _n"), F.expr("sum(converters) AS _conv"),
        F.expr("CAST(sum(revenue) AS DOUBLE) AS _rev"))
    return sums.selectExpr(*[f"`{k}`" for k in keys], *metric_exprs(include_total))
