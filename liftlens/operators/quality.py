"""Data-quality checks over the built tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# Check names and failure messages.
CHECKS = (
    ("staging_not_empty", "stg_events is empty"),
    ("exposures_not_null", "experiment_exposures contains null experiment fields"),
    ("exposures_unique", "duplicate user exposures detected"),
    ("variants_present", "expected both control and treatment variants"),
    ("converters_bounded", "converters exceed exposed users"),
)


class DataQualityError(RuntimeError):
    """Raised when at least one check failed; lists every failure."""


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("observed"))


def _row(observed: DataFrame, index: int, passed: Column) -> DataFrame:
    name, message = CHECKS[index]
    return observed.select(
        F.lit(name).alias("check_name"),
        F.col("observed").cast("long").alias("observed"),
        passed.alias("passed"),
        F.when(~passed, F.lit(message)).alias("failure_message"),
    )


def _exposure_checks(exposures: DataFrame) -> DataFrame:
    """Checks 2-4, one row each.

    Nulls and duplicates come from one count per (experiment, user); variants
    from one count per variant. Both are plain hash aggregates with map-side
    combine, whatever the number of distinct values.
    """
    per_key = exposures.groupBy("experiment_key", "user_id").agg(
        F.expr("count(1) AS _rows"),
        F.expr("count_if(experiment_key IS NULL OR variant IS NULL OR exposure_ts IS NULL)"
               " AS _nulls"))
    totals = per_key.agg(F.expr("coalesce(sum(_nulls), 0) AS null_rows"),
                         F.expr("count_if(_rows > 1) AS duplicate_groups"))
    rows = []
    for index, value in ((1, "null_rows"), (2, "duplicate_groups")):
        name, message = CHECKS[index]
        rows.append(f"named_struct('check_name', '{name}', "
                    f"'observed', CAST({value} AS BIGINT), "
                    f"'passed', {value} = 0, "
                    f"'failure_message', CASE WHEN {value} <> 0 THEN '{message}' END)")
    variants = (exposures.where(F.col("variant").isNotNull())
                .groupBy("variant").agg(F.count(F.lit(1)).alias("_rows")))
    return (totals.selectExpr(f"inline(array({', '.join(rows)}))")
            .unionByName(_row(_count(variants), 3, F.col("observed") >= 2)))


def quality_checks(staged: DataFrame, exposures: DataFrame, summary: DataFrame) -> DataFrame:
    """Five checks, one row each: check_name, observed, passed, failure_message.

    1. staging has rows; 2. no exposure lacks key, variant or time;
    3. no (experiment, user) appears twice; 4. at least two distinct variants
    exist (over all experiments); 5. no variant has more converters than
    exposed users.
    """
    observed = F.col("observed")
    staged_row = _row(_count(staged), 0, observed > 0)
    summary_row = _row(_count(summary.where(F.col("converters") > F.col("exposed_users"))),
                       4, observed == 0)
    return staged_row.unionByName(_exposure_checks(exposures)).unionByName(summary_row)


class ObservedChecks:
    """The five checks, observed on the rows while their tables are written.

    Each method adds metrics to the rows of one write (``DataFrame.observe``);
    ``rows`` is the table of ``quality_checks`` once all writes are done.
    Copies of a key are counted by numbering the written exposures within their
    key: they come out of the ranking partitioned and sorted by it, so that
    adds no exchange. Distinct variants are those of the summary, a few rows,
    numbered within their variant.
    """

    SCHEMA = "check_name string, observed bigint, passed boolean, failure_message string"

    def __init__(self) -> None:
        self._staged = Observation("staged")
        self._exposures = Observation("exposures")
        self._summary = Observation("summary")

    def of_staged(self, staged: DataFrame) -> DataFrame:
        return staged.observe(self._staged, F.count(F.lit(1)).alias("rows"))

    @staticmethod
    def numbered(rows: DataFrame, key: list[str], order: str) -> DataFrame:
        """The rows with ``_copy``, their number within their key."""
        over = Window.partitionBy(*key).orderBy(order)
        return rows.withColumn("_copy", F.row_number().over(over))

    def of_exposures(self, exposures: DataFrame) -> DataFrame:
        lacks = F.expr("experiment_key IS NULL OR variant IS NULL OR exposure_ts IS NULL")
        return exposures.observe(
            self._exposures, F.count_if(lacks).alias("lacking"),
            F.count_if(F.col("_copy") == 2).alias("repeated"))

    def of_summary(self, summary: DataFrame) -> DataFrame:
        return summary.observe(
            self._summary,
            F.count_if(F.col("converters") > F.col("exposed_users")).alias("unbounded"),
            F.count_if((F.col("_copy") == 1) & F.col("variant").isNotNull()).alias("variants"))

    def rows(self, spark: SparkSession) -> DataFrame:
        exposures, summary = self._exposures.get, self._summary.get
        values = (self._staged.get["rows"], exposures["lacking"], exposures["repeated"],
                  summary["variants"], summary["unbounded"])
        passed = (values[0] > 0, values[1] == 0, values[2] == 0, values[3] >= 2, values[4] == 0)
        return spark.createDataFrame(
            [(name, value, ok, None if ok else message)
             for (name, message), value, ok in zip(CHECKS, values, passed)], self.SCHEMA)


def raise_on_failure(checks: DataFrame) -> None:
    """Fail the job when any check failed (reads at most five rows)."""
    failed = checks.where(~F.col("passed")).select("failure_message").collect()
    if failed:
        raise DataQualityError("; ".join(f"FAILED: {r.failure_message}" for r in failed))
