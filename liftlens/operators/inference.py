"""Significance, enriched summary, experiment report and snapshot.

Everything is computed per experiment from the per-variant summary with
conditional aggregates (or the same expressions over a window partitioned by
experiment), so any number of experiments is handled in one plan and no row
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.config import DEFAULT_CONFIG
from liftlens.functions.rounding import round_half_away_sql as rha
from liftlens.functions.stats import with_two_proportion_test
from liftlens.schema import CONTROL, TREATMENT

# Decision texts of the snapshot.
WINNER_TREATMENT = "Treatment wins"
WINNER_CONTROL = "Control wins"
WINNER_NONE = "Inconclusive"
WINNER_NO_DATA = "No data"
DECISION_TREATMENT = "Treatment outperforms control with statistically significant conversion lift."
DECISION_CONTROL = "Control performs better, so the treatment should not be shipped as-is."
DECISION_NONE = "Treatment is directionally positive, but the result is not yet statistically significant."
DECISION_NO_DATA = "No data matched the selected filters."
SIGNIFICANCE_LEVEL = 0.05

_ARMS = ((CONTROL, "control"), (TREATMENT, "treatment"))


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _arm(variant: str, column: str) -> str:
    return f"max(CASE WHEN variant = {_lit(variant)} THEN `{column}` END)"


def _arm_columns(inputs: list[tuple[str, str]], over: str = "") -> list:
    return [F.expr(f"{_arm(v, column)} {over} AS {label}_{name}")
            for v, label in _ARMS for column, name in inputs]


def _with_test(arms: DataFrame) -> DataFrame:
    return with_two_proportion_test(arms, "control_converters", "control_users",
                                    "treatment_converters", "treatment_users")


def significance(summary: DataFrame) -> DataFrame:
    """Per experiment: the arms' counts and the two-proportion z-test."""
    arms = summary.groupBy("experiment_key").agg(*_arm_columns(
        [("converters", "converters"), ("exposed_users", "users")]))
    return _with_test(arms)


def summary_enriched(summary: DataFrame) -> DataFrame:
    """The summary with its experiment's z_score and p_value on every row.

    Window over experiment_key on top of the summary's own window: same
    partitioning, so no extra exchange and no join.
    """
    over = "OVER (PARTITION BY experiment_key)"
    with_arms = summary.select("*", *_arm_columns(
        [("converters", "_cc"), ("exposed_users", "_cn")], over))
    tested = with_two_proportion_test(with_arms, "control__cc", "control__cn",
                                      "treatment__cc", "treatment__cn")
    return tested.drop("control__cc", "control__cn", "treatment__cc", "treatment__cn")


def experiment_report(summary: DataFrame, lookback_days: int = DEFAULT_CONFIG.lookback_days) -> DataFrame:
    """Report figures per experiment: arm rates, guarded uplift (pp), z, p.

    The uplift is NULL when the control rate is missing or 0.
    """
    arms = summary.groupBy("experiment_key").agg(*_arm_columns(
        [("converters", "converters"), ("exposed_users", "users"), ("conversion_rate", "rate")]))
    uplift = (f"CASE WHEN control_rate IS NOT NULL AND control_rate <> 0.0D "
              f"AND treatment_rate IS NOT NULL "
              f"THEN {rha('(treatment_rate - control_rate) * 100.0D', 2)} END")
    return _with_test(arms).selectExpr(
        "experiment_key", f"{int(lookback_days)} AS lookback_days", "control_rate",
        "treatment_rate", f"{uplift} AS uplift_pp", "z_score", "p_value")


_SNAPSHOT_INPUTS = [("converters", "converters"), ("exposed_users", "users"),
                    ("conversion_rate", "rate"), ("revenue_per_user", "rpu"),
                    ("relative_lift_pct", "relative_lift")]


def _snapshot(arms: DataFrame, key_sql: str) -> DataFrame:
    """Snapshot fields from one row of arm values (see ``experiment_snapshot``)."""
    present = "(control_users IS NOT NULL AND treatment_users IS NOT NULL)"
    uplift = rha("(treatment_rate - control_rate) * 100.0D", 2)
    sig = f"(p_value IS NOT NULL AND p_value < {SIGNIFICANCE_LEVEL!r}D)"

    def choose(win: str, lose: str, neither: str, none: str) -> str:
        return (f"CASE WHEN NOT {present} THEN {_lit(none)} "
                f"WHEN {sig} AND {uplift} > 0 THEN {_lit(win)} "
                f"WHEN {sig} AND {uplift} < 0 THEN {_lit(lose)} ELSE {_lit(neither)} END")

    def when_present(expr: str, name: str) -> str:
        return f"CASE WHEN {present} THEN {expr} END AS {name}"

    return _with_test(arms).selectExpr(
        f"{key_sql} AS experiment_key",
        choose(WINNER_TREATMENT, WINNER_CONTROL, WINNER_NONE, WINNER_NO_DATA) + " AS winner",
        f"CASE WHEN {present} THEN control_users + treatment_users ELSE CAST(0 AS BIGINT) END"
        " AS exposed_users",
        when_present("control_rate", "control_rate"),
        when_present("treatment_rate", "treatment_rate"),
        when_present(uplift, "uplift_pp"),
        when_present(rha("treatment_relative_lift", 2), "relative_lift_pct"),
        when_present("control_rpu", "control_rpu"),
        when_present("treatment_rpu", "treatment_rpu"),
        when_present(rha("treatment_rpu - control_rpu", 2), "rpu_lift"),
        when_present("z_score", "z_score"),
        when_present("p_value", "p_value"),
        choose(DECISION_TREATMENT, DECISION_CONTROL, DECISION_NONE, DECISION_NO_DATA)
        + " AS decision",
    )


def experiment_snapshot(summary: DataFrame) -> DataFrame:
    """Dashboard snapshot, one row per experiment in ``summary``.

    winner / decision: significant (rounded p < 0.05) and uplift > 0 ->
    treatment wins, < 0 -> control wins, otherwise inconclusive; an
    experiment lacking the control or the treatment arm gets "No data".
    Exposed users count control + treatment only.
    """
    arms = summary.groupBy("experiment_key").agg(*_arm_columns(_SNAPSHOT_INPUTS))
    return _snapshot(arms, "experiment_key")


def slice_snapshot(slice_summary: DataFrame, experiment_key: str) -> DataFrame:
    """Snapshot of one experiment's slice summary; always exactly one row.

    A global aggregate yields one row even when the slice matched nothing,
    which then reads "No data".
    """
    arms = slice_summary.agg(*_arm_columns(_SNAPSHOT_INPUTS))
    return _snapshot(arms, _lit(experiment_key))
