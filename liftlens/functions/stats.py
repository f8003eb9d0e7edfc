"""Two-proportion z-test as Spark SQL expressions.

Neither Spark SQL nor the oracle database ships ``erf``/``erfc``, so the
complementary error function is evaluated with W. J. Cody's rational
Chebyshev approximations ("Rational Chebyshev approximations for the error
function", Math. Comp. 23, 1969), which are accurate to about 1e-14 relative
error -- enough for p-values rounded to 6 decimals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.rounding import round_half_away_sql

# Cody's coefficients, in the order of his published tables.
# |x| <= 0.46875: erf(x) = x * A(x^2) / B(x^2)
_A = (3.16112374387056560, 113.864154151050156, 377.485237685302021,
      3209.37758913846947, 0.185777706184603153)
_B = (23.6012909523441209, 244.024637934444173, 1282.61652607737228,
      2844.23683343917062)
# 0.46875 < x <= 4: erfc(x) = exp(-x^2) * C(x) / D(x)
_C = (0.564188496988670089, 8.88314979438837594, 66.1191906371416295,
      298.635138197400131, 881.952221241769090, 1712.04761263407058,
      2051.07837782607147, 1230.33935479799725, 2.15311535474403846e-8)
_D = (15.7449261107098347, 117.693950891312499, 537.181101862009858,
      1621.38957456669019, 3290.79923573345963, 4362.61909014324716,
      3439.36767414372164, 1230.33935480374942)
# x > 4: erfc(x) = exp(-x^2) / x * (1/sqrt(pi) - z * P(z) / Q(z)), z = 1/x^2
_P = (0.305326634961232344, 0.360344899949804439, 0.125781726111229246,
      0.0160837851487422766, 6.58749161529837803e-4, 0.0163153871373020978)
_Q = (2.56852019228982242, 1.87295284992346725, 0.527905102951428412,
      0.0605183413124413191, 0.00233520497626869185)

_SMALL = 0.46875
_MEDIUM = 4.0
_INV_SQRT_PI = 1.0 / math.sqrt(math.pi)


def _horner(x: str, num: tuple, den: tuple, lead: int) -> tuple[str, str]:
    """SQL text of the Horner recurrences shared by the three ranges.

    Starts from ``num[-1] * x`` / ``x`` and folds in the first ``lead``
    coefficient pairs, returning the unfinished numerator and denominator.
    """
    n, d = f"({num[-1]!r}D * {x})", x
    for i in range(lead):
        n = f"(({n} + {num[i]!r}D) * {x})"
        d = f"(({d} + {den[i]!r}D) * {x})"
    return n, d


def erfc_sql(x: str) -> str:
    """SQL text of the complementary error function of the non-negative double ``x``.

    ``x`` should be a column name (it is repeated many times in the text).
    """
    xsq = f"({x} * {x})"
    n1, d1 = _horner(xsq, _A, _B, 3)
    small = f"(1.0D - {x} * ({n1} + {_A[3]!r}D) / ({d1} + {_B[3]!r}D))"
    n2, d2 = _horner(x, _C, _D, 7)
    medium = f"(exp(-{xsq}) * ({n2} + {_C[7]!r}D) / ({d2} + {_D[7]!r}D))"
    # x > 4 here; try_divide keeps the branch harmless under ANSI mode anyway
    z = f"try_divide(1.0D, {xsq})"
    n3, d3 = _horner(z, _P, _Q, 4)
    r = f"({z} * ({n3} + {_P[4]!r}D) / ({d3} + {_Q[4]!r}D))"
    large = f"try_divide(exp(-{xsq}) * ({_INV_SQRT_PI!r}D - {r}), {x})"
    return (f"CASE WHEN {x} <= {_SMALL!r}D THEN {small} "
            f"WHEN {x} <= {_MEDIUM!r}D THEN {medium} ELSE {large} END")


def erfc(x: str) -> Column:
    """Complementary error function of a non-negative double column (by name)."""
    return F.expr(erfc_sql(x))


def with_two_proportion_test(df: DataFrame, control_converters: str, control_users: str,
                             treatment_converters: str, treatment_users: str,
                             z_name: str = "z_score", p_name: str = "p_value") -> DataFrame:
    """Append the pooled two-sided z-test on raw counts as ``z_name``, ``p_name``.

    z is rounded to 4 decimals and p to 6 (half away from zero). Both are
    NULL when an arm has no users, an arm is missing, or the pooled variance
    is not positive (everyone or no one converted).

    The steps are separate projections over named intermediates: CollapseProject
    keeps a non-trivial expression that is referenced many times (as z is by
    every branch of erfc) in its own projection instead of inlining copies,
    which keeps the generated code small enough for whole-stage codegen.
    """
    cc, cn, tc, tn = (f"CAST({c} AS DOUBLE)" for c in (
        control_converters, control_users, treatment_converters, treatment_users))
    pooled = f"try_divide({cc} + {tc}, {cn} + {tn})"
    variance = (f"{pooled} * (1.0D - {pooled}) * "
                f"(try_divide(1.0D, {cn}) + try_divide(1.0D, {tn}))")
    z = (f"CASE WHEN least({cn}, {tn}) > 0 AND _zt_var > 0 THEN "
         f"try_divide(try_divide({tc}, {tn}) - try_divide({cc}, {cn}), sqrt(_zt_var)) END")
    keep = [f"`{c}`" for c in df.columns if c not in (z_name, p_name)]
    out = df.selectExpr(*keep, f"{variance} AS _zt_var")
    out = out.selectExpr(*keep, f"{z} AS _zt_z")
    out = out.selectExpr(*keep, "_zt_z", f"abs(_zt_z) / {math.sqrt(2.0)!r}D AS _zt_y")
    return out.selectExpr(*keep, f"{round_half_away_sql('_zt_z', 4)} AS `{z_name}`",
                          f"{round_half_away_sql(erfc_sql('_zt_y'), 6)} AS `{p_name}`")
