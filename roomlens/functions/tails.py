"""Tail probabilities of the chi-square, F and t distributions.

Statistics are computed by Spark expressions; only the last step, from one statistic to its
p-value, runs here, on frames of one row.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300


def _lower_gamma_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    n = a
    while abs(term) > abs(total) * _EPS:
        n += 1.0
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def _upper_gamma_fraction(a: float, x: float) -> float:
    """Upper regularised incomplete gamma by its continued fraction (modified Lentz)."""
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = i * (a - i)
        b += 2.0
        d = 1.0 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        step = c * d
        h *= step
        if abs(step - 1.0) < _EPS:
            break
    return h * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_tail(x: float, df: float) -> float:
    """P(X > x) for a chi-square variable with ``df`` degrees of freedom."""
    if math.isnan(x) or math.isnan(df) or df <= 0:
        return math.nan
    if x <= 0:
        return 1.0
    a, half = df / 2.0, x / 2.0
    if half < a + 1.0:
        return 1.0 - _lower_gamma_series(a, half)
    return _upper_gamma_fraction(a, half)


def _beta_fraction(x: float, a: float, b: float) -> float:
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or _TINY)
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        step = 1.0
        for coefficient in (even, odd):
            d = 1.0 / (1.0 + coefficient * d or _TINY)
            c = 1.0 + coefficient / c or _TINY
            step = c * d
            h *= step
        if abs(step - 1.0) < _EPS:
            break
    return h


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1.0 - x, b, a) / b


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(X > f) for an F variable."""
    if math.isnan(f) or not (df1 > 0 and df2 > 0):
        return math.nan
    if f <= 0:
        return 1.0
    return beta_share(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


def t_quantile(p: float, df: float) -> float:
    """Upper quantile of Student's t (``p`` above one half), by bisection of its tail."""
    tail = 1.0 - p

    def upper(t: float) -> float:
        return 0.5 * beta_share(df / (df + t * t), df / 2.0, 0.5)

    low, high = 0.0, 1.0
    while upper(high) > tail:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if upper(mid) > tail:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(float(a), float(b)) for a, b in zip(x, df)])


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([f_tail(float(a), float(b), float(c)) for a, b, c in zip(f, df1, df2)])


@F.pandas_udf(DoubleType())
def tail_p(kind: pd.Series, x: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """p-values of several tests at once: kind ``chi2`` or ``f``; null without a kind or statistic."""

    def one(kind: str | None, x: float, df1: float, df2: float) -> float | None:
        if kind is None or pd.isna(x):
            return None
        return chi2_tail(float(x), float(df1)) if kind == "chi2" else f_tail(float(x), float(df1), float(df2))

    return pd.Series([one(*row) for row in zip(kind, x, df1, df2)], dtype="float64")


def t_quantiles(p: float, most: int) -> list[float]:
    """Quantiles for 1 to ``most`` degrees of freedom."""
    return [t_quantile(p, df) for df in range(1, most + 1)]
