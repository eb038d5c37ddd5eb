"""Exact binomial (Clopper-Pearson) interval."""
from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F


def _stirling_rest(x: float) -> float:
    """ln Gamma(x) minus Stirling's main terms, for x >= 10."""
    x2 = x * x
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x2)) / x2) / x2) / x


def _log_front(a: float, b: float, x: float) -> float:
    """ln( x^a (1-x)^b / B(a, b) ), without cancellation for large a and b."""
    if min(a, b) < 10:
        return (
            math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
        )
    n, p = a + b, a / (a + b)
    deviation = a * math.log(x / p) + b * math.log((1 - x) / (1 - p))
    rest = _stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b)
    return deviation + 0.5 * math.log(a * b / n / (2 * math.pi)) + rest


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    m = 0
    while True:
        m += 1
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1) < 1e-15:
            return h


def beta_cdf(a: float, b: float, x: float) -> float:
    """P(X <= x) for X ~ Beta(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(_log_front(a, b, x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def beta_quantile(q: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    while True:
        mid = (low + high) / 2
        if mid <= low or mid >= high or high - low < 1e-16:
            return mid
        if beta_cdf(a, b, mid) < q:
            low = mid
        else:
            high = mid


def interval(successes: float, trials: float, alpha: float) -> tuple[float | None, float | None]:
    """Lower and upper bound; closed forms at the ends, no bound without trials."""
    if pd.isna(successes) or pd.isna(trials):
        return None, None
    if trials <= 0:
        return 0.0, None
    if successes == 0:
        return 0.0, 1 - (alpha / 2) ** (1 / trials)
    if successes == trials:
        return (alpha / 2) ** (1 / trials), 1.0
    return (
        beta_quantile(alpha / 2, successes, trials - successes + 1),
        beta_quantile(1 - alpha / 2, successes + 1, trials - successes),
    )


def clopper_pearson(successes: Column, trials: Column, alpha: float = 0.05) -> Column:
    """struct<pmin, pmax>. Meant for aggregated rows: one evaluation per group, not per record."""
    @F.pandas_udf("struct<pmin:double,pmax:double>")
    def bounds(s: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([interval(a, b, alpha) for a, b in zip(s, n)], columns=["pmin", "pmax"])

    return bounds(successes.cast("double"), trials.cast("double"))
