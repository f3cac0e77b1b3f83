"""Two-sided p-values of Student's t, for report rows (a handful per report)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c = 1e-300, 1.0
    d = 1.0 / max(abs(1.0 - (a + b) * x / (a + 1.0)), tiny) * (
        1.0 if 1.0 - (a + b) * x / (a + 1.0) >= 0 else -1.0
    )
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float | None:
    if t is None or df is None or math.isnan(t) or math.isnan(df):
        return None
    if math.isinf(t):
        return 0.0
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


@F.pandas_udf(DoubleType())
def _t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t.  Apply to report rows only."""
    return _t_pvalue(t, df)
