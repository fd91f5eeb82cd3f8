"""Tail probabilities, as Arrow-batched functions (no library of them is at hand)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz's continued fraction for the incomplete beta function."""
    tiny, c = 1e-300, 1.0
    d = 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def two_sided_t(t: float | None, df: float | None) -> float | None:
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return None
    return 0.0 if math.isinf(t) else incomplete_beta(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of a t statistic; null where either is missing or no freedom is left."""
    return pd.Series([two_sided_t(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b)) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def norm_pvalue(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal statistic."""
    return pd.Series([None if pd.isna(a) else math.erfc(abs(float(a)) / math.sqrt(2)) for a in z], dtype="float64")
