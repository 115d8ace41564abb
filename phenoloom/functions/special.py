"""Special functions behind the p-values.

``digamma`` and ``trigamma`` are plain column expressions. The tail probabilities need an iteration, so they are
vectorised UDFs, applied to one row per feature after aggregation, never to cells.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Coefficients of the asymptotic series (Bernoulli numbers), Abramowitz & Stegun 6.3.18, 6.4.11, 6.1.41.
DIGAMMA_SERIES = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132)
TRIGAMMA_SERIES = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66)
LOG_GAMMA_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
SHIFT = 10


def digamma(x: Column) -> Column:
    """Shift the argument up by recurrence, then use the asymptotic series."""
    y = x + SHIFT
    steps = sum((1.0 / (x + i) for i in range(1, SHIFT)), 1.0 / x)
    tail = sum((F.lit(c) * F.pow(y, F.lit(-2.0 * (i + 1))) for i, c in enumerate(DIGAMMA_SERIES)), F.lit(0.0))
    return F.log(y) - 0.5 / y - tail - steps


def trigamma(x: Column) -> Column:
    y = x + SHIFT
    steps = sum((1.0 / ((x + i) * (x + i)) for i in range(1, SHIFT)), 1.0 / (x * x))
    tail = sum((F.lit(c) * F.pow(y, F.lit(-2.0 * (i + 1) - 1)) for i, c in enumerate(TRIGAMMA_SERIES)), F.lit(0.0))
    return 1.0 / y + 0.5 / (y * y) + tail + steps


def trigamma_inverse(value: float) -> float:
    """Newton on 1/trigamma, which is nearly linear. One scalar per study, so it runs on the driver."""
    if not value > 0:
        return math.inf
    x = 0.5 + 1.0 / value
    for _ in range(60):
        tri, tetra = _polygamma(x)
        step = tri * (1.0 - tri / value) / tetra
        x += step
        if abs(step) < 1e-12 * x:
            break
    return x


def _polygamma(x: float) -> tuple[float, float]:
    """trigamma and its derivative of a scalar."""
    tri = sum(1.0 / (x + i) ** 2 for i in range(SHIFT))
    tetra = sum(-2.0 / (x + i) ** 3 for i in range(SHIFT))
    y = x + SHIFT
    tri += 1 / y + 0.5 / y**2 + sum(c * y ** (-2 * (i + 1) - 1) for i, c in enumerate(TRIGAMMA_SERIES))
    tetra -= 1 / y**2 + 1 / y**3 + sum((2 * (i + 1) + 1) * c * y ** (-2 * (i + 1) - 2) for i, c in enumerate(TRIGAMMA_SERIES))
    return tri, tetra


def scalar_digamma(x: float) -> float:
    y = x + SHIFT
    return math.log(y) - 0.5 / y - sum(c * y ** (-2 * (i + 1)) for i, c in enumerate(DIGAMMA_SERIES)) - sum(
        1.0 / (x + i) for i in range(SHIFT)
    )


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    y = x + SHIFT
    shift = sum(np.log(x + i) for i in range(SHIFT))
    tail = sum(c * y ** (-2.0 * i - 1) for i, c in enumerate(LOG_GAMMA_SERIES))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - shift


def _fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function, modified Lentz evaluation."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.nanmax(np.abs(d * c - 1.0), initial=0.0) < 1e-15:
            break
    return h


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    with np.errstate(all="ignore"):
        swap = x > (a + 1.0) / (a + b + 2.0)
        p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
        front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
        part = np.where(z <= 0, 0.0, front * _fraction(p, q, z))
        return np.where(np.isnan(x), np.nan, np.where(swap, 1.0 - part, part))


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return incomplete_beta(df / 2.0, np.full_like(df, 0.5), df / (df + t * t))


def f_upper(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _nulls(values: np.ndarray) -> pd.Series:
    return pd.Series(values, dtype="float64").where(~np.isnan(values), None)


@F.pandas_udf(DoubleType())
def student_t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t."""
    return _nulls(t_two_sided(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper-tail p-value of the F distribution."""
    return _nulls(f_upper(f.to_numpy(dtype=float), d1.to_numpy(dtype=float), d2.to_numpy(dtype=float)))


def register(spark: SparkSession) -> None:
    """Make the tail probabilities callable from SQL."""
    spark.udf.register("student_t_p", student_t_p)
    spark.udf.register("f_p", f_p)
