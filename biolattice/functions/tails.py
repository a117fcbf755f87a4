"""Tail probabilities of the t, F and normal distributions as Arrow-batched functions."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _beta_fraction(a, b, x, steps=400):
    """Continued fraction of the incomplete beta function, evaluated for whole arrays."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, steps):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-14):
            break
    return out


def ln_gamma(z):
    """ln gamma for arrays, z > 0: Stirling's series after steps up to 12."""
    z = np.asarray(z, dtype=float)
    steps = np.zeros_like(z)
    x = z.copy()
    for _ in range(12):
        low = x < 12
        steps = steps + np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1, x)
    series = 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - 1 / (1680 * x ** 7)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - steps


def erfc(x):
    """Complementary error function for arrays, x >= 0: a series below 2.5, a continued fraction above."""
    x = np.asarray(x, dtype=float)
    small = np.minimum(x, 2.5)
    term = total = small
    for k in range(1, 60):
        term = term * (2 * small * small) / (2 * k + 1)
        total = total + term
    near = 1 - 2 / math.sqrt(math.pi) * np.exp(-small * small) * total
    large = np.maximum(x, 2.5)
    f = large
    for k in range(60, 0, -1):
        f = large + k / 2 / f
    return np.where(x < 2.5, near, np.exp(-large * large) / math.sqrt(math.pi) / f)


def regularized_beta(x, a, b):
    """I_x(a, b) for arrays."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (x, a, b)))
    res = np.full(x.shape, np.nan)
    ok = np.isfinite(x) & np.isfinite(a) & np.isfinite(b) & (a > 0) & (b > 0)
    if not ok.any():
        return res
    xo, ao, bo = x[ok].clip(0, 1), a[ok], b[ok]
    lg = ln_gamma
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lg(ao + bo) - lg(ao) - lg(bo) + ao * np.log(xo) + bo * np.log1p(-xo))
        low = xo < (ao + 1) / (ao + bo + 2)
        left = front * _beta_fraction(ao, bo, np.where(low, xo, 0.0)) / ao
        right = 1.0 - front * _beta_fraction(bo, ao, np.where(low, 0.0, 1 - xo)) / bo
    res[ok] = np.where(xo <= 0, 0.0, np.where(xo >= 1, 1.0, np.where(low, left, right)))
    return res


def t_two_sided(t, df):
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return regularized_beta(df / (df + t * t), df / 2, np.full(np.shape(df), 0.5))


def f_upper(f, d1, d2):
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    return regularized_beta(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def z_two_sided(z):
    z = np.asarray(z, dtype=float)
    return np.where(np.isnan(z), np.nan, erfc(np.abs(np.nan_to_num(z)) / math.sqrt(2)))


@F.pandas_udf(T.DoubleType())
def _t_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.astype(float), df.astype(float)))


@F.pandas_udf(T.DoubleType())
def _f_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_upper(f.astype(float), d1.astype(float), d2.astype(float)))


@F.pandas_udf(T.DoubleType())
def _z_udf(z: pd.Series) -> pd.Series:
    return pd.Series(z_two_sided(z.astype(float)))


def t_tail(t, df) -> Column:
    """Two-sided p of a t statistic."""
    return F.nanvl(_t_udf(F.col(t) if isinstance(t, str) else t,
                          (F.col(df) if isinstance(df, str) else df).cast("double")),
                   F.lit(None).cast("double"))


def f_tail(f, d1, d2) -> Column:
    """Upper p of an F statistic."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (f, d1, d2)]
    return F.nanvl(_f_udf(*[c.cast("double") for c in cols]), F.lit(None).cast("double"))


def normal_tail(z) -> Column:
    """Two-sided p of a standard normal statistic."""
    return F.nanvl(_z_udf(F.col(z) if isinstance(z, str) else z), F.lit(None).cast("double"))
