"""Tails of distributions and gamma functions in numpy, and as pandas UDFs.

Incomplete gamma and beta functions by series and Lentz's continued fractions (Press et al., Numerical Recipes, ch. 6).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_erfc = np.vectorize(math.erfc, otypes=[float])
_TINY = 1e-300


def norm_sf(z):
    """P(Z > z)."""
    return 0.5 * _erfc(np.asarray(z, float) / math.sqrt(2))


def lgamma(x):
    """log of the gamma function for x > 0: from x + 10 by Stirling's series, less the factors between."""
    x = np.asarray(x, float)
    y = x + 10
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / y
    factors = x * (x + 1) * (x + 2) * (x + 3) * (x + 4)
    more = (x + 5) * (x + 6) * (x + 7) * (x + 8) * (x + 9)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(factors) - np.log(more)


def digamma(x):
    """The derivative of lgamma for x > 0: from x + 10 by the asymptotic series, less the terms between."""
    x = np.asarray(x, float)
    y = x + 10
    r = 1 / (y * y)
    between = sum(1 / (x + i) for i in range(10))
    return np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132)))) - between


def trigamma(x):
    """The derivative of digamma for x > 0, likewise."""
    x = np.asarray(x, float)
    y = x + 10
    r = 1 / (y * y)
    between = sum(1 / ((x + i) * (x + i)) for i in range(10))
    return (1 + 0.5 / y + r * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))) / y + between


def _gamma_q(a: float, x: float) -> float:
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_sf(x, k):
    """P(X > x) for k degrees of freedom."""
    return np.vectorize(lambda v, n: _gamma_q(n / 2, v / 2) if v == v and n > 0 else math.nan, otypes=[float])(x, k)


def _beta_part(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The continued fraction, for all places at once; those that have settled stay as they are."""
    some = lambda v: np.where(v == 0, _TINY, v)
    c, d = np.ones_like(x), 1 / some(1 - (a + b) * x / (a + 1))
    h, out, at = d, np.empty_like(x), np.arange(len(x))
    for m in range(1, 10_000):
        for an in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / some(1 + an * d)
            c = some(1 + an / c)
            h = h * d * c
        done = np.abs(d * c - 1) < 1e-15
        if done.any():
            out[at[done]] = h[done]
            a, b, x, c, d, h, at = (v[~done] for v in (a, b, x, c, d, h, at))
            if not len(at):
                break
    out[at] = h
    return out


def beta_cdf(x, a, b):
    """The regularised incomplete beta function."""
    x, a, b = (np.asarray(v, float).ravel() for v in np.broadcast_arrays(x, a, b))
    out = (x >= 1).astype(float)
    at = np.flatnonzero((x > 0) & (x < 1))
    x, a, b = x[at], a[at], b[at]
    swap = x >= (a + 1) / (a + b + 2)
    front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x))
    first, second = np.where(swap, b, a), np.where(swap, a, b)
    part = front * _beta_part(first, second, np.where(swap, 1 - x, x)) / first
    out[at] = np.where(swap, 1 - part, part)
    return out


def t_sf(t, df):
    """P(T > t)."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    v, n = t.ravel(), df.ravel()
    ok = (v == v) & (n > 0)
    half = np.full(len(v), math.nan)
    half[ok] = 0.5 * beta_cdf(n[ok] / (n[ok] + v[ok] * v[ok]), n[ok] / 2, 0.5)
    return np.where(v >= 0, half, 1 - half).reshape(t.shape)


def t_ppf(p: float, df: float) -> float:
    """The quantile, by bisection."""
    lo, hi = -1e6, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - float(t_sf(mid, df)) < p else (lo, mid)
    return (lo + hi) / 2


def binom_two_sided(k: int, n: int, p: float = 0.5) -> float:
    """The exact two-sided test: the sum of all outcomes no likelier than k."""
    if n == 0:
        return 1.0
    logs = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(n + 1)]) + np.arange(n + 1) * math.log(p) + (n - np.arange(n + 1)) * math.log1p(-p)
    return float(min(1.0, np.exp(logs[logs <= logs[k] + 1e-7]).sum()))


def binom_sf(k: int, n: int, p: float = 0.5) -> float:
    """P(X >= k) of n draws."""
    if k <= 0:
        return 1.0
    i = np.arange(k, n + 1)
    logs = math.lgamma(n + 1) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * math.log(p) + (n - i) * math.log1p(-p)
    return float(min(1.0, np.exp(logs).sum()))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Fisher's exact test of a table of two rows: the sum of all tables with its margins that are no likelier."""
    n, row, col = a + b + c + d, a + b, a + c
    x = np.arange(max(0, row + col - n), min(row, col) + 1, dtype=float)
    choose = lambda m, k: math.lgamma(m + 1) - lgamma(k + 1.0) - lgamma(m - k + 1.0)
    logs = choose(col, x) + choose(n - col, row - x)
    logs -= logs.max() + math.log(np.exp(logs - logs.max()).sum())
    return float(min(1.0, np.exp(logs[logs <= logs[a - int(x[0])] + 1e-7]).sum()))


@F.pandas_udf(DoubleType())
def binom_sf_udf(k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([binom_sf(int(a), int(b)) for a, b in zip(k, n, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def fisher_udf(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([fisher_two_sided(*map(int, x)) for x in zip(a, b, c, d, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def norm_sf_udf(z: pd.Series) -> pd.Series:
    return pd.Series(norm_sf(z.astype(float)))


@F.pandas_udf(DoubleType())
def t_sf_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_sf(t.astype(float), df.astype(float)))


@F.pandas_udf(DoubleType())
def chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series(chi2_sf(x.astype(float), k.astype(float)))


@F.pandas_udf(DoubleType())
def binom_udf(k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([binom_two_sided(int(a), int(b)) for a, b in zip(k, n, strict=True)], dtype=float)
