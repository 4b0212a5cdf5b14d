"""Distribution functions used by the germline and artifact tests."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# lgamma(y) ~ (y-1/2)ln y - y + ln(2 pi)/2 + sum_k c_k / y^(2k-1), Stirling's series
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_SHIFT = 8
LARGE = 1e7  # counts on both sides from which the normal expansion is the more exact one


def _correction(y):
    """Tail of Stirling's series (works on Columns and numpy arrays alike)."""
    inv2 = 1.0 / (y * y)
    total = STIRLING[-1]
    for coef in reversed(STIRLING[:-1]):
        total = coef + inv2 * total
    return total / y


def log_rising(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``lgamma(x + n) - lgamma(x)`` for integer ``n >= 0``.

    Written as a difference, so that large ``x`` loses no digits: the Stirling main
    terms combine into ``log1p(n / y)`` and the shift by eight into eight more
    ``log1p`` terms. ``n = 0`` gives 0 even at ``x = 0``.
    """
    safe = np.where(n == 0, 1.0, x)
    y = safe + _SHIFT
    total = (y + n - 0.5) * np.log1p(n / y) + n * np.log(y) - n + _correction(y + n) - _correction(y)
    for i in range(_SHIFT):
        total = total - np.log1p(n / (safe + i))
    return np.where(n == 0, 0.0, total)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Vectorised log-gamma for x >= 1."""
    y = x + _SHIFT
    prod = np.ones_like(x)
    for i in range(_SHIFT):
        prod = prod * (x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + _correction(y) - np.log(prod)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    live = np.ones(x.shape, dtype=bool)
    for m in range(1, 10 * int(math.sqrt(max(1.0, float((a + b).max())))) + 1000):
        m2 = 2 * m
        for num in (
            m * (b - m) * x / ((a + m2 - 1) * (a + m2)),
            -(a + m) * (a + b + m) * x / ((a + m2) * (a + m2 + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            out = np.where(live, out * step, out)
        live &= np.abs(step - 1.0) > 1e-15
        if not live.any():
            return out
    raise ArithmeticError("incomplete beta fraction did not converge")


def _beta_large(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Incomplete beta function for large ``a + b``: normal tail plus its first correction (error of order 1 / (a + b))."""
    total = a + b
    mode = a / total
    gap = (x - mode) / mode
    other = (mode - x) / (1 - mode)
    # mode ln(mode / x) + (1 - mode) ln((1 - mode) / (1 - x)), without loss of digits near the mode
    half = -mode * np.log1p(gap) - (1 - mode) * np.log1p(other)
    spread = np.sqrt(mode * (1 - mode))
    near = np.abs(x - mode) < 1e-4 * np.minimum(mode, 1 - mode)
    z = (x - mode) / spread
    skew = (1 - 2 * mode) / spread
    eta = np.where(near, z - skew * z * z / 3, np.sign(x - mode) * np.sqrt(2 * np.maximum(half, 0)))
    safe = np.where(near, 1.0, eta)
    first = np.where(near, skew / 3, 1 / safe - spread / np.where(near, 1.0, x - mode))
    tail = 0.5 * np.array([math.erfc(v) for v in -eta * np.sqrt(total / 2)])
    return tail + first * np.exp(-total * eta * eta / 2) / np.sqrt(2 * math.pi * total)


def binomial_cdf(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(X <= k) for X ~ Binomial(n, p), cost independent of the depth ``n``."""
    k, n, p = (np.asarray(v, dtype=float) for v in (k, n, p))
    out = np.ones(k.shape)
    inner = (n > 0) & (k < n)
    if not inner.any():
        return out
    a, b, x = (n - k)[inner], (k + 1)[inner], (1.0 - p)[inner]
    out[inner] = _incomplete_beta(a, b, x)
    return out


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function."""
    large = np.minimum(a, b) > LARGE
    if large.any():
        out = np.empty(a.shape)
        out[large] = np.clip(_beta_large(a[large], b[large], x[large]), 0.0, 1.0)
        if not large.all():
            out[~large] = _incomplete_beta(a[~large], b[~large], x[~large])
        return out
    log_front = _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x)
    direct = x < (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(direct, a, b), np.where(direct, b, a), np.where(direct, x, 1.0 - x)
    part = np.exp(log_front) * _beta_fraction(aa, bb, xx) / aa
    return np.clip(np.where(direct, part, 1.0 - part), 0.0, 1.0)


@pandas_udf(DoubleType())
def _binomial_less(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    known = (k.notna() & n.notna()).to_numpy()
    out = np.full(len(k), np.nan)
    if known.any():
        out[known] = binomial_cdf(k[known].to_numpy(), n[known].to_numpy(), p[known].to_numpy())
    return pd.Series(out).where(known, None)


def binomial_less_pvalue(k, n, p) -> Column:
    """One-sided ("less") exact binomial test; 1 when ``n`` is 0."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else (F.lit(float(c)) if isinstance(c, (int, float)) else c)
    return _binomial_less(as_col(k).cast("double"), as_col(n).cast("double"), as_col(p))


def rho_grid() -> list[float]:
    """Overdispersion grid: 10^(-6 … -0.05), step 0.05 in the exponent."""
    return [10 ** (-6 + 0.05 * i) for i in range(120)]


_BLOCK = 4096  # likelihood rows held at a time


def _summed_terms(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, share: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """Per owner and grid point: sum of weight * (lgamma(share * s + value) - lgamma(share * s)), equal values once."""
    out = np.zeros((n, len(s)))
    some = value > 0
    owner, value, weight = owner[some], value[some], weight[some]
    order = np.lexsort((value, owner))
    owner, value, weight = owner[order], value[order], weight[order]
    first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(value, prepend=-1) != 0))
    if not len(first):
        return out
    owner, value, weight = owner[first], value[first], np.add.reduceat(weight, first)
    for start in range(0, len(owner), _BLOCK):
        part = slice(start, start + _BLOCK)
        base = share[owner[part]][:, None] * s[None, :]
        terms = log_rising(base, value[part][:, None].astype(float) + 0 * base) * weight[part][:, None]
        edge = np.flatnonzero(np.diff(owner[part], prepend=-1))
        out[owner[part][edge]] += np.add.reduceat(terms, edge, axis=0)
    return out


def betabinom_best(nv: list, nr: list, weight: list) -> np.ndarray:
    """Grid overdispersion of each variant from its cells' counts (``weight``: how many cells have them); NaN without coverage.

    The likelihood of a variant is a sum over the distinct values of nv, of nr - nv and of nr, each with the number of cells
    that have it. Terms that do not depend on the overdispersion are left out. Likelihoods are compared at seven digits; the
    first maximum wins.
    """
    sizes = np.array([len(v) for v in nv], np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat = lambda lists: np.concatenate([np.asarray(v, np.int64) for v in lists]) if len(owner) else np.zeros(0, np.int64)
    k, n, w = flat(nv), flat(nr), flat(weight)
    total = lambda x: np.bincount(owner, x * w, minlength=len(sizes))
    k_sum, n_sum = total(k), total(n)
    covered = n_sum > 0
    mu = np.divide(k_sum, n_sum, out=np.zeros(len(sizes)), where=covered)
    seen = n > 0
    owner, k, n, w = owner[seen], k[seen], n[seen], w[seen]
    rho = np.array(rho_grid())
    s = (1 - rho) / rho
    score = _summed_terms(owner, k, w, mu, len(sizes), s) + _summed_terms(owner, n - k, w, 1 - mu, len(sizes), s) - _summed_terms(owner, n, w, np.ones(len(sizes)), len(sizes), s)
    return np.where(covered, rho[np.round(score, 7).argmax(axis=1)] if len(sizes) else 0.0, np.nan)


@pandas_udf(DoubleType())
def betabinom_rho_of(nv: pd.Series, nr: pd.Series, weight: pd.Series) -> pd.Series:
    """Overdispersion of each variant, from arrays over its distinct (nv, nr) and the number of cells that have them."""
    best = betabinom_best(nv.tolist(), nr.tolist(), weight.tolist())
    return pd.Series(best).where(~np.isnan(best), None)


def log10_or_neg_inf(x) -> Column:
    """log10 that keeps ``-Infinity`` for an exact zero."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.log10(x))


def log10_floored(x, floor: float = 1e-300) -> Column:
    """log10 with values below ``floor`` raised to it, for thresholding."""
    x = F.col(x) if isinstance(x, str) else x
    return F.log10(F.greatest(x, F.lit(floor)))
