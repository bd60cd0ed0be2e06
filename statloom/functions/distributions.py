"""Distribution tails, vectorised with numpy.

These are evaluated on result rows (one per test), never on data rows. The
continued fractions are the standard modified Lentz evaluations.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

_TINY = 1e-300


# Plain functions: a module-level vectorised object cannot be shipped once it was used.
def _lgamma(x):
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _erfc(x):
    return np.vectorize(math.erfc, otypes=[float])(x)


def _beta_fraction(a, b, x):
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, 2000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


def beta_inc(a, b, x):
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (x >= 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        front = np.exp(
            _lgamma(am + bm) - _lgamma(am) - _lgamma(bm) + am * np.log(xm) + bm * np.log1p(-xm)
        )
        flip = xm > (am + 1) / (am + bm + 2)
        aa, bb, xx = np.where(flip, bm, am), np.where(flip, am, bm), np.where(flip, 1 - xm, xm)
        part = front * _beta_fraction(aa, bb, xx) / aa
        out[mid] = np.where(flip, 1 - part, part)
    return out


def gamma_inc_upper(a, x):
    """Regularised upper incomplete gamma Q(a, x)."""
    a, x = np.broadcast_arrays(np.asarray(a, dtype=float), np.asarray(x, dtype=float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & (a > 0) & ~np.isnan(x)
    out[ok & (x <= 0)] = 1.0
    out[ok & np.isposinf(x)] = 0.0
    low = ok & (x > 0) & np.isfinite(x) & (x < a + 1)
    if low.any():
        al, xl = a[low], x[low]
        term = 1.0 / al
        total = term.copy()
        for k in range(1, 20000):
            term = term * xl / (al + k)
            total = total + term
            if np.all(np.abs(term) < np.abs(total) * 1e-16):
                break
        out[low] = 1.0 - total * np.exp(-xl + al * np.log(xl) - _lgamma(al))
    high = ok & np.isfinite(x) & (x >= a + 1)
    if high.any():
        ah, xh = a[high], x[high]
        b = xh + 1.0 - ah
        c = np.full_like(xh, 1.0 / _TINY)
        d = 1.0 / b
        h = d.copy()
        for k in range(1, 20000):
            an = -k * (k - ah)
            b = b + 2.0
            d = an * d + b
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = b + an / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            h = h * d * c
            if np.all(np.abs(d * c - 1.0) < 1e-15):
                break
        out[high] = h * np.exp(-xh + ah * np.log(xh) - _lgamma(ah))
    return out


def t_two_sided(t, nu):
    t, nu = np.asarray(t, dtype=float), np.asarray(nu, dtype=float)
    with np.errstate(invalid="ignore"):
        x = np.where(np.isinf(t), 0.0, nu / (nu + np.where(np.isinf(t), 0.0, t) ** 2))
    return beta_inc(nu / 2.0, np.full_like(nu, 0.5), np.where(np.isnan(t), np.nan, x))


def f_upper(f, d1, d2):
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    with np.errstate(invalid="ignore"):
        x = np.where(np.isposinf(f), 0.0, d2 / (d2 + d1 * np.where(np.isposinf(f), 0.0, f)))
    return beta_inc(d2 / 2.0, d1 / 2.0, np.where(np.isnan(f), np.nan, x))


def chi2_upper(x, k):
    return gamma_inc_upper(np.asarray(k, dtype=float) / 2.0, np.asarray(x, dtype=float) / 2.0)


def normal_upper(z):
    return 0.5 * _erfc(np.asarray(z, dtype=float) / math.sqrt(2.0))


def normal_quantile(p):
    """Inverse normal CDF by bisection, finished with two Newton steps."""
    p = np.asarray(p, dtype=float)
    lo, hi = np.full_like(p, -40.0), np.full_like(p, 40.0)
    for _ in range(70):
        mid = (lo + hi) / 2
        above = 1.0 - normal_upper(mid) > p
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
    z = (lo + hi) / 2
    for _ in range(2):
        tail = np.where(z < 0, normal_upper(-z) - p, (1.0 - p) - normal_upper(z))
        density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        z = z - np.where(density > 0, tail / np.where(density > 0, density, 1.0), 0.0)
    return z


def t_quantile(p, nu):
    """Upper-half t quantile (p >= 0.5) by bisection on the two-sided tail."""
    p, nu = np.broadcast_arrays(np.asarray(p, dtype=float), np.asarray(nu, dtype=float))
    target = 2 * (1 - p)
    lo, hi = np.zeros_like(p), np.full_like(p, 2.0)
    for _ in range(200):
        wide = t_two_sided(hi, nu) > target
        if not np.any(wide):
            break
        hi = np.where(wide, hi * 2, hi)
    for _ in range(100):
        mid = (lo + hi) / 2
        wide = t_two_sided(mid, nu) > target
        lo, hi = np.where(wide, mid, lo), np.where(wide, hi, mid)
    return (lo + hi) / 2


def series(values, like: pd.Series) -> pd.Series:
    return pd.Series(np.asarray(values, dtype=float), index=like.index)
