"""Vectorised numerical routines behind a few Arrow UDFs (no SciPy needed)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lgamma(x) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(np.asarray(x, dtype=float))


def hypergeom_tail(k: int, m: int, n: int, draws: int) -> float:
    """P(X >= k) drawing ``draws`` from ``m`` items of which ``n`` are marked."""
    hi = min(n, draws)
    if k > hi:
        return 0.0
    xs = np.arange(max(k, draws - (m - n), 0), hi + 1)
    logs = (
        _lgamma(n + 1) - _lgamma(xs + 1) - _lgamma(n - xs + 1)
        + _lgamma(m - n + 1) - _lgamma(draws - xs + 1) - _lgamma(m - n - draws + xs + 1)
        - (_lgamma(m + 1) - _lgamma(draws + 1) - _lgamma(m - draws + 1))
    )
    return float(min(1.0, np.exp(logs).sum()))


def binomial_sum_tail(ns, ps, k: int) -> float:
    """P(sum of independent binomials >= k), exact up to floating point."""
    if k <= 0:
        return 1.0
    pmf = np.zeros(k)
    pmf[0] = 1.0
    for n, p in zip(ns, ps):
        n, p = int(n), float(p)
        if n == 0 or p <= 0:
            continue
        if p >= 1:
            shifted = np.zeros(k)
            if n < k:
                shifted[n:] = pmf[: k - n]
            pmf = shifted
            continue
        xs = np.arange(0, min(n, k - 1) + 1)
        logs = _lgamma(n + 1) - _lgamma(xs + 1) - _lgamma(n - xs + 1) + xs * math.log(p) + (n - xs) * math.log1p(-p)
        pmf = np.convolve(pmf, np.exp(logs))[:k]
    return float(max(0.0, 1.0 - pmf.sum()))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for i in range(1, 500):
        for num in (
            i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i)),
            -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return front * h / a


def beta_quantile(q: float, a: float, b: float) -> float:
    lo, hi = 0.0, 1.0
    for _ in range(80):
        mid = (lo + hi) / 2
        if incomplete_beta(a, b, mid) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def proportion_interval(x: float, n: float, level: float = 0.95, kind: str = "highest") -> tuple[float, float]:
    """Credible interval of a proportion under a Beta(1/2, 1/2) prior."""
    a, b, alpha = x + 0.5, n - x + 0.5, 1 - level
    if kind == "central":
        return beta_quantile(alpha / 2, a, b), beta_quantile(1 - alpha / 2, a, b)
    if x == 0:
        return 0.0, beta_quantile(level, a, b)
    if x == n:
        return beta_quantile(alpha, a, b), 1.0

    def log_density(t: float) -> float:
        return (a - 1) * math.log(max(t, 1e-300)) + (b - 1) * math.log(max(1 - t, 1e-300))

    # Equal-density ends: for a lower end below the mode the upper end follows from the
    # density, and the covered mass falls as the lower end rises.
    mode = (a - 1) / (a + b - 2)

    def upper(low: float) -> float:
        target, lo, hi = log_density(low), mode, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if log_density(mid) > target else (lo, mid)
        return (lo + hi) / 2

    lo, hi = 0.0, mode
    for _ in range(50):
        mid = (lo + hi) / 2
        if incomplete_beta(a, b, upper(mid)) - incomplete_beta(a, b, mid) > level:
            lo = mid
        else:
            hi = mid
    low = (lo + hi) / 2
    return low, upper(low)


def normal_tail(z: float) -> float:
    """Two-sided normal p-value."""
    return math.erfc(abs(z) / math.sqrt(2))


def fisher_exact(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """Two-sided exact p and conditional maximum-likelihood odds ratio of [[a, b], [c, d]]."""
    r1, c1, n = a + b, a + c, a + b + c + d
    lo, hi = max(0, r1 + c1 - n), min(r1, c1)
    xs = np.arange(lo, hi + 1)
    logs = -(_lgamma(xs + 1) + _lgamma(r1 - xs + 1) + _lgamma(c1 - xs + 1) + _lgamma(n - r1 - c1 + xs + 1))
    base = logs - logs.max()
    prob = np.exp(base) / np.exp(base).sum()
    p = float(min(1.0, prob[prob <= prob[a - lo] * (1 + 1e-7)].sum()))

    def mean(log_or: float) -> float:
        w = base + xs * log_or
        w = np.exp(w - w.max())
        return float((xs * w).sum() / w.sum())

    if lo == hi:
        return p, float("nan")
    if a == lo:
        return p, 0.0
    if a == hi:
        return p, float("inf")
    left, right = -60.0, 60.0
    for _ in range(200):
        mid = (left + right) / 2
        if mean(mid) < a:
            left = mid
        else:
            right = mid
    return p, math.exp((left + right) / 2)


# UDFs are created on use: building one needs a running session.


def hypergeom_tail_udf(k, m, n, draws) -> Column:
    def run(k: pd.Series, m: pd.Series, n: pd.Series, draws: pd.Series) -> pd.Series:
        return pd.Series([hypergeom_tail(int(a), int(b), int(c), int(d)) for a, b, c, d in zip(k, m, n, draws)])

    return F.pandas_udf(run, "double")(k, m, n, draws)


def binomial_sum_tail_udf(ns, ps, k) -> Column:
    def run(ns: pd.Series, ps: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([binomial_sum_tail(a, b, int(c)) for a, b, c in zip(ns, ps, k)])

    return F.pandas_udf(run, "double")(ns, ps, k)


def normal_tail_udf(z) -> Column:
    def run(z: pd.Series) -> pd.Series:
        return z.map(lambda v: None if v is None or v != v else normal_tail(v)).astype(float)

    return F.pandas_udf(run, "double")(z)


def fisher_udf(a, b, c, d) -> Column:
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fisher_exact(*map(int, r)) for r in zip(a, b, c, d)], columns=["p", "odds_ratio"])

    return F.pandas_udf(run, "p double, odds_ratio double")(a, b, c, d)


def interval_udf(x, n, level: float = 0.95, kind: str = "highest") -> Column:
    """``struct<lb, ub>`` of :func:`proportion_interval`."""

    def run(x: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([proportion_interval(float(a), float(b), level, kind) for a, b in zip(x, n)], columns=["lb", "ub"])

    return F.pandas_udf(run, "lb double, ub double")(x, n)


def simulate_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Draw binomial sums for ``gene, category, chunk, size, seed, ns, ps, actual`` rows.

    Every row is one chunk of randomizations of one gene; its generator is seeded from
    the row alone, so a lost task repeats the same draws.
    """
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            rng = np.random.default_rng(abs(int(r.seed)))
            total = np.zeros(int(r.size), dtype=np.int64)
            for n, p in zip(r.ns, r.ps):
                if n and p > 0:
                    total += rng.binomial(int(n), min(float(p), 1.0), int(r.size))
            rows.append((r.gene, r.category, int(r.actual), int(r.size), int(total.sum()), float((total.astype(float) ** 2).sum()), int((total >= r.actual).sum())))
        yield pd.DataFrame(rows, columns=["gene", "category", "actual", "n_rands", "sum_c", "sum_sq", "n_ge"])
