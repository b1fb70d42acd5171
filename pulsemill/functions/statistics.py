"""Binomial tails for real-valued counts, and the area-fraction-top probability."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def regularised_beta(a: float, b: float, x: float) -> float:
    """Incomplete beta function I_x(a, b) by a continued fraction, on the side where it converges fast."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - regularised_beta(b, a, 1 - x)
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h / a


def binomial_cdf(k: float, n: float, p: float) -> float:
    """P(X <= k) for real k and n."""
    if k < 0:
        return 0.0
    return 1.0 if k >= n else regularised_beta(n - k, k + 1, 1 - p)


def binomial_pmf(k: float, n: float, p: float) -> float:
    if p <= 0 or p >= 1:
        return float(k == (0 if p <= 0 else n))
    return math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))


def binomial_test(k: float, n: float, p: float) -> float:
    """Two-sided p-value: the tail beyond k, plus the other tail from the point that is as unlikely as k."""
    if not n > 0 or not 0 <= k <= n:
        return float("nan")
    mode, level = n * p, binomial_pmf(k, n, p)
    if math.isclose(k, mode):
        return 1.0
    lo, hi = (mode, n) if k < mode else (0.0, mode)
    rising = k > mode
    for _ in range(80):
        mid = (lo + hi) / 2
        if (binomial_pmf(mid, n, p) > level) == rising:
            hi = mid
        else:
            lo = mid
    mirror = (lo + hi) / 2
    if k < mode:
        return min(1.0, binomial_cdf(k, n, p) + 1 - binomial_cdf(mirror, n, p) + binomial_pmf(mirror, n, p) * (binomial_pmf(mirror, n, p) <= level * (1 + 1e-9)))
    return min(1.0, 1 - binomial_cdf(k, n, p) + level + binomial_cdf(mirror, n, p))


def binomial_p_value(k: Column, n: Column, p: Column) -> Column:
    @F.pandas_udf("double")
    def run(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([binomial_test(*v) for v in zip(k, n, p)], dtype=np.float64)

    return run(k.cast("double"), n.cast("double"), p.cast("double"))


def area_fraction_top_p_value(expected: Column, area: Column, fraction_top: Column, hits: Column, hits_fraction_top: Column, low: float = 10.0) -> Column:
    """p-value of the top array's share of an s1: two-sided binomial test of the area; under `low` photoelectrons area and hits are blended by the area's share of it. Null where an input is."""
    share = F.least(area / low, F.lit(1.0))
    top = hits * hits_fraction_top * (1 - share) + area * fraction_top * share
    whole = hits * (1 - share) + area * share
    known = expected.isNotNull() & top.isNotNull() & whole.isNotNull()
    p = binomial_p_value(F.coalesce(top, F.lit(float("nan"))), F.coalesce(whole, F.lit(float("nan"))), F.coalesce(expected, F.lit(0.5)))
    return F.when(known, p)
