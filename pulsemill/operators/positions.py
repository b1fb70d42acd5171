"""Positions from per-channel areas, pattern fits and correction maps."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A channel table or a map is a fixed piece of the detector's description: hundreds of channels, thousands of points.


def channel_areas(peaks: DataFrame, keys: Sequence[str], areas: str, channels: DataFrame) -> DataFrame:
    """keys, channel, area, x, y: each peak's areas with its channels' places; channels(channel, x, y) of the array used."""
    return peaks.select(*keys, F.posexplode(areas).alias("channel", "area")).join(F.broadcast(channels), "channel")


def max_channel(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Place of the channel with the largest area; the first of equal ones."""
    best = found.groupBy(*keys).agg(F.max_by(F.struct("channel", "x", "y"), F.struct("area", -F.col("channel"))).alias("p"))
    return best.select(*keys, "p.channel", "p.x", "p.y")


def weighted_position(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area-weighted mean place, and the rms distance from it; null without area."""
    a = F.sum("area")
    mean = lambda v: F.when(a != 0, F.sum(v * F.col("area")) / a)
    out = found.groupBy(*keys).agg(mean(F.col("x")).alias("x"), mean(F.col("y")).alias("y"))
    far = found.join(out.select(*keys, F.col("x").alias("mx"), F.col("y").alias("my")), list(keys))
    d2 = F.pow(F.col("x") - F.col("mx"), F.lit(2.0)) + F.pow(F.col("y") - F.col("my"), F.lit(2.0))
    spread = far.groupBy(*keys).agg(F.sqrt(F.when(a != 0, F.sum(d2 * F.col("area")) / a)).alias("spread"))
    return out.join(spread, list(keys))


def robust_position(peaks: DataFrame, keys: Sequence[str], areas: str, x: Sequence[float], y: Sequence[float], outlier: float = 3.0, min_channels: int = 3, ring: Sequence[int] = (), ring_weight: float = 1.0) -> DataFrame:
    """Weighted mean place after leaving out, one by one, the channel that lies farthest beyond `outlier` times the weighted rms distance.

    Stops when no channel is that far or min_channels are left. Channels of the outer ring count ring_weight times.
    """
    at = np.stack([np.asarray(x, float), np.asarray(y, float)], axis=1)
    weight = np.ones(len(at))
    weight[list(ring)] = ring_weight

    def place(w) -> tuple[float, float]:
        w = np.clip(np.asarray(w, float)[: len(at)], 0, None) * weight
        on = np.nonzero(w)[0]
        if not len(on):
            return float("nan"), float("nan")
        while True:
            mean = np.average(at[on], axis=0, weights=w[on])
            far = np.hypot(*(at[on] - mean).T)
            limit = outlier * np.sqrt(np.average(far**2, weights=w[on]))
            worst = int(far.argmax())
            if len(on) <= min_channels or far[worst] <= limit or limit == 0:
                return float(mean[0]), float(mean[1])
            on = np.delete(on, worst)

    @F.pandas_udf("x double, y double")
    def run(w: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([place(v) for v in w], columns=["x", "y"])

    return peaks.withColumn("_p", run(F.col(areas))).select(*keys, "_p.x", "_p.y")


def neural_position(peaks: DataFrame, keys: Sequence[str], areas: str, layers: Sequence[tuple[np.ndarray, np.ndarray]], scale: float) -> DataFrame:
    """Feed-forward net over the fractions of area: tanh between layers, the last one linear and scaled to x, y."""

    @F.pandas_udf("x double, y double")
    def run(w: pd.Series) -> pd.DataFrame:
        v = np.stack(w.to_numpy()).astype(float)
        sums = v.sum(axis=1, keepdims=True)
        v = np.divide(v, sums, out=np.full_like(v, np.nan), where=sums != 0)
        for i, (weights, bias) in enumerate(layers):
            v = v @ weights + bias
            v = np.tanh(v) if i < len(layers) - 1 else v * scale
        return pd.DataFrame(v[:, :2], columns=["x", "y"])

    return peaks.withColumn("_p", run(F.col(areas))).select(*keys, "_p.x", "_p.y")


def goodness_terms(kind: str, seen: Column, expected: Column, error: Column | None = None) -> Column:
    """One channel's part of a goodness of fit; the whole is the sum over channels. Lower is better.

    chi2: squared difference over the expected value and the squared error; chi2gamma: the same with min(seen, 1) added to
    the difference and 1 to the denominator; likelihood_poisson: -2 log of the likelihood ratio.
    """
    e = F.lit(0.0) if error is None else error
    if kind == "chi2":
        return (seen - expected) * (seen - expected) / (expected + e * e)
    if kind == "chi2gamma":
        d = seen + F.least(seen, F.lit(1.0)) - expected
        return d * d / (expected + 1 + e * e)
    if kind == "likelihood_poisson":
        floor = F.greatest(expected, F.lit(1e-10))
        return 2 * (floor - seen + F.when(seen > 0, seen * F.log(seen / floor)).otherwise(0.0))
    raise ValueError(kind)


def goodness(seen: Column, expected: Column, kind: str) -> Column:
    """Goodness of fit of two arrays; the expected pattern is scaled to the seen total."""
    return F.aggregate(F.zip_with(seen, expected, lambda s, e: goodness_terms(kind, s, e)), F.lit(0.0), lambda a, x: a + x)


def _in_one_row(table: DataFrame, *columns: Column) -> DataFrame:
    """A fixed piece of the detector's description (a map, a grid of patterns) as one row with the array column table."""
    return F.broadcast(table.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("_table")))


def grid_fit(peaks: DataFrame, keys: Sequence[str], areas: str, grid: DataFrame, kind: str) -> DataFrame:
    """Best grid point of each peak: keys, point, gof. grid(point, pattern) is the detector's pattern map; equal fits take the smallest point.

    The map is one array beside each peak, so all its points are tried inside the peak's row.
    """
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    shares = F.transform("pattern", lambda p: p.cast("double"))
    table = _in_one_row(grid.withColumn("_total", total(shares)), F.col("point"), shares.alias("pattern"), F.col("_total").alias("total"))
    seen = F.transform(areas, lambda x: x.cast("double"))
    held = peaks.select(*keys, seen.alias("_seen")).withColumn("_all", total(F.col("_seen"))).join(table)

    def fit(g: Column) -> Column:
        expected = F.transform(g["pattern"], lambda p: p * F.col("_all") / g["total"])
        return F.struct(goodness(F.col("_seen"), expected, kind).alias("gof"), g["point"].alias("point"))

    return held.select(*keys, F.array_min(F.transform("_table", fit)).alias("b")).filter("b is not null").select(*keys, "b.point", "b.gof")


def confidence_box(fits: DataFrame, keys: Sequence[str], level: float) -> DataFrame:
    """Bounding box of the grid points within `level` of the best gof, from fits(keys, x, y, gof)."""
    best = F.min("gof").over(Window.partitionBy(*keys))
    return fits.filter(F.col("gof") <= best + level).groupBy(*keys).agg(F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"))


def interpolate(points: DataFrame, keys: Sequence[str], dims: Sequence[str], table: DataFrame, value: str, k: int | None = None) -> DataFrame:
    """keys and the inverse-distance mean of the 2 * dim nearest map points; a null or NaN coordinate gives null.

    table(dims, value) is one array beside each point, and the nearest are taken inside the row.
    """
    k = k or 2 * len(dims)
    held = points.join(_in_one_row(table, *(F.col(d).cast("double").alias(d) for d in dims), F.col(value).alias("value")))

    def away(m: Column) -> Column:
        d2 = functools.reduce(lambda x, y: x + y, (F.pow(F.col(d) - m[d], F.lit(2.0)) for d in dims))
        return F.struct(F.sqrt(d2).alias("d"), *(m[d].alias(d) for d in dims), m["value"].alias("value"))

    near = F.slice(F.array_sort(F.transform("_table", away)), 1, k)
    sums = lambda f: F.aggregate("_near", F.lit(0.0), lambda s, m: s + f(m) / F.greatest(m["d"], F.lit(1e-6)))
    good = functools.reduce(lambda x, y: x & y, (F.col(d).isNotNull() & ~F.isnan(F.col(d).cast("double")) for d in dims))
    found = held.withColumn("_near", F.when(good, near))
    return found.select(*keys, (sums(lambda m: m["value"]) / sums(lambda m: F.lit(1.0))).alias(value))
