"""Peaks cut at minima of their smoothed waveform or at their tail: hits across a cut are cut too, and both are measured again.

A rule gives each peak's cuts from its sum waveform (an Arrow function over arrays). Hits then meet their peak's cuts in a
join, and only those that a cut crosses meet their pulse, whose samples are measured inside the row. Peaks are put together
from the hits they get; a part without hits is no peak.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .waves import hits_in_array, total

#: Of the smoothing: every so many samples is used, over about so many samples; waveforms are cut where they stay low for so
#: long, keep a margin, and are not smoothed beyond a length.
STRIDE, REACH, QUIET, MARGIN, LONGEST = 2, 30, 1000, 500, 5000


def local_line(y: np.ndarray, reach: float, step: int = 1) -> np.ndarray:
    """Local linear regression at each sample with tri-cube weights over distances under `reach`; samples are `step` apart. NaN where a line isn't determined."""
    n = len(y)
    half = min(n - 1, max(0, int(np.ceil(reach / step)) - 1))
    d = step * np.arange(-half, half + 1)
    weight = (1 - np.clip(np.abs(d) / reach, 0, 1) ** 3) ** 3
    inside, y = np.ones(n), np.asarray(y, float)
    near = lambda kernel, v: np.convolve(v, kernel[::-1], "full")[half : half + n]
    # Moments of the distance from the sample itself, so the line's value there is its intercept.
    s0, s1, s2 = near(weight, inside), near(weight * d, inside), near(weight * d * d, inside)
    t0, t1 = near(weight, y), near(weight * d, y)
    det = s0 * s2 - s1 * s1
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(det > 1e-12 * s0 * s0, (s2 * t0 - s1 * t1) / det, np.nan)


def minimum_points(w: np.ndarray, min_height: float) -> list[int]:
    """Samples of the minima of the smoothed waveform that lie min_height under the next maximum and under some maximum before."""
    high = np.flatnonzero(w > min_height)
    if not len(high) or w.max() < min_height:
        return []
    out: list[int] = []
    for part in np.split(high, np.flatnonzero(np.diff(high) > QUIET) + 1):
        left, right = max(0, int(part[0]) - MARGIN), min(len(w), int(part[-1]) + MARGIN)
        if right - left > LONGEST:
            continue
        y = w[left:right:STRIDE]
        if len(y) < 3:
            continue
        smooth = local_line(y, np.ceil(REACH / (right - left) * len(y)), STRIDE)
        rise = np.diff(smooth)
        before, after = np.concatenate([[1], rise]), np.concatenate([rise, [-1]])
        minima = np.flatnonzero((after > 0) & (before <= 0))
        maxima = np.flatnonzero((np.concatenate([rise, [1]]) <= 0) & (np.concatenate([[-1], rise]) > 0))
        if len(maxima) < 2:
            continue
        for m in minima[(minima > maxima[0]) & (minima < maxima[-1])]:
            k = int(np.searchsorted(maxima, m))
            if smooth[maxima[k]] - smooth[m] > min_height and (smooth[maxima[:k]] - smooth[m] > min_height).any():
                out.append(left + STRIDE * int(m))
    return out


def tail_points(w: np.ndarray, min_height: float, ratio: float) -> list[int]:
    """The first sample beyond mean + 2 sigma of the main part under ratio times the amplitude of the normal curve fitted to it; none if there is none."""
    if not len(w) or w.max() < min_height or w.max() <= 0:
        return []
    i = np.arange(len(w))
    main = w > 0.02 * w.max()
    mean = np.average(i[main], weights=w[main])
    sigma = np.sqrt(np.average((i[main] - mean) ** 2, weights=w[main]))
    if sigma == 0:
        return []
    curve = np.exp(-0.5 * ((i[main] - mean) / sigma) ** 2) / (sigma * np.sqrt(2 * np.pi))
    amplitude = (w[main] * curve).sum() / (curve**2).sum()
    # The ratio is of the fitted area, as the curve has area one.
    beyond = np.flatnonzero((w < ratio * amplitude) & (i > mean + 2 * sigma))
    return beyond[:1].tolist()


def cut_points(peaks: DataFrame, w: str, rule: Callable[..., list[int]], *limits: float, only: Column | None = None) -> DataFrame:
    """peaks with the array column points: the cuts (samples of the array w) of those peaks for which `only` holds."""

    @F.pandas_udf("array<int>")
    def run(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda a: [] if a is None else rule(np.asarray(a, float), *limits))

    none = F.array().cast("array<int>")
    return peaks.withColumn("points", run(F.col(w)) if only is None else F.when(F.coalesce(only, F.lit(False)), run(F.col(w))).otherwise(none))


def split_hits(peaks: DataFrame, hits: DataFrame, pulses: DataFrame, peak: Sequence[str], pulse: Sequence[str], saturation: float) -> DataFrame:
    """Hits with the number `part` of the piece of their peak that holds their maximum; hits across a cut are pieces of their own, measured again.

    peaks(*peak, left, points), hits(*peak, *pulse, left, right and the properties of find_hits in samples of the event),
    pulses(*pulse, start, w). A cut x ends the piece to its left. Pieces without positive area go, and with a rest that has
    none all pieces after it.
    """
    measures = ["area", "height", "index_of_maximum", "center", "n_saturated", "sum_absolute_deviation"]
    at = peaks.select(*peak, F.transform("points", lambda x: (x + F.col("left")).cast("int")).alias("_cuts"))
    held = hits.join(at, list(peak)).withColumn("_in", F.filter("_cuts", lambda x: (F.col("left") <= x) & (x < F.col("right"))))
    own = [*dict.fromkeys([*peak, *pulse])]
    whole = held.filter(F.size("_in") == 0).select(*own, "left", "right", *measures, "_cuts")
    crossed = held.filter(F.size("_in") > 0).join(pulses.select(*pulse, "start", "w"), list(pulse))
    bounds = F.zip_with(
        F.concat(F.array(F.col("left")), F.transform("_in", lambda x: x + 1)),
        F.concat(F.col("_in"), F.array(F.col("right"))),
        lambda a, b: F.struct((a - F.col("start")).cast("int").alias("left"), (b - F.col("start")).cast("int").alias("right")),
    )
    # Only as many pieces as there are rests of positive area in a row, and one.
    rest = lambda x: total(F.slice(F.col("w"), (x + 2 - F.col("start")).cast("int"), (F.col("right") - x).cast("int"))) > 0
    alive = F.filter(F.sequence(F.lit(0), F.size("_in")), lambda k: F.forall(F.slice("_in", F.lit(1), k), rest))
    pieces = hits_in_array(F.col("w"), F.slice(bounds, F.lit(1), F.size(alive)), saturation)
    new = crossed.select(*own, "_cuts", "start", F.explode(pieces).alias("h"))
    moved = {c: F.col(f"h.{c}") + (F.col("start") if c in ("left", "right", "index_of_maximum", "center") else F.lit(0)) for c in ("left", "right", *measures)}
    new = new.select(*own, *(x.alias(c) for c, x in moved.items()), "_cuts")
    both = whole.unionByName(new.select(whole.columns))
    return both.withColumn("part", F.size(F.filter("_cuts", lambda x: x < F.col("index_of_maximum")))).drop("_cuts")


def split_peaks(peaks: DataFrame, parts: DataFrame, peak: Sequence[str]) -> DataFrame:
    """*peak, part, left, right, n_hits, area of the peaks that the hits of split_hits() make; peaks(*peak, left, right, points)."""
    sums = parts.groupBy(*peak, "part").agg(F.count("*").alias("n_hits"), F.sum("area").alias("area"))
    joined = sums.join(peaks.select(*peak, F.col("left").alias("_l"), F.col("right").alias("_r"), "points"), list(peak))
    left = F.when(F.col("part") == 0, F.col("_l")).otherwise(F.col("_l") + F.get("points", F.col("part") - 1) + 1)
    right = F.when(F.col("part") == F.size("points"), F.col("_r")).otherwise(F.col("_l") + F.get("points", F.col("part")))
    return joined.select(*peak, "part", left.alias("left"), right.alias("right"), "n_hits", "area")
