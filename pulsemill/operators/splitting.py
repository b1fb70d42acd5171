"""Sequential per-peak algorithms as Arrow functions: natural breaks, minima, tails, smoothing, desaturation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Entries of the table of deviations that are worked on at once.
_CELLS = 1 << 20


def _best_breaks(t: np.ndarray, a: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """best_break() of many rows of hits of one length (m, n), at once."""
    m, n = t.shape
    area, moment = np.cumsum(a, axis=1), np.cumsum(a * t, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        left = moment[:, :-1] / area[:, :-1]
        right = (moment[:, -1:] - moment[:, :-1]) / (area[:, -1:] - area[:, :-1])
        middle = moment[:, -1:] / area[:, -1:]
    whole = (np.maximum(own, np.abs(t - middle)) * a).sum(axis=1)
    apart = np.empty((m, n - 1))
    is_left = np.arange(n) < np.arange(1, n)[:, None]
    rows, columns = max(1, _CELLS // (n * n)), max(1, _CELLS // n)
    for r in range(0, m, rows):
        for c in range(0, n - 1, columns):
            at = (slice(r, r + rows), slice(c, c + columns))
            mean = np.where(is_left[at[1]], left[at][..., None], right[at][..., None])
            apart[at] = (np.maximum(own[at[0], None], np.abs(t[at[0], None] - mean)) * a[at[0], None]).sum(axis=-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        good = np.where(whole[:, None] == 0, 0.0, 1 - apart / whole[:, None])
    i = good.argmax(axis=1)
    return np.where(whole == 0, 0, i + 1), np.take_along_axis(good, i[:, None], axis=1)[:, 0]


def best_break(t: np.ndarray, a: np.ndarray, own: np.ndarray | None = None) -> tuple[int, float]:
    """(index of the first hit on the right, goodness) of the split of ordered hits that leaves the least area-weighted absolute deviation.

    Goodness is 1 - the deviation of both sides over the whole's. own: the deviation that each hit has in itself.
    """
    if len(t) < 2:
        return 0, 0.0
    i, good = _best_breaks(t[None], a[None], np.zeros((1, len(t))) if own is None else own[None])
    return int(i[0]), float(good[0])


def _limit(area: np.ndarray, knots: Sequence[tuple[float, float]]) -> np.ndarray:
    """Linear between knots (log10 area, limit), and beyond them too."""
    x, y = (np.array(v) for v in zip(*knots))
    v = np.log10(np.maximum(area, 1e-9))
    low = y[0] + (v - x[0]) * (y[1] - y[0]) / (x[1] - x[0])
    high = y[-1] + (v - x[-1]) * (y[-1] - y[-2]) / (x[-1] - x[-2])
    return np.where(v < x[0], low, np.where(v > x[-1], high, np.interp(v, x, y)))


def break_parts(t: np.ndarray, a: np.ndarray, own: np.ndarray, sizes: Sequence[int], min_gap: float, knots: Sequence[tuple[float, float]]) -> np.ndarray:
    """Part number of each hit of peaks that lie end to end: split while the best split's gap and goodness reach their limits.

    All pieces of one length are tried together, so a batch of small peaks is a few array operations.
    """
    ends = np.cumsum(sizes, dtype=np.int64)
    begins = ends - np.asarray(sizes, np.int64)
    new = np.zeros(len(t), np.int64)
    lo, hi = begins, ends
    while len(lo):
        more = []
        for n in np.unique(hi - lo):
            if n < 2:
                continue
            start = lo[hi - lo == n]
            rows = start[:, None] + np.arange(n)
            i, good = _best_breaks(t[rows], a[rows], own[rows])
            cut = start + i
            split = (i > 0) & (good > _limit(a[rows].sum(axis=1), knots))
            split[split] = t[cut[split]] - t[cut[split] - 1] >= min_gap
            new[cut[split]] = 1
            more += [np.stack([start[split], cut[split]]), np.stack([cut[split], start[split] + n])]
        lo, hi = np.concatenate(more, axis=1) if more else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    part = np.cumsum(new)
    return part - np.repeat(part[begins[begins < len(t)]], np.asarray(sizes)[begins < len(t)]) if len(t) else part


def natural_breaks(t: np.ndarray, a: np.ndarray, min_gap: float, knots: Sequence[tuple[float, float]], own: np.ndarray | None = None) -> np.ndarray:
    """break_parts() of one peak."""
    return break_parts(np.asarray(t, float), np.asarray(a, float), np.zeros(len(t)) if own is None else own, [len(t)], min_gap, knots)


def split_natural(hits: DataFrame, peak: Sequence[str], hit: str, time: str, area: str, min_gap: float, knots: Sequence[tuple[float, float]], deviation: str | None = None) -> DataFrame:
    """peak, hit, part: the part of its peak that each hit falls in. A peak's hits are one short array; arrays go to Python in Arrow batches.

    deviation: a column with each hit's own mean absolute deviation, which counts as the least distance from a mean.
    """

    @F.pandas_udf("array<long>")
    def run(t: pd.Series, a: pd.Series, d: pd.Series) -> pd.Series:
        sizes = [len(x) for x in t]
        flat = lambda v: np.concatenate([*v, np.zeros(0)]).astype(float)
        return pd.Series(np.split(break_parts(flat(t), flat(a), flat(d), sizes, min_gap, knots), np.cumsum(sizes)[:-1]))

    own = F.col(deviation).cast("double") if deviation else F.lit(0.0)
    lists = hits.groupBy(*peak).agg(F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col(hit).alias("h"), F.col(area).cast("double").alias("a"), own.alias("d")))).alias("x"))
    parts = lists.select(*peak, "x", run(F.transform("x", lambda v: v["t"].cast("double")), F.transform("x", lambda v: v["a"]), F.transform("x", lambda v: v["d"])).alias("part"))
    each = parts.select(*peak, F.explode(F.arrays_zip(F.transform("x", lambda v: v["h"]).alias("h"), F.col("part").alias("part"))).alias("v"))
    return each.select(*peak, F.col("v.h").alias(hit), F.col("v.part").alias("part"))


def minimum_splits(w: np.ndarray, min_height: float, min_ratio: float) -> list[int]:
    """Samples where w is cut: local minima with, on both sides, a maximum that is higher by min_height and by min_ratio times the minimum."""
    out, last = [], 0
    for i in range(1, len(w) - 1):
        if w[i] <= w[i - 1] and w[i] < w[i + 1]:
            need = max(w[i] + min_height, w[i] * min_ratio)
            stop = next((j for j in range(i + 1, len(w)) if w[j] < w[i]), len(w))
            if w[last : i + 1].max() >= need and w[i:stop].max() >= need:
                out.append(i)
                last = i
    return out


def tail_point(w: np.ndarray, ratio: float) -> int:
    """First sample beyond mean + 2 sigma of the main part that falls under ratio times the height; len(w) if there is none."""
    if not len(w) or w.max() <= 0:
        return len(w)
    i = np.arange(len(w))
    main = w > 0.02 * w.max()
    mean = np.average(i[main], weights=w[main])
    sigma = np.sqrt(np.average((i[main] - mean) ** 2, weights=w[main]))
    beyond = np.nonzero((i > mean + 2 * sigma) & (w < ratio * w.max()))[0]
    return int(beyond[0]) if len(beyond) else len(w)


def lowess(y: np.ndarray, fraction: float) -> np.ndarray:
    """Local linear fit with tri-cube weights over the nearest fraction of samples, in one pass."""
    n = len(y)
    r = min(n - 1, max(2, int(np.ceil(fraction * n))))
    x = np.arange(n, dtype=float)
    out = np.empty(n)
    for i in range(n):
        d = np.abs(x - i)
        h = np.partition(d, r)[r]
        w = np.clip(1 - (d / h) ** 3, 0, None) ** 3 if h else (d == 0).astype(float)
        sw, sx, sy = w.sum(), (w * x).sum(), (w * y).sum()
        sxx, sxy = (w * x * x).sum(), (w * x * y).sum()
        det = sw * sxx - sx * sx
        slope = (sw * sxy - sx * sy) / det if det else 0.0
        out[i] = (sy - slope * sx) / sw + slope * i
    return out


def with_array(df: DataFrame, keys: Sequence[str], w: str, function, kind: str) -> DataFrame:
    """keys and function(samples) of each waveform, in Arrow batches; kind is the result's SQL type."""

    @F.pandas_udf(kind)
    def run(v: pd.Series) -> pd.Series:
        return v.map(lambda a: function(np.asarray(a, float)))

    return df.select(*keys, run(F.col(w)).alias("result"))


def desaturate(w: np.ndarray, template: np.ndarray, ceiling: float, reference: int) -> np.ndarray:
    """w with its saturated samples, and those after up to the end of the template, replaced by the template scaled to w in the `reference` samples before saturation."""
    over = np.nonzero(w >= ceiling)[0]
    if not len(over) or over[0] == 0:
        return w
    first = int(over[0])
    lo = max(0, first - reference)
    base = template[lo:first].sum()
    if base <= 0:
        return w
    scaled = template * w[lo:first].sum() / base
    out = w.copy()
    stop = int(over[-1]) + 1
    out[first:stop] = np.maximum(out[first:stop], scaled[first:stop])
    return out


def desaturate_events(pulses: DataFrame, event: Sequence[str], ceiling: float, reference: int) -> DataFrame:
    """pulses(event, channel, w array<double>) of one length per event with saturated ones restored from the sum of the unsaturated ones."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w = np.stack(pdf["w"].to_numpy()).astype(float)
        full = (w >= ceiling).any(axis=1)
        template = w[~full].sum(axis=0) if (~full).any() else np.zeros(w.shape[1])
        return pdf.assign(w=[desaturate(v, template, ceiling, reference) if s else v for v, s in zip(w, full)])

    return pulses.groupBy(*event).applyInPandas(run, pulses.schema)
