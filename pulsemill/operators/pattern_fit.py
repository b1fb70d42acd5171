"""Pattern maps and fits: the place whose expected pattern over the channels fits a peak's areas best.

A map is an array over a regular grid of places and the channels. It is a fixed piece of the detector's description: it is
read once, its size is checked, and it is broadcast to the workers, not copied beside rows. A batch of peaks is fitted by
array operations over slices of the map.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a map at most, unless asked otherwise.
MOST_BYTES = 512 << 20
STATISTICS = ("chi2", "chi2gamma", "likelihood_poisson")


def goodness(statistic: str, seen: np.ndarray, expected: np.ndarray, errors2: np.ndarray | float = 0.0) -> np.ndarray:
    """Sum over the last axis; lower is better. errors2 are squared systematic errors.

    chi2: squared differences over expected + errors2; chi2gamma: min(seen, 1) is added to the difference and 1 to the
    denominator; likelihood_poisson: twice the log of the likelihood ratio of both patterns.
    """
    if statistic == "chi2":
        with np.errstate(divide="ignore", invalid="ignore"):
            return ((seen - expected) ** 2 / (expected + errors2)).sum(axis=-1)
    if statistic == "chi2gamma":
        return ((seen + np.minimum(seen, 1) - expected) ** 2 / (expected + errors2 + 1)).sum(axis=-1)
    if statistic == "likelihood_poisson":
        s, e = np.maximum(seen, 1e-10), np.maximum(expected, 1e-10)
        return 2 * (s * np.log(s / e) - s + e).sum(axis=-1)
    raise ValueError(f"no statistic {statistic!r}; there are {', '.join(STATISTICS)}")


@dataclass(frozen=True)
class PatternMap:
    """patterns: (n_1, .., n_d, channels); bounds: lowest and highest place along each dimension; names of the dimensions."""

    patterns: np.ndarray
    bounds: tuple[tuple[float, float], ...]
    names: tuple[str, ...]

    @classmethod
    def from_table(cls, table: DataFrame, dims: Sequence[str], pattern: str, most_bytes: int = MOST_BYTES) -> PatternMap:
        """From rows (dims, pattern array) of a full regular grid. Its size is counted before it is read."""
        size = table.agg(F.sum(F.size(pattern)).alias("n")).first()["n"] or 0
        if 8 * size > most_bytes:
            raise ValueError(f"a map of {8 * size} bytes is over the limit of {most_bytes}")
        rows = table.select(*(F.col(d).cast("double").alias(d) for d in dims), F.col(pattern).cast("array<double>").alias("pattern")).toPandas().sort_values([*dims])
        axes = [np.unique(rows[d]) for d in dims]
        if len(rows) != np.prod([len(a) for a in axes]) or rows["pattern"].map(len).nunique() != 1:
            raise ValueError("a map needs one pattern of the same channels at each point of a full grid")
        for d, a in zip(dims, axes):
            if len(a) < 2 or not np.allclose(np.diff(a), a[1] - a[0]):
                raise ValueError(f"the points along {d} are not evenly spaced")
        return cls(np.stack(rows["pattern"]).reshape(*map(len, axes), -1), tuple((a[0], a[-1]) for a in axes), tuple(dims))

    @property
    def spacing(self) -> np.ndarray:
        return np.array([(hi - lo) / (n - 1) for (lo, hi), n in zip(self.bounds, self.patterns.shape)])

    def zoomed(self, factor: int) -> PatternMap:
        """The map with `factor` times as many points along each dimension, by linear interpolation between its ends."""
        out = self.patterns
        for axis, n in enumerate(self.patterns.shape[:-1]):
            at = np.linspace(0, n - 1, n * factor)
            below = np.minimum(at.astype(int), n - 2)
            share = (at - below).reshape([-1 if a == axis else 1 for a in range(out.ndim)])
            out = np.take(out, below, axis) * (1 - share) + np.take(out, below + 1, axis) * share
        return replace(self, patterns=out)

    def weighted(self, efficiency: Sequence[float]) -> PatternMap:
        """Each channel's part times its efficiency."""
        return replace(self, patterns=self.patterns * np.asarray(efficiency, float))

    def index(self, places: np.ndarray) -> np.ndarray:
        """Nearest grid indices of places (m, d); -1 in rows that lie over half a spacing outside, or have a NaN."""
        lo, hi = np.array(self.bounds).T
        inside = ((places >= lo - self.spacing / 2) & (places <= hi + self.spacing / 2)).all(axis=1)
        held = np.clip(np.where(np.isnan(places), lo, places), lo, hi - 0.01 * self.spacing)
        return np.where(inside[:, None], ((held - lo) / self.spacing + 0.5).astype(int), -1)

    def place(self, index: np.ndarray) -> np.ndarray:
        return np.array(self.bounds)[:, 0] + self.spacing * index

    def expected(self, places: np.ndarray) -> list:
        """Shares of each channel at places; None outside the map and where no light is expected."""
        out = []
        for i in self.index(places):
            pattern = self.patterns[tuple(i)] if (i >= 0).all() else np.zeros(1)
            out.append(pattern / pattern.sum() if pattern.sum() > 0 else None)
        return out

    def fits(self, part: tuple[slice, ...], seen: np.ndarray, use: np.ndarray, statistic: str, errors: float) -> np.ndarray:
        """Goodness at all points of a slice of the map for one peak; patterns are scaled to the total of the channels in use."""
        q = self.patterns[part][..., use]
        s = seen[use]
        with np.errstate(divide="ignore", invalid="ignore"):
            expected = q / q.sum(axis=-1, keepdims=True) * s.sum()
        return goodness(statistic, s, expected, (errors * s) ** 2)

    def window(self, centre: np.ndarray, size: float | None) -> tuple[slice, ...] | None:
        """The slice of points within size / 2 of a place along each dimension (None: all); None if no such place is in the map."""
        if size is None:
            return tuple(slice(0, n) for n in self.patterns.shape[:-1])
        lo, hi = np.array(self.bounds).T
        first, last = self.index(np.array([np.maximum(centre - size / 2, lo), np.minimum(centre + size / 2, hi)]))
        return None if (first < 0).any() or (last < 0).any() else tuple(slice(a, b + 1) for a, b in zip(first, last))


def contour(gof: np.ndarray, level: float) -> tuple[np.ndarray, bool]:
    """Points (k, 2), in grid indices, at which the line gof = level crosses the grid's edges around the minimum, and whether the region meets the border.

    The region is the part of the points under the level that hangs together with the minimum; a crossing lies between one of
    its points and a neighbour over the level, at the share of the way that the values give.
    """
    under = np.nan_to_num(gof, nan=np.inf) <= level
    region = np.zeros_like(under)
    region[np.unravel_index(np.nanargmin(gof), gof.shape)] = True
    while True:
        grown = region.copy()
        grown[1:] |= region[:-1]
        grown[:-1] |= region[1:]
        grown[:, 1:] |= region[:, :-1]
        grown[:, :-1] |= region[:, 1:]
        grown &= under
        if (grown == region).all():
            break
        region = grown
    out = []
    for axis in (0, 1):
        for sign in (1, -1):
            a, b = (slice(None, -1), slice(1, None)) if sign == 1 else (slice(1, None), slice(None, -1))
            a, b = ((a, slice(None)), (b, slice(None))) if axis == 0 else ((slice(None), a), (slice(None), b))
            i, j = np.nonzero(region[a] & ~under[b])
            inside, outside = gof[a][i, j], gof[b][i, j]
            step = np.where(np.isfinite(outside), (level - inside) / np.where(np.isfinite(outside), outside - inside, 1.0), 0.5)
            at = np.stack([i, j], axis=1).astype(float)
            at[:, axis] += step if sign == 1 else 1 - step
            out.append(at)
    edge = region[0].any() or region[-1].any() or region[:, 0].any() or region[:, -1].any()
    return np.concatenate(out), bool(edge)


def expected_patterns(places: DataFrame, patterns: PatternMap, dims: Sequence[str], name: str = "expected") -> DataFrame:
    """places with the expected share of each channel; null outside the map, for null coordinates and where no light is expected."""
    shared = places.sparkSession.sparkContext.broadcast(patterns)

    @F.pandas_udf("array<double>")
    def run(at: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.expected(at.to_numpy(float)), dtype=object)

    return places.withColumn(name, run(F.struct(*(F.col(d).cast("double") for d in dims))))


def fit_positions(
    peaks: DataFrame,
    areas: str,
    patterns: PatternMap,
    statistic: str = "chi2gamma",
    seeds: str | None = None,
    size: float | None = None,
    use: str | None = None,
    errors: float = 0.0,
    levels: Sequence[float] = (),
    coarse: int = 1,
    lost: int = 0,
) -> DataFrame:
    """peaks with the column fit: a place (x, y and z of the map's dimensions), gof, ndf, seed_gofs and contours.

    areas: array of the map's channels. seeds: array of structs with the dimensions' names; the one with the best fit is the
    centre of the window of `size` that is searched (None: the whole map). use: array of booleans; a channel that is out counts
    neither in the areas nor in the pattern. ndf: channels in use less `lost`. coarse: with a number over 1, that many points
    are stepped over at first, and the neighbourhood of the best is searched at the full grid; 1 tries all. levels: for each,
    a contour (level, x0, dx, y0, dy, at_edge) around the best of a map of two dimensions, at its gof plus the level.

    A peak without areas, without any in the channels in use, with all seeds outside the map or null, or with no finite fit
    has a null fit. Equal fits take the first point of the grid.
    """
    if statistic not in STATISTICS:
        raise ValueError(f"no statistic {statistic!r}; there are {', '.join(STATISTICS)}")
    if levels and len(patterns.names) != 2:
        raise ValueError("contours need a map of two dimensions")
    shared = peaks.sparkSession.sparkContext.broadcast(patterns)
    names, wanted = patterns.names, [float(v) for v in levels]
    lines = "array<struct<level: double, x0: double, dx: double, y0: double, dy: double, at_edge: boolean>>"
    kind = f"struct<{', '.join(f'{n}: double' for n in names)}, gof: double, ndf: int, seed_gofs: array<double>, contours: {lines}>"

    def one(m: PatternMap, seen, seed, used) -> dict | None:
        if seen is None:
            return None
        seen = np.asarray(seen, float)
        used = np.ones(len(seen), bool) if used is None else np.asarray(used, bool)
        if not used.any() or not seen[used].sum() > 0:
            return None
        centre, gofs = None, None
        if seeds is not None:
            at = np.array([[np.nan if s[n] is None else s[n] for n in names] for s in (seed if seed is not None else [])], float).reshape(-1, len(names))
            index = m.index(at)
            gofs = [float(m.fits(tuple(slice(k, k + 1) for k in i), seen, used, statistic, errors).ravel()[0]) if (i >= 0).all() else None for i in index]
            good = [(g, k) for k, g in enumerate(gofs) if g is not None and np.isfinite(g)]
            if not good:
                return None
            centre = at[min(good)[1]]
        part = m.window(centre, size if seeds is not None else None)
        if part is None:
            return None
        if coarse > 1:
            rough = m.fits(tuple(slice(p.start, p.stop, coarse) for p in part), seen, used, statistic, errors)
            if not np.isfinite(rough).any():
                return None
            near = np.array(np.unravel_index(np.nanargmin(rough), rough.shape)) * coarse + [p.start for p in part]
            searched = tuple(slice(max(p.start, int(k) - coarse), min(p.stop, int(k) + coarse + 1)) for p, k in zip(part, near))
        else:
            searched = part
        grid = m.fits(searched, seen, used, statistic, errors)
        if not np.isfinite(grid).any():
            return None
        best = np.unravel_index(np.nanargmin(grid), grid.shape)
        out = dict(zip(names, m.place(np.array(best) + [p.start for p in searched]).tolist()))
        out |= {"gof": float(grid[best]), "ndf": int(used.sum()) - lost, "seed_gofs": gofs, "contours": []}
        if wanted:
            grid, start = (m.fits(part, seen, used, statistic, errors), part) if coarse > 1 else (grid, searched)
            for level in wanted:
                points, edge = contour(grid, out["gof"] + level)
                row = {"level": level, "x0": None, "dx": None, "y0": None, "dy": None, "at_edge": edge}
                if len(points):
                    xy = m.place(points + [p.start for p in start])
                    low, high = xy.min(axis=0), xy.max(axis=0)
                    row |= {"x0": low[0], "dx": high[0] - low[0], "y0": low[1], "dy": high[1] - low[1]}
                out["contours"].append(row)
        return out

    @F.pandas_udf(kind)
    def run(given: pd.DataFrame) -> pd.DataFrame:
        fields = [*names, "gof", "ndf", "seed_gofs", "contours"]
        rows = [one(shared.value, a, s, u) or dict.fromkeys(fields) for a, s, u in zip(given["areas"], given["seeds"], given["used"])]
        return pd.DataFrame({f: pd.Series([r[f] for r in rows], dtype=object) for f in fields})

    struct = ", ".join(f"{n}: double" for n in names)
    seeded = F.col(seeds).cast(f"array<struct<{struct}>>") if seeds else F.lit(None).cast(f"array<struct<{struct}>>")
    usable = F.col(use).cast("array<boolean>") if use else F.lit(None).cast("array<boolean>")
    found = peaks.withColumn("fit", run(F.struct(F.col(areas).cast("array<double>").alias("areas"), seeded.alias("seeds"), usable.alias("used"))))
    return found.withColumn("fit", F.when(F.col("fit.gof").isNotNull(), F.col("fit")))


def goodness_at(peaks: DataFrame, areas: str, patterns: PatternMap, dims: Sequence[str], statistic: str, name: str = "gof", use: str | None = None, errors: float = 0.0) -> DataFrame:
    """peaks with the goodness of fit of their areas at their own place (columns dims); null outside the map, for null places or areas and without channels or areas in use."""
    shared = peaks.sparkSession.sparkContext.broadcast(patterns)

    @F.pandas_udf("double")
    def run(at: pd.DataFrame, seen: pd.Series, used: pd.Series) -> pd.Series:
        m, out = shared.value, []
        for i, s, u in zip(m.index(at.to_numpy(float)), seen, used):
            s = np.zeros(0) if s is None else np.asarray(s, float)
            u = np.ones(len(s), bool) if u is None else np.asarray(u, bool)
            ok = (i >= 0).all() and u.any() and s[u].sum() > 0
            out.append(float(m.fits(tuple(slice(k, k + 1) for k in i), s, u, statistic, errors).ravel()[0]) if ok else None)
        return pd.Series([None if v is None or np.isnan(v) else v for v in out], dtype=object)

    usable = F.col(use).cast("array<boolean>") if use else F.lit(None).cast("array<boolean>")
    return peaks.withColumn(name, run(F.struct(*(F.col(d).cast("double") for d in dims)), F.col(areas).cast("array<double>"), usable))
