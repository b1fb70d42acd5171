"""Peak splitting and pattern fits against plain rules on random inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.operators import pattern_fit as pf
from pulsemill.operators import peak_splits, waves


def bumpy(rng, n):
    """A waveform of a few bumps, noise and pedestals."""
    i = np.arange(n)
    w = rng.random(n) * rng.choice([0.1, 1.0, 3.0])
    for _ in range(rng.integers(1, 6)):
        w += rng.random() * 30 * np.exp(-0.5 * ((i - rng.integers(0, n)) / rng.integers(3, 40)) ** 2)
    return w


def test_local_line_is_a_weighted_fit():
    rng = np.random.default_rng(0)
    for n, reach, step in ((40, 15, 2), (9, 16, 2), (30, 4.0, 1), (3, 15, 2)):
        y = rng.random(n)
        x = step * np.arange(n)
        for k, got in enumerate(peak_splits.local_line(y, reach, step)):
            weight = (1 - np.clip(np.abs(x - x[k]) / reach, 0, 1) ** 3) ** 3
            near = weight > 0
            slope, at = np.polyfit(x[near] - x[k], y[near], 1, w=np.sqrt(weight[near]))
            assert got == pytest.approx(at, abs=1e-9)
    assert np.isnan(peak_splits.local_line(np.ones(1), 15, 2)).all()


def plain_minima(w, height):
    """The rule sample by sample, on one stretch (no quiet gap, not too long)."""
    high = [i for i, v in enumerate(w) if v > height]
    if not high or max(w) < height:
        return []
    left, right = max(0, high[0] - 500), min(len(w), high[-1] + 500)
    y = list(w[left:right:2])
    u = list(peak_splits.local_line(np.array(y), np.ceil(30 / (right - left) * len(y)), 2))
    n = len(u)
    lows = [k for k in range(1, n - 1) if u[k + 1] > u[k] and u[k] <= u[k - 1]]
    tops = [k for k in range(1, n - 1) if u[k + 1] <= u[k] and u[k] > u[k - 1]]
    out = []
    for k in lows:
        later, earlier = [t for t in tops if t > k], [t for t in tops if t < k]
        if later and earlier and u[later[0]] - u[k] > height and max(u[t] for t in earlier) - u[k] > height:
            out.append(left + 2 * k)
    return out


def test_minima_equal_the_plain_rule():
    rng = np.random.default_rng(5)
    found = 0
    for _ in range(300):
        w = bumpy(rng, int(rng.integers(4, 900)))
        height = float(rng.choice([0.5, 2.0, 8.0]))
        want = plain_minima(w, height)
        assert peak_splits.minimum_points(w, height) == want
        found += len(want)
    assert found > 100
    gap = np.concatenate([bumpy(rng, 300), np.zeros(1_800), bumpy(rng, 300)])
    parts = peak_splits.minimum_points(gap, 2.0)
    assert all(x < 900 or x > 1_500 for x in parts)
    assert peak_splits.minimum_points(np.abs(np.sin(np.arange(6_000) / 50)) * 9 + 3, 2.0) == []  # too long to smooth
    assert peak_splits.minimum_points(np.zeros(0), 1.0) == [] and peak_splits.minimum_points(np.ones(3), 5.0) == []


def test_tail_equals_the_plain_rule():
    rng = np.random.default_rng(6)
    found = 0
    for _ in range(100):
        w = np.clip(bumpy(rng, int(rng.integers(50, 600))) - 1, 0, None)
        main = [(i, v) for i, v in enumerate(w) if v > 0.02 * max(w)]
        area = sum(v for _, v in main)
        mean = sum(i * v for i, v in main) / area
        sigma = (sum((i - mean) ** 2 * v for i, v in main) / area) ** 0.5
        pdf = {i: np.exp(-((i - mean) ** 2) / (2 * sigma**2)) / (sigma * np.sqrt(2 * np.pi)) for i, _ in main}
        amplitude = sum(v * pdf[i] for i, v in main) / sum(p * p for p in pdf.values())
        want = [i for i, v in enumerate(w) if v < 0.001 * amplitude and i > mean + 2 * sigma][: int(max(w) >= 1.0)]
        assert peak_splits.tail_points(w, 1.0, 0.001) == want
        found += len(want)
    assert found > 20
    assert peak_splits.tail_points(np.array([0.0, 5.0, 0.0]), 1.0, 0.1) == []
    assert peak_splits.tail_points(np.zeros(4), 0.0, 0.1) == [] and peak_splits.tail_points(np.zeros(0), 1.0, 0.1) == []


def plain_pieces(hit, cuts, w, start):
    """Cut after cut: a hit across a cut becomes two, those without positive area go."""
    hits, new = [hit], []
    for x in cuts:
        kept = []
        for a, b in hits:
            if a <= x < b:
                pieces = [(a, x), (x + 1, b)]
                kept += [(p, q) for p, q in pieces if w[p - start : q - start + 1].sum() > 0]
                new = [*new, *pieces]
            else:
                kept.append((a, b))
        hits = kept
    return sorted(hits)


def test_hits_across_cuts_are_measured_again(spark):
    rng = np.random.default_rng(9)
    peaks, hits, pulses, want = [], [], [], []
    for peak in range(40):
        left = int(rng.integers(0, 100))
        right = left + int(rng.integers(30, 90))
        cuts = sorted({int(x) for x in rng.integers(0, right - left, rng.integers(0, 4))})
        peaks.append((peak, left, right, cuts))
        for pulse in range(3):
            start = left - int(rng.integers(0, 10))
            w = rng.normal(0.4, 1.0, right - start + 5)
            pulses.append((peak, pulse, start, w.tolist()))
            a = int(rng.integers(left, right - 5))
            b = int(rng.integers(a, right))
            x = w[a - start : b - start + 1]
            hits.append((peak, pulse, a, b, float(x.sum()), float(x.max()), a + int(x.argmax()), float(a), 0, 0.0))
            for p, q in plain_pieces((a, b), [left + c for c in cuts], w, start):
                y = w[p - start : q - start + 1]
                top = p + int(y.argmax())
                want.append((peak, pulse, p, q, round(float(y.sum()), 9), top, sum(left + c < top for c in cuts)))
    p = spark.createDataFrame(peaks, "peak int, left int, right int, points array<int>")
    h = spark.createDataFrame(hits, "peak int, pulse int, left int, right int, area double, height double, index_of_maximum int, center double, n_saturated long, sum_absolute_deviation double")
    u = spark.createDataFrame(pulses, "peak int, pulse int, start int, w array<double>")
    parts = peak_splits.split_hits(p, h, u, ["peak"], ["peak", "pulse"], 1.0).cache()
    got = [(r["peak"], r["pulse"], r["left"], r["right"], round(r["area"], 9), r["index_of_maximum"], r["part"]) for r in parts.collect()]
    assert sorted(got) == sorted(want) and len(got) > len(hits)
    made = {(r["peak"], r["part"]): (r["left"], r["right"], r["n_hits"]) for r in peak_splits.split_peaks(p, parts, ["peak"]).collect()}
    assert set(made) == {(g[0], g[6]) for g in want}
    for peak, left, right, cuts in peaks:
        edges = [left - 1, *(left + c for c in cuts), right]
        for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            n = sum(g[0] == peak and g[6] == part for g in want)
            assert made.get((peak, part)) == ((a + 1, b, n) if n else None)
    assert peak_splits.split_hits(p, h.limit(0), u, ["peak"], ["peak", "pulse"], 1.0).count() == 0


def test_no_cut_leaves_hits_as_they_are(spark):
    t = spark.createDataFrame([(1, "s1", [0.0, 9.0, 0.0]), (2, None, None)], "peak int, type string, w array<double>").withColumn("left", F.lit(0)).withColumn("right", F.lit(2))
    out = peak_splits.cut_points(t, "w", peak_splits.tail_points, 1.0, 0.5, only=F.col("type") != "s1")
    assert {r["peak"]: list(r["points"]) for r in out.collect()} == {1: [], 2: []}
    hits = waves.find_hits(t, ["peak"], "w", 1.0, 0, 0, 5.0)
    same = peak_splits.split_hits(out, hits, t.select("peak", F.lit(0).alias("start"), "w"), ["peak"], ["peak"], 5.0)
    assert same.drop("part").select(hits.columns).collect() == hits.collect()


def square(n=9, channels=25, dims=2, seed=0):
    rng = np.random.default_rng(seed)
    at = rng.uniform(-1, 1, (channels, dims))
    grid = np.stack(np.meshgrid(*[np.linspace(-1, 1, n)] * dims, indexing="ij"), axis=-1)
    q = 1 / (0.1 + ((grid[..., None, :] - at) ** 2).sum(axis=-1))
    return pf.PatternMap(q, ((-1.0, 1.0),) * dims, ("x", "y", "z")[:dims])


def plain_gof(statistic, q, seen, use, errors=0.0):
    total, out = sum(s for s, u in zip(seen, use) if u), 0.0
    part = sum(p for p, u in zip(q, use) if u)
    for p, s, u in zip(q, seen, use):
        if u:
            e = p / part * total
            if statistic == "chi2":
                out += (s - e) ** 2 / (e + (errors * s) ** 2)
            elif statistic == "chi2gamma":
                out += (s + (1 if s > 1 else s) - e) ** 2 / (e + (errors * s) ** 2 + 1)
            else:
                s2 = max(s, 1e-10)
                out += -2 * (s2 * np.log(e / s2) + s2 - e)
    return out


@pytest.mark.parametrize("statistic", pf.STATISTICS)
@pytest.mark.parametrize("dims", [2, 3])
def test_fits_equal_trying_all_places(spark, statistic, dims):
    m = square(7, 20, dims)
    rng = np.random.default_rng(dims)
    rows = []
    for k in range(25):
        q = m.patterns[tuple(rng.integers(0, 7, dims))]
        seen = rng.poisson(200 * q / q.sum()).astype(float)
        seeds = [tuple(rng.uniform(-1.4, 1.4, dims).tolist()) for _ in range(3)]
        rows.append((k, seen.tolist(), seeds, [bool(x) for x in rng.random(20) > 0.2]))
    kind = ", ".join(f"{n}: double" for n in m.names)
    df = spark.createDataFrame(rows, f"k int, areas array<double>, seeds array<struct<{kind}>>, use array<boolean>")
    got = {r["k"]: r["fit"] for r in pf.fit_positions(df, "areas", m, statistic, seeds="seeds", size=0.9, use="use", errors=0.05, lost=dims).collect()}
    places = np.linspace(-1, 1, 7)
    gap = places[1] - places[0]
    near = lambda v: int((min(max(v, -1.0), 1.0 - 0.01 * gap) + 1.0) / gap + 0.5)
    for k, seen, seeds, use in rows:
        scored = [(plain_gof(statistic, m.patterns[tuple(near(v) for v in s)], seen, use, 0.05), s) for s in seeds if all(-1 - gap / 2 <= v <= 1 + gap / 2 for v in s)]
        if not scored:
            assert got[k] is None
            continue
        centre = min(scored)[1]
        boxes = [range(near(max(v - 0.45, -1.0)), near(min(v + 0.45, 1.0)) + 1) for v in centre]
        points = [tuple(i) for i in np.stack(np.meshgrid(*boxes, indexing="ij"), -1).reshape(-1, dims)]
        gof, best = min((plain_gof(statistic, m.patterns[p], seen, use, 0.05), p) for p in points)
        assert got[k]["gof"] == pytest.approx(gof) and [got[k][n] for n in m.names] == pytest.approx([places[i] for i in best])
        assert got[k]["ndf"] == sum(use) - dims and min(g for g in got[k]["seed_gofs"] if g is not None) == pytest.approx(min(scored)[0])


def test_positions_that_cannot_be_fitted_are_null(spark):
    m = square()
    rows = [(1, None, [(0.0, 0.0)], None), (2, [0.0] * 25, [(0.0, 0.0)], None), (3, [1.0] * 25, [(None, 0.0), (9.0, 9.0)], None), (4, [1.0] * 25, None, None), (5, [1.0] * 25, [], None), (6, [1.0] * 25, [(0.0, 0.0)], [False] * 25), (7, [1.0] * 25, [(0.0, 0.0)], None)]
    df = spark.createDataFrame(rows, "k int, areas array<double>, seeds array<struct<x: double, y: double>>, use array<boolean>")
    got = {r["k"]: r["fit"] for r in pf.fit_positions(df, "areas", m, seeds="seeds", size=1.0, use="use").collect()}
    assert {k for k, f in got.items() if f is not None} == {7}
    assert pf.fit_positions(df.limit(0), "areas", m).count() == 0
    with pytest.raises(ValueError):
        pf.fit_positions(df, "areas", m, "no")
    with pytest.raises(ValueError):
        pf.fit_positions(df, "areas", square(dims=3), levels=[1.0])


def test_coarse_search_finds_the_same_place_of_a_smooth_fit(spark):
    m = square(13, 30).zoomed(3)
    rng = np.random.default_rng(3)
    q = [m.patterns[tuple(rng.integers(4, 35, 2))] for _ in range(20)]
    df = spark.createDataFrame([(k, (1000 * p / p.sum()).tolist()) for k, p in enumerate(q)], "k int, areas array<double>")
    full = {r["k"]: r["fit"] for r in pf.fit_positions(df, "areas", m, "likelihood_poisson").collect()}
    quick = {r["k"]: r["fit"] for r in pf.fit_positions(df, "areas", m, "likelihood_poisson", coarse=4).collect()}
    assert all((full[k]["x"], full[k]["y"]) == (quick[k]["x"], quick[k]["y"]) for k in full)


def test_zoom_keeps_planes_and_ends():
    x, y = np.meshgrid(np.arange(4.0), np.arange(3.0), indexing="ij")
    m = pf.PatternMap(np.stack([2 * x + 3 * y, x * 0 + 1], axis=-1), ((0.0, 3.0), (0.0, 2.0)), ("x", "y")).zoomed(5)
    assert m.patterns.shape == (20, 15, 2) and m.patterns[-1, -1].tolist() == [12.0, 1.0]
    gx, gy = np.meshgrid(np.linspace(0, 3, 20), np.linspace(0, 2, 15), indexing="ij")
    assert np.allclose(m.patterns[..., 0], 2 * gx + 3 * gy) and np.allclose(m.place(np.array([19, 14])), [3, 2])


def test_contours_of_ellipses():
    for a, b, level in ((0.1, 0.3, 4.0), (0.5, 0.2, 1.0)):
        x, y = np.meshgrid(np.linspace(-2, 2, 201), np.linspace(-2, 2, 201), indexing="ij")
        points, edge = pf.contour((x / a) ** 2 + (y / b) ** 2, level)
        xy = -2 + 4 / 200 * points
        assert not edge and np.ptp(xy[:, 0]) == pytest.approx(2 * a * level**0.5, rel=0.02) and np.ptp(xy[:, 1]) == pytest.approx(2 * b * level**0.5, rel=0.02)
        assert ((xy[:, 0] / a) ** 2 + (xy[:, 1] / b) ** 2 == pytest.approx(level, rel=0.05))
    two = np.minimum((x + 1) ** 2 + y**2, (x - 1) ** 2 + y**2 + 0.01)
    points, edge = pf.contour(two, 0.1)
    assert (-2 + 4 / 200 * points[:, 0]).max() < 0 and not edge  # not the other minimum
    assert pf.contour(x**2 + y**2, 9.0)[1]
    hole = x**2 + y**2
    hole[:80] = np.nan
    points, edge = pf.contour(hole, 1.0)
    assert not np.isnan(points).any()


def test_contours_in_fits(spark):
    m = square(41, 30)
    q = m.patterns[20, 20]
    df = spark.createDataFrame([(1, (60 * q / q.sum()).tolist())], "k int, areas array<double>")
    fit = pf.fit_positions(df, "areas", m, "likelihood_poisson", levels=[1.0, 4.0]).first()["fit"]
    one, four = fit["contours"]
    assert (fit["x"], fit["y"]) == (pytest.approx(0, abs=1e-9), pytest.approx(0, abs=1e-9)) and fit["gof"] == pytest.approx(0, abs=1e-6)
    assert 0 < one["dx"] < four["dx"] and 0 < one["dy"] < four["dy"] and one["x0"] < 0 < one["x0"] + one["dx"] and not four["at_edge"]
    assert four["dx"] / one["dx"] == pytest.approx(2, rel=0.25)


def test_expected_patterns_and_maps_from_tables(spark):
    m = square(5, 6)
    axis = np.linspace(-1, 1, 5)
    rows = [(float(axis[i]), float(axis[j]), m.patterns[i, j].tolist()) for i in range(5) for j in range(5)]
    table = spark.createDataFrame(rows, "x double, y double, pattern array<double>").repartition(4)
    again = pf.PatternMap.from_table(table, ["x", "y"], "pattern")
    assert np.array_equal(again.patterns, m.patterns) and again.bounds == m.bounds
    with pytest.raises(ValueError, match="limit"):
        pf.PatternMap.from_table(table, ["x", "y"], "pattern", most_bytes=100)
    with pytest.raises(ValueError, match="full grid"):
        pf.PatternMap.from_table(table.filter("x < 1 or y < 1"), ["x", "y"], "pattern")
    at = spark.createDataFrame([(1, 0.0, 0.49), (2, 1.2, 0.0), (3, 1.3, 0.0), (4, None, 0.0)], "k int, x double, y double")
    got = {r["k"]: r["expected"] for r in pf.expected_patterns(at, again, ["x", "y"]).collect()}
    for k, i in ((1, (2, 3)), (2, (4, 2))):
        assert got[k] == pytest.approx((m.patterns[i] / m.patterns[i].sum()).tolist())
    assert got[3] is None and got[4] is None
    weighted = m.weighted([0, 1, 1, 1, 1, 1])
    assert weighted.patterns[..., 0].max() == 0 and np.array_equal(weighted.patterns[..., 1:], m.patterns[..., 1:])
