"""Whole-tree flattening, band-pass, long runs, the composed hit finder, rejection, hooks and corrections against plain rules."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsemill.functions import statistics
from pulsemill.operators import interactions, peaks, waves
from pulsemill.operators.pattern_fit import PatternMap
from pulsemill.plans import hooks, pipelines
from pulsemill.sources import tree

TREE = "event long, name string, peaks array<struct<area: double, shape: array<double>, hits array<struct<channel: int, parts array<struct<v: int>>>>>>, tags array<struct<t: string>>".replace("hits array", "hits: array").replace("parts array", "parts: array")


def forest(rng):
    rows = []
    for e in rng.permutation(60).tolist():
        kids = [{"area": float(k), "shape": [1.0, 2.0][: k % 3], "hits": [{"channel": h, "parts": [{"v": int(rng.integers(0, 9))} for _ in range(rng.integers(0, 3))]} for h in range(rng.integers(0, 4))]} for k in range(rng.integers(0, 4))]
        rows.append((e, f"n{e}", kids, [{"t": str(t)} for t in range(rng.integers(0, 2))]))
    return rows


def test_trees_of_four_levels_round_trip(spark):
    rows = forest(np.random.default_rng(1))
    df = spark.createDataFrame(rows, TREE).repartition(5)
    tables = tree.flatten_tree(df, ["event"])
    assert set(tables) == {"", "peaks", "peaks.hits", "peaks.hits.parts", "tags"}
    assert tables["peaks.hits"].columns == ["event", "peaks_index", "hits_index", "channel", "n_parts", "parts_start"]
    again = tree.nest_tree(tables, ["event"], df.schema)
    plain = lambda d: sorted(str(r.asDict(True)) for r in d.collect())
    assert plain(again) == plain(df) and again.columns == df.columns
    # Starts and numbers, by going through the tree in order.
    events = sorted(rows)
    at = {"peaks": 0, "hits": 0, "parts": 0}
    want = {"": set(), "peaks": set(), "peaks.hits": set()}
    for e, _, kids, _ in events:
        want[""].add((e, len(kids), at["peaks"]))
        at["peaks"] += len(kids)
        for i, p in enumerate(kids):
            want["peaks"].add((e, i, len(p["hits"]), at["hits"]))
            at["hits"] += len(p["hits"])
            for j, h in enumerate(p["hits"]):
                want["peaks.hits"].add((e, i, j, len(h["parts"]), at["parts"]))
                at["parts"] += len(h["parts"])
    got = {"": tables[""].select("event", "n_peaks", "peaks_start"), "peaks": tables["peaks"].select("event", "peaks_index", "n_hits", "hits_start"), "peaks.hits": tables["peaks.hits"].select("event", "peaks_index", "hits_index", "n_parts", "parts_start")}
    for name, table in got.items():
        assert set(map(tuple, table.collect())) == want[name]


def test_null_lists_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, "b", [], [{"t": None}])], TREE)
    tables = tree.flatten_tree(df, ["event"])
    assert [tuple(r) for r in tables[""].orderBy("event").collect()] == [(1, "a", 0, 0, 0, 0), (2, "b", 0, 0, 1, 0)]
    assert tree.nest_tree(tables, ["event"], df.schema).filter("size(peaks) = 0").count() == 2
    assert tree.flatten_tree(df.limit(0), ["event"])["peaks"].count() == 0
    clash = spark.createDataFrame([(1, [(5,)])], "event long, peaks array<struct<event: int>>")
    with pytest.raises(ValueError, match="clash"):
        tree.flatten_tree(clash, ["event"])


def test_band_pass_has_no_phase_and_the_right_gain():
    low, high = 0.1, 0.4
    n = 400
    impulse = np.zeros((1, n))
    impulse[0, n // 2] = 1
    y = waves.band_passed(impulse, low, high)[0]
    assert np.allclose(y[n // 2 - 80 : n // 2], y[n // 2 + 80 : n // 2 : -1], atol=1e-12) and y.argmax() == n // 2
    # |H|^2 of the analogue filter at the warped frequency: both passes together.
    gain = np.abs(np.fft.rfft(y))
    lo, hi = math.tan(math.pi * low / 2), math.tan(math.pi * high / 2)
    for k in (5, 20, 40, 60, 100, 150):
        w = math.tan(math.pi * k / n)
        assert gain[k] == pytest.approx(1 / (1 + ((w * w - lo * hi) / (w * (hi - lo))) ** 2), rel=2e-3, abs=2e-4)
    flat = np.full((2, 50), [[3.0], [-1.0]])
    assert np.allclose(waves.band_passed(flat, low, high), 0, atol=1e-12)
    for wrong in ((0.0, 0.5), (0.5, 0.2), (0.2, 1.0)):
        with pytest.raises(ValueError):
            waves.band_pass_coefficients(*wrong)


def test_band_pass_of_rows_equals_a_recursion_by_hand(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=n).tolist()) for k, n in enumerate((30, 30, 12, 5, 2, 1))] + [(10, None), (11, [])]
    got = {r["k"]: r["filtered"] for r in waves.band_pass(spark.createDataFrame(rows, "k int, w array<double>"), ["k"], "w", 0.2, 0.5).collect()}
    b, a1, a2 = waves.band_pass_coefficients(0.2, 0.5)

    def once(x):
        # A long lead-in of the first value instead of a computed steady state.
        x = [x[0]] * 400 + list(x)
        y = [0.0, 0.0]
        for i in range(2, len(x)):
            y.append(b * (x[i] - x[i - 2]) - a1 * y[-1] - a2 * y[-2])
        return y[400:]

    for k, w in rows[:5]:
        pad = min(9, len(w) - 1)
        x = [2 * w[0] - w[i] for i in range(pad, 0, -1)] + w + [2 * w[-1] - w[-2 - i] for i in range(pad)]
        assert got[k] == pytest.approx(once(once(x)[::-1])[::-1][pad : pad + len(w)], abs=1e-9)
    assert got[5] == [0.0] and got[10] is None and got[11] == []


def plain_runs(w, threshold):
    out, i = [], 0
    while i < len(w):
        if w[i] > threshold:
            j = i
            while j + 1 < len(w) and w[j + 1] > threshold:
                j += 1
            start = i
            if j - i > 350:
                u = np.convolve(w[i:j], np.ones(100), "same") / 100
                for k in range(1, len(u) - 1):
                    if u[k] <= u[k - 1] and u[k + 1] > u[k]:
                        out.append((start, i + k))
                        start = i + k + 1
            out.append((start, j))
            i = j
        i += 1
    return out


def test_long_runs_are_cut_at_minima(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k, n in enumerate((30, 351, 352, 353, 700, 900, 1200)):
        w = 50 + 8 * np.round(np.sin(np.arange(n) / 60) * 4) + rng.integers(0, 3, n)
        w[rng.integers(0, n)] = 0
        rows.append((k, w.astype(float).tolist()))
    df = spark.createDataFrame(rows, "k int, w array<double>").select("k", waves.split_long_runs(F.col("w"), waves.runs_in_array(F.col("w"), 10.0)).alias("runs"))
    for r in df.collect():
        assert [tuple(x) for x in r["runs"]] == plain_runs(np.array(rows[r["k"]][1]), 10)
    assert sum(len(r["runs"]) for r in df.collect()) > 12


def test_hits_of_pulses_equal_plain_rules(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(40):
        w = 16000 - rng.integers(0, 12, 120)
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(20, 110))
            w[at : at + 5] -= rng.integers(20, 20_000)
        rows.append((k, np.clip(w, 0, None).tolist(), k % 7 != 3))
    df = spark.createDataFrame(rows, "k int, raw array<int>, alive boolean")
    out = waves.find_pulse_hits(df, ["k"], "raw", 16000.0, 10, 5.0, 15.0, 0.1, 2, 4, factor=0.5, alive=F.col("alive"), most=2)
    got = {r["k"]: r for r in out.collect()}
    for k, raw, alive in rows:
        v = 16000.0 - np.array(raw, float)
        base = v[:10].mean()
        w = v - base
        noise = np.sqrt((w[w < 0] ** 2).mean()) if (w < 0).any() else 0.0
        assert got[k]["baseline"] == pytest.approx(base) and got[k]["noise_sigma"] == pytest.approx(noise)
        if not alive:
            assert got[k]["threshold"] is None and got[k]["n_hits_found"] == 0 and got[k]["hits"] == []
            continue
        level = math.floor(max(5 * noise, 15.0, -0.1 * w.min()))
        runs = plain_runs(w, level)[:2]
        assert got[k]["threshold"] == level and got[k]["n_hits_found"] == len(runs)
        want, last = [], -1
        for i, (a, b) in enumerate(runs):
            stop = min([b + 4, len(w) - 1, *(r[0] - 1 for r in runs[i + 1 : i + 2])])
            start = max(a - 2, last + 1, 0)
            last = stop
            x = w[start : stop + 1]
            if x.sum() > 0:
                want.append((start, stop, 0.5 * x.sum(), 0.5 * x.max(), start + int(x.argmax()), int((x > 16000 - base - 0.5).sum())))
        assert [(h["left"], h["right"], pytest.approx(h["area"]), pytest.approx(h["height"]), h["index_of_maximum"], h["n_saturated"]) for h in got[k]["hits"]] == want
    assert any(h["n_saturated"] for r in got.values() for h in r["hits"])
    one = waves.find_pulse_hits(df.filter("k = 0"), ["k"], "raw", 16000.0, 10, 5.0, 15.0, 0.1, 2, 4, single=(3, 8)).first()
    assert [(h["left"], h["right"]) for h in one["hits"]] == [(3, 8)]
    empty = spark.createDataFrame([(1, []), (2, None)], "k int, raw array<int>")
    assert all(not r["hits"] for r in waves.find_pulse_hits(empty, ["k"], "raw", 16000.0, 10, 5.0, 15.0, 0.1, 2, 4).collect())


def test_rejection_rebuilds_and_drops_peaks(spark):
    hits = [(1, 1, 0, 5.0, 10), (1, 1, 1, 3.0, 12), (1, 2, 0, 2.0, 50), (1, 3, 0, 1.0, 70), (1, 3, 2, 40.0, 69), (1, 4, 3, 1.0, 90), (2, 1, 0, 5.0, 5)]
    df = spark.createDataFrame([(e, p, c, a, i, i + 2, i + 1) for e, p, c, a, i in hits], "event int, peak int, channel int, area double, left int, right int, index_of_maximum int")
    lone = spark.createDataFrame([(1, 0, 50)] * 3 + [(1, 3, 90), (1, 0, 999)], "event int, channel int, left int")
    noise = spark.createDataFrame([(1, 0)] * 4, "event int, channel int")
    penalties = peaks.channel_penalties(lone, noise, {3: 0.5, 1: 9.0}, ["event"], 0.5, 1.0, 100)
    assert sorted(map(tuple, penalties.collect())) == [(1, 0, 5.0), (1, 1, 9.0), (1, 3, 1.5)]
    marked, made, counts = peaks.reject_and_rebuild(df, penalties.filter("channel <> 1"), ["event"], "peak", 2.0)
    assert sorted((r["event"], r["peak"], r["channel"]) for r in marked.filter("is_rejected").collect()) == [(1, 1, 0), (1, 2, 0)]
    got = {(r["event"], r["peak"]): (r["area"], r["n_hits"], r["left"], r["lone"], r["suspicious_channels"]) for r in made.collect()}
    assert got == {(1, 1): (3.0, 1, 12, True, [0]), (1, 3): (41.0, 2, 69, False, [0]), (1, 4): (1.0, 1, 90, True, []), (2, 1): (5.0, 1, 5, True, [])}
    assert sorted(map(tuple, counts.collect())) == [(1, 0, 2, 0), (1, 1, 0, 1), (1, 3, 0, 1), (2, 0, 0, 1)]


@pytest.fixture()
def stages():
    before = dict(pipelines.STAGES)
    yield
    pipelines.STAGES.clear()
    pipelines.STAGES.update(before)


HITS = [(1, 1, t, c, float(a)) for t, c, a in ((0, 1, 2), (4, 2, 3), (100, 1, 5), (101, 3, 1))] + [(1, 2, 7, 1, 1.0)]


def hit_frame(spark):
    return spark.createDataFrame(HITS, "event int, peak_id int, index_of_maximum int, channel int, area double").withColumn("left", F.col("index_of_maximum")).withColumn("right", F.col("left") + 1)


def test_a_users_clusterer_runs_in_a_named_pipeline(spark, stages):
    @hooks.clusterer("by_gap", finalize=lambda df: df.withColumn("seen", F.lit(True)))
    def by_gap(hits):
        return (hits["index_of_maximum"].diff().fillna(0) > 50).cumsum()

    out = pipelines.Pipeline(["by_gap"], {"by_gap": {"keys": ["event", "peak_id"], "rebuild": True}}).run(hit_frame(spark))
    assert sorted((r["peak_id"], r["part"], r["area"], r["n_channels"], r["seen"]) for r in out.collect()) == [(1, 0, 5.0, 2, True), (1, 1, 6.0, 2, True), (2, 0, 1.0, 1, True)]
    rows = pipelines.Pipeline(["by_gap"], {"DEFAULT": {"keys": ["event", "peak_id"]}}).run(hit_frame(spark))
    assert sorted(r["part"] for r in rows.collect()) == [0, 0, 0, 1, 1]
    with pytest.raises(ValueError, match="already"):
        hooks.clusterer("by_gap")(by_gap)

    @hooks.clusterer("wrong")
    def wrong(hits):
        return [0]

    with pytest.raises(Exception, match="one number a hit"):
        pipelines.Pipeline(["wrong"], {"wrong": {"keys": ["event", "peak_id"]}}).run(hit_frame(spark)).count()


def test_a_clusterer_in_sql(spark):
    hooks.register_clusterer(spark, "gap_parts", lambda times, areas: np.cumsum([0, *(np.diff(times) > 50)]).tolist() if times else [])
    spark.createDataFrame([(1, [0.0, 4.0, 100.0], [1.0, 1.0, 1.0]), (2, [], [])], "peak int, times array<double>, areas array<double>").createOrReplaceTempView("peaks_of_hits")
    got = spark.sql("select peak, hit, part from peaks_of_hits, lateral gap_parts(times, areas)").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0), (1, 1, 0), (1, 2, 1)]


def test_a_users_position_follows_the_contract(spark, stages):
    @hooks.position_hook("middle")
    def middle(areas, x, y):
        if areas.max() > 50:
            return None
        if areas.max() > 40:
            return {"x": 1.0, "y": float("nan"), "goodness_of_fit": 2.0, "ndf": 3}
        return (areas * x).sum() / areas.sum(), (areas * y).sum() / areas.sum()

    rows = [(1, [1.0, 3.0, 9.0], False), (2, [0.0, 0.0, 9.0], False), (3, [60.0, 1.0, 1.0], False), (4, [1.0, 1.0, 1.0], True), (5, [45.0, 1.0, 1.0], False), (6, None, None)]
    df = spark.createDataFrame(rows, "k int, areas array<double>, lone boolean")
    out = pipelines.Pipeline(["middle"], {"middle": {"areas": "areas", "x": [0.0, 4.0], "y": [1.0, 1.0]}}).run(df)
    got = {r["k"]: (r["middle"]["algorithm"], r["middle"]["x"], r["middle"]["y"], r["middle"]["goodness_of_fit"], r["middle"]["ndf"]) for r in out.collect()}
    none = ("middle", None, None, None, None)
    assert got == {1: ("middle", 3.0, 1.0, None, None), 2: none, 3: none, 4: none, 5: ("middle", 1.0, None, 2.0, 3), 6: none}


def test_a_users_aggregate_and_fields(spark):
    @hooks.aggregate_hook("double")
    def span(v: pd.Series) -> float:
        return float(v.max() - v.min())

    out = hit_frame(spark).groupBy("peak_id").agg(span("index_of_maximum").alias("span"))
    assert sorted(map(tuple, out.collect())) == [(1, 101.0), (2, 0.0)]
    more = hooks.extra_fields(hit_frame(spark), {"twice": "area * 2", "four": "twice + twice"})
    assert more.agg(F.sum("four")).first()[0] == 48.0
    for fields in ({"x": "nothing + 1"}, {"area": "1"}, {"x": "sum(area)"}, {"x": "import os"}):
        with pytest.raises(ValueError, match="extra field"):
            hooks.extra_fields(hit_frame(spark), fields)
    out = pipelines.Pipeline(["extra_fields"], {"extra_fields": {"fields": {"half": "area / 2"}}}).run(hit_frame(spark))
    assert out.columns[-1] == "half"


def test_interactions_are_corrected(spark):
    grid = np.linspace(-1, 1, 3)
    patterns = PatternMap(np.ones((3, 3, 3, 4)) * [1.0, 2.0, 3.0, 4.0], ((-1.0, 1.0), (-1.0, 1.0), (-2.0, 0.0)), ("x", "y", "z"))
    light = spark.createDataFrame([(float(x), float(y), float(z), 0.5) for x in grid for y in grid for z in grid], "x double, y double, z double, light_yield double")
    charge = spark.createDataFrame([(float(x), float(y), 0.25) for x in grid for y in grid], "x double, y double, light_yield double")
    pairs = spark.createDataFrame([(1, 0, 1, 100, 0.2, 0.1), (2, 0, 1, 100, None, 0.0), (3, 0, 1, 100, 9.0, 0.0)], "event int, s1 int, s2 int, drift_time int, x double, y double")
    s1 = spark.createDataFrame([(e, 0, 10.0, [1.0, 2.0, 7.0, 0.0], [1.0, 1.0, 3.0, 0.0], [False, False, False, True]) for e in (1, 2, 3)], "event int, peak_id int, area double, areas array<double>, hits array<double>, confused array<boolean>")
    s2 = spark.createDataFrame([(1, 1, 100.0, 1.5), (2, 1, 100.0, None), (3, 1, 100.0, None)], "event int, peak_id int, area double, saturation_correction double")
    out = interactions.corrected_interactions(pairs, s1, s2, ["event"], 0.01, 10.0, 500.0, light, charge, patterns, "chi2", saturation=True)
    got = {r["event"]: r for r in out.collect()}
    decay = math.exp(100 / 500)
    one = got[1]
    assert one["z"] == pytest.approx(-0.9) and one["s1_spatial_correction"] == pytest.approx(2) and one["s2_spatial_correction"] == pytest.approx(4)
    assert one["s1_saturation_correction"] == pytest.approx((10 + 4 * 10 / 6) / 10)  # channel 3 as the others say
    expected = np.array([1, 2, 3]) / 6 * 10
    assert one["s1_pattern_fit"] == pytest.approx((((np.array([1, 2, 7]) - expected) ** 2) / expected).sum())
    assert one["s1_pattern_fit_hits"] == pytest.approx((((np.array([1, 1, 3]) - expected / 2) ** 2) / (expected / 2)).sum())
    assert one["cs2"] == pytest.approx(100 * decay * 4 * 1.5) and one["cs1"] == pytest.approx(10 * 2 * one["s1_saturation_correction"])
    assert got[2]["s1_pattern_fit"] is None and got[2]["cs1"] is None and got[3]["s1_pattern_fit"] is None and got[3]["s1_saturation_correction"] == 1
    bare = interactions.corrected_interactions(pairs, s1, s2, ["event"], 0.01, 10.0, 500.0).filter("event = 2").first()
    assert bare["cs1"] == 10 and bare["cs2"] == pytest.approx(100 * decay) and bare["s1_pattern_fit"] is None


def test_area_fraction_top_blends_hits_below_the_limit(spark):
    rows = [(0.4, 40.0, 0.5, 30, 0.1), (0.4, 5.0, 0.2, 8, 0.5), (None, 5.0, 0.2, 8, 0.5)]
    df = spark.createDataFrame(rows, "p double, area double, aft double, hits int, hft double")
    got = [r[0] for r in df.select(statistics.area_fraction_top_p_value(F.col("p"), F.col("area"), F.col("aft"), F.col("hits"), F.col("hft"))).collect()]
    assert got[0] == pytest.approx(statistics.binomial_test(20.0, 40.0, 0.4))
    assert got[1] == pytest.approx(statistics.binomial_test(4 * 0.5 + 1 * 0.5, 8 * 0.5 + 5 * 0.5, 0.4)) and got[2] is None
