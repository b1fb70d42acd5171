import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.functions import statistics, units
from pulsemill.operators import interactions, islands, peaks, positions, relational, splitting, trigger, waves
from pulsemill.plans import pipelines
from pulsemill.sources import flat
from pulsemill.streaming import event_builder

P = "pulse_id long, time long, pmt int, area double"


def pulses(spark, times, area=100.0):
    return spark.createDataFrame([(i, t, i % 3, area) for i, t in enumerate(times)], P)


def brute_sessions(times, gap):
    """Lists of indices of ordered times; a new one where the step to the next is gap or more."""
    out = []
    for i, t in enumerate(times):
        if i and t - times[i - 1] < gap:
            out[-1].append(i)
        else:
            out.append([i])
    return out


@pytest.mark.parametrize("seed, n, gap", [(0, 0, 5), (1, 1, 5), (2, 2, 9), (3, 60, 4), (4, 200, 7)])
@pytest.mark.parametrize("bucket", [3, 50, 10**6])
def test_signals(spark, seed, n, gap, bucket):
    t = np.sort(np.random.default_rng(seed).integers(0, 6 * n + 1, n)).tolist()
    got = sorted((r["left_time"], r["right_time"], r["n_pulses"]) for r in trigger.find_signals(pulses(spark, t), gap, bucket).collect())
    assert got == [(t[g[0]], t[g[-1]], len(g)) for g in brute_sessions(t, gap) if len(g) > 1]


def test_signal_moments(spark):
    r = trigger.find_signals(pulses(spark, [100, 101, 105]), 5).first()
    assert r["area"] == 300 and np.isclose(r["time_mean"], 2) and np.isclose(r["time_rms"], np.std([0, 1, 5]))


def test_sessions_do_not_depend_on_buckets(spark):
    t = np.cumsum(np.random.default_rng(0).integers(0, 9, 300)).tolist()
    want = np.cumsum([1, *(np.diff(t) >= 4)]).tolist()
    for bucket in (1, 7, 100, 10**6):
        got = islands.gap_sessions(pulses(spark, t), "time", "pulse_id", 4, bucket).orderBy("pulse_id").collect()
        assert [r["session"] for r in got] == want


def test_trigger_groups(spark):
    rng = np.random.default_rng(11)
    starts = np.sort(rng.choice(5000, 40, replace=False))
    spans = [(int(a), int(a + rng.integers(0, 30))) for a in starts]
    s = spark.createDataFrame(spans, "left_time long, right_time long")
    got = sorted((r["start"], r["stop"], r["n_triggers"]) for r in trigger.event_ranges(s, 90, 20, 35).collect())
    groups = brute_sessions([a for a, _ in spans], 90)
    assert got == [(spans[g[0]][0] - 20, max(spans[i][1] for i in g) + 35, len(g)) for g in groups] and 1 < len(groups) < 40
    with pytest.raises(ValueError):
        trigger.event_ranges(s, 50, 20, 35)


def test_signals_in_ranges(spark):
    rng = np.random.default_rng(12)
    times = sorted(rng.integers(0, 400, 50).tolist())
    edges = sorted(rng.choice(400, 12, replace=False).tolist())
    spans = list(zip(edges[::2], edges[1::2]))
    s, r = spark.createDataFrame([(t,) for t in times], "left_time long"), spark.createDataFrame(spans, "start long, stop long")
    for width in (7, 64, 1000):
        got = sorted((x["left_time"], x["start"]) for x in trigger.signals_in_events(s, r, width).collect())
        assert got == sorted((t, a) for t in times for a, b in spans if a <= t <= b)


SEC = 10**9


@pytest.mark.parametrize("seed", range(4))
def test_dead_time(spark, seed):
    rng = np.random.default_rng(seed)
    times = sorted(rng.choice(20 * SEC, 30, replace=False).tolist())
    turns = [(t, bool(rng.integers(0, 2))) for t in times]
    want, since = np.zeros(21), None
    for t, on in turns:
        if on and since is None:
            since = t
        elif not on and since is not None:
            for k in range(21):
                want[k] += max(0, min(t, (k + 1) * SEC) - max(since, k * SEC))
            since = None
    marks = spark.createDataFrame([("clock", t, on) for t, on in turns], "system string, time long, on boolean")
    got = {r["interval"]: r["dead_ns"] for r in trigger.dead_time(marks, SEC).collect()}
    assert all(got.get(k, 0) == want[k] for k in range(21))


def wave(spark, *w):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(w)], "k int, w array<double>")


def brute_runs(w, threshold):
    out = []
    for i, x in enumerate(w):
        if x > threshold and out and out[-1][1] == i - 1:
            out[-1][1] = i
        elif x > threshold:
            out.append([i, i])
    return [tuple(r) for r in out]


def brute_extended(runs, left_by, right_by, last):
    rights = [min(b + right_by, last, *(runs[k + 1][0] - 1 for _ in [0] if k + 1 < len(runs))) for k, (_, b) in enumerate(runs)]
    return [(max(a - left_by, rights[k - 1] + 1 if k else 0, 0), rights[k]) for k, (a, _) in enumerate(runs)]


WAVES = [np.random.default_rng(i).normal(0, 1, n).round(3).tolist() for i, n in enumerate((0, 1, 2, 7, 40, 40, 150))] + [[2.0] * 9, [-2.0] * 9, [2.0, -2.0] * 6]


def by_row(df):
    return {r["k"]: [tuple(x) for x in r["x"]] for r in df.collect()}


def by_key(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r["k"], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("left_by, right_by", [(0, 0), (1, 2), (3, 1), (50, 50)])
def test_runs_and_extensions(spark, left_by, right_by):
    df = wave(spark, *WAVES)
    runs = {k: brute_runs(w, 0.4) for k, w in enumerate(WAVES)}
    grown = {k: brute_extended(r, left_by, right_by, len(WAVES[k]) - 1) for k, r in runs.items()}
    held = df.withColumn("r", islands.runs_in_array(F.col("w"), 0.4))
    assert by_row(held.select("k", F.col("r").alias("x"))) == runs
    assert by_row(held.select("k", islands.extended_in_array(F.col("r"), left_by, right_by, F.size("w") - 1).alias("x"))) == grown
    table = islands.threshold_runs(waves.samples(df, ["k"], "w"), ["k"], "i", "value", 0.4)
    some = lambda d: {k: v for k, v in d.items() if v}
    assert by_key(table, "left", "right") == some(runs)
    last = df.select("k", (F.size("w") - 1).alias("last"))
    x = islands.extend_intervals(table.join(last, "k"), ["k"], left_by, right_by, F.lit(0), F.col("last"))
    assert by_key(x, "left_x", "right_x") == some(grown)


@pytest.mark.parametrize("margin", [0, 2, 9])
def test_zero_length_encoding(spark, margin):
    df = wave(spark, *WAVES)
    want = {}
    for k, w in enumerate(WAVES):
        merged = []
        for a, b in brute_runs(w, 0.9):
            a, b = max(a - margin, 0), min(b + margin, len(w) - 1)
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        want[k] = [(a + a % 2, b - (b + 1) % 2) for a, b in merged]
    assert by_row(df.select("k", islands.zero_length_in_array(F.col("w"), 0.9, margin).alias("x"))) == want


def test_hits_of_a_waveform(spark):
    rows = [(k, w, float(k % 3)) for k, w in enumerate(WAVES)]
    df = spark.createDataFrame(rows, "k int, w array<double>, gain double")
    got = by_key(waves.find_hits(df, ["k"], "w", 0.4, 1, 2, 1.5, longest=3, most=5, gain="gain"), "left", "right", "area", "height", "index_of_maximum", "center", "sum_absolute_deviation", "n_saturated")
    for k, w in enumerate(WAVES):
        want = []
        pieces = [(s, min(s + 2, b)) for a, b in brute_runs(w, 0.4) for s in range(a, b + 1, 3)]
        for a, b in brute_extended(pieces, 1, 2, len(w) - 1):
            v, i = np.array(w[a : b + 1]), np.arange(a, b + 1)
            if v.sum() > 0:
                c = (v * i).sum() / v.sum()
                want.append((a, b, v.sum(), v.max(), int(i[v.argmax()]), c, (np.abs(i - c) * v).sum() / v.sum(), int((v > 1.5).sum())))
        want = want[:5] if k % 3 else []
        assert len(got.get(k, [])) == len(want) and all(np.allclose(x, y) for x, y in zip(got.get(k, []), sorted(want)))


def test_smoothing_and_extrema(spark):
    df = wave(spark, *WAVES)
    for r in df.select("k", waves.smoothed(F.col("w"), 2, 3).alias("s"), waves.extrema(F.col("w")).alias("e")).collect():
        w = WAVES[r["k"]]
        assert np.allclose(r["s"], [sum(w[max(i - 2, 0) : i + 4]) / 6 for i in range(len(w))])
        d = np.sign(np.diff(w))
        want = [(i, "min" if d[i] > 0 else "max") for i in range(1, len(w) - 1) if d[i - 1] * d[i] < 0]
        assert [tuple(x) for x in r["e"]] == want


def test_concatenation(spark):
    rng = np.random.default_rng(4)
    rows, want, at = [], [], 0
    for _ in range(40):
        n, gap = int(rng.integers(1, 6)), int(rng.integers(0, 2))
        data = rng.integers(0, 99, n).tolist()
        at += gap
        rows.append((1, at, at + n - 1, data))
        if want and not gap:
            want[-1] = (want[-1][0], at + n - 1, want[-1][2] + data)
        else:
            want.append((at, at + n - 1, data))
        at += n
    df = spark.createDataFrame(rows, "channel int, left int, right int, raw_data array<int>")
    assert sorted((r["left"], r["right"], r["raw_data"]) for r in waves.concatenate_adjacent(df.repartition(3), ["channel"]).collect()) == want and 1 < len(want) < 40


def test_bounds(spark):
    rows = [(left, list(range(left, left + n))) for left in (-40, -9, -1, 0, 7, 49, 50, 51, 90) for n in (1, 3, 12, 80)]
    df = spark.createDataFrame(rows, "left int, raw_data array<int>")
    got = sorted((r["left"], r["right"], r["raw_data"]) for r in waves.cut_to_bounds(df, F.lit(51)).collect())
    inside = [[x for x in data if 0 <= x < 51] for _, data in rows]
    assert got == sorted((x[0], x[-1], x) for x in inside if x)
    with pytest.raises(Exception, match="outside"):
        waves.cut_to_bounds(df, F.lit(51), "error").collect()
    assert waves.cut_to_bounds(df.filter("left between 0 and 50"), F.lit(51), "error").count() == 16


def test_pulse_properties(spark):
    rng = np.random.default_rng(0)
    vectors = [rng.integers(-20, 20, n).astype(float) for n in (30, 12, 5, 1)]
    for r, w in zip(wave(spark, *vectors).select("k", waves.pulse_properties(F.col("w"), 10).alias("p")).orderBy("k").collect(), vectors):
        b = w[:10].mean()
        low = w[w < b]
        noise = np.sqrt(((low - b) ** 2).mean()) if len(low) else 0
        assert np.allclose([r["p"][x] for x in ("baseline", "noise_sigma", "minimum", "maximum")], [b, noise, w.min() - b, w.max() - b])


def test_interactions_in_order(spark):
    rng = np.random.default_rng(6)
    peak = lambda k, i: (1, k + i, int(rng.integers(0, 4000)), float(rng.integers(150, 5000)), 0)
    schema = "event int, peak_id int, t int, area double, tight_coincidence int"
    early, late = [peak(0, i) for i in range(8)], [peak(100, i) for i in range(8)]
    got = interactions.pair_interactions(spark.createDataFrame(early, schema), spark.createDataFrame(late, schema), ["event"], 100, 100, 700.0).orderBy("interaction_id").collect()
    pairs = [(r["s2"], r["s1"]) for r in got]
    time, area = {p[1]: p[2] for p in early + late}, {p[1]: p[3] for p in early + late}
    assert len(pairs) > 5 and len(set(pairs)) == len(pairs)
    assert all(0 < time[b] - time[a] <= 4000 for b, a in pairs)
    order = [(-area[b], -area[a]) for b, a in pairs]
    assert order == sorted(order)


def test_area_fractions(spark):
    rng = np.random.default_rng(7)
    w = [rng.random(n).round(3).tolist() for n in (1, 2, 17, 90)]
    fractions = [0.0, 0.13, 0.5, 0.87, 1.0]
    for r in wave(spark, *w).select("k", peaks.fraction_crossings(F.col("w"), fractions).alias("t")).collect():
        v = np.array(w[r["k"]])
        assert np.allclose(r["t"], np.interp(np.array(fractions) * v.sum(), np.concatenate([[0], np.cumsum(v)]), np.arange(len(v) + 1)))


def test_centring(spark):
    for n, center, field in ((1, 0, 3), (4, 1, 7), (9, 8, 5), (6, 0, 4), (30, 12, 9)):
        w = list(range(1, n + 1))
        got = wave(spark, w).select(peaks.centred(F.col("w"), field, F.lit(center)).alias("c")).first()["c"]
        source = {i - center + field // 2: x for i, x in enumerate(w)}
        assert got == [source.get(i, 0) for i in range(field)]


def test_pieces_of_many_peaks_are_split_alike():
    rng = np.random.default_rng(9)
    sizes = [0, 1, 2, 5, 5, 40, 0, 3, 5]
    t = [np.sort(np.concatenate([rng.normal(rng.choice([0, 300, 900]), 9, 1) for _ in range(n)])) if n else np.zeros(0) for n in sizes]
    a, own = [rng.random(n) * 9 + 0.1 for n in sizes], [rng.random(n) for n in sizes]
    knots = [(0.0, 0.6), (2.0, 0.4)]

    def plain(x, w, o):
        i, good = splitting.best_break(x, w, o)
        v = np.log10(w.sum()) if len(w) else 0
        if not i or x[i] - x[i - 1] < 20 or good <= 0.6 - 0.1 * v:
            return [0] * len(x)
        left = plain(x[:i], w[:i], o[:i])
        return left + [left[-1] + 1 + p for p in plain(x[i:], w[i:], o[i:])]

    want = [p for x, w, o in zip(t, a, own) for p in plain(x, w, o)]
    got = splitting.break_parts(np.concatenate(t), np.concatenate(a), np.concatenate(own), sizes, 20, knots)
    assert got.tolist() == want and max(want) > 1


def test_breaks_equal_the_plain_rule():
    rng = np.random.default_rng(8)
    for n in (2, 3, 10, 60):
        t, a, own = np.sort(rng.normal(0, 50, n)), rng.random(n) + 0.1, rng.random(n) * 20

        def spread(x, w, o):
            return (np.maximum(o, np.abs(x - np.average(x, weights=w))) * w).sum()

        good = [1 - (spread(t[:i], a[:i], own[:i]) + spread(t[i:], a[i:], own[i:])) / spread(t, a, own) for i in range(1, n)]
        i, best = splitting.best_break(t, a, own)
        assert i == int(np.argmax(good)) + 1 and np.isclose(best, max(good))


def test_two_equal_channels(spark):
    ch = spark.createDataFrame([(0, -1.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 5.0)], "channel int, x double, y double")
    df = spark.createDataFrame([(1, [2.0, 2.0, 0.0]), (2, [0.0, 0.0, 0.0])], "k int, a array<double>")
    found = positions.channel_areas(df, ["k"], "a", ch)
    got = {r["k"]: r for r in positions.weighted_position(found, ["k"]).collect()}
    assert (got[1]["x"], got[1]["y"], got[1]["spread"]) == (0, 0, 1) and got[2]["x"] is None
    assert positions.max_channel(found, ["k"]).filter("k = 1").first()["channel"] == 0
    robust = positions.robust_position(spark.createDataFrame([(1, [5.0] * 9 + [1.0])], "k int, a array<double>"), ["k"], "a", [0.0] * 9 + [50.0], [0.0] * 10, 2.0, 3).first()
    assert (robust["x"], robust["y"]) == (0, 0)


def test_map_interpolation(spark):
    grid = spark.createDataFrame([(float(x), float(y), float(x)) for x in range(5) for y in range(5)], "x double, y double, v double")
    pts = spark.createDataFrame([(1, 2.0, 3.0), (2, 1.5, 1.5), (3, float("nan"), 0.0)], "k int, x double, y double")
    got = {r["k"]: r["v"] for r in positions.interpolate(pts, ["k"], ["x", "y"], grid, "v").collect()}
    assert abs(got[1] - 2) < 1e-4 and abs(got[2] - 1.5) < 1e-9 and got[3] is None


def test_splitting():
    assert splitting.natural_breaks(np.array([0, 1, 2, 100, 101.0]), np.ones(5), 5, [(0, 0.5), (2, 0.5)]).tolist() == [0, 0, 0, 1, 1]
    assert splitting.minimum_splits(np.array([0, 5, 9, 2, 8, 5, 0.0]), 1, 1.5) == [3]
    w = np.concatenate([np.exp(-0.5 * ((np.arange(60) - 20) / 4.0) ** 2)])
    assert 25 < splitting.tail_point(w, 0.1) < 40
    line = 2.0 * np.arange(40) + 1
    assert np.allclose(splitting.lowess(line, 0.3), line)
    template = np.exp(-0.5 * ((np.arange(50) - 25) / 5.0) ** 2)
    assert np.allclose(splitting.desaturate(np.minimum(3 * template, 1.5), template, 1.5, 10)[20:30], 3 * template[20:30], rtol=0.05)


def test_binomial_and_units():
    from math import comb

    for n, p in ((10, 0.3), (25, 0.7)):
        pmf = [comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
        assert np.allclose([statistics.binomial_cdf(k, n, p) for k in range(n + 1)], np.cumsum(pmf))
        assert all(0 <= statistics.binomial_test(k, n, p) <= 1 for k in range(n + 1))
    assert np.isclose(units.quantity("1.5 * kV / cm"), 1500 * units.V) and np.isclose(units.quantity("300 * ns"), 300) and units.unit("us") == 1000
    with pytest.raises(ValueError):
        units.unit("__import__")


def test_nesting_round_trip(spark, tmp_path):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "event_number long")
    kids = spark.createDataFrame([(1, 0, 1.5), (1, 1, 2.5), (3, 0, 0.5)], "event_number long, peak_id int, area double")
    nested = flat.nest(parents, kids, ["event_number"], ["peak_id"], "peaks")
    for kind in ("parquet", "orc", "json"):
        path = str(tmp_path / kind)
        flat.write_folder(nested, path, kind, rows_per_file=1, metadata={"run": 1})
        back = flat.flatten(flat.read_folder(spark, path, kind, nested.schema), ["event_number"], "peaks")
        assert sorted(map(tuple, back.select(kids.columns).collect())) == sorted(map(tuple, kids.collect()))
        assert flat.read_folder(spark, path, kind, nested.schema, event=3).count() == 1
    flat.convert(spark, str(tmp_path / "parquet"), "parquet", str(tmp_path / "csv"), "csv")
    assert flat.read_folder(spark, str(tmp_path / "csv"), "csv").count() == 3
    with pytest.raises(Exception, match="(?i)exists"):
        flat.write_folder(nested, str(tmp_path / "json"), "json")


def test_model_casts_and_missing_values(spark):
    df = spark.createDataFrame([("1", float("nan")), ("-99999", 2.0)], "a string, b double")
    out = relational.nan_to_null(relational.cast_model(df, {"a": "int", "b": "double"})).collect()
    assert [tuple(r) for r in out] == [(1, None), (None, 2.0)]
    with pytest.raises(ValueError):
        relational.cast_model(df, {"a": "int"})


def test_pipeline_presets(spark):
    names, config = pipelines.PRESETS["trigger"]
    out = pipelines.Pipeline(names, pipelines.merge(config, {"classify": {"s2_min_pulses": 3}})).run(pulses(spark, [0, 250, 499, 10**6, 10**6 + 10]))
    assert sorted((r["n_pulses"], r["type"]) for r in out.collect()) == [(2, 1), (3, 2)]
    with pytest.raises(ValueError):
        pipelines.Pipeline(["nothing"])


def test_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.integers(1, 2_000_000, 200)).tolist()
    rows = [(1, x, int(i % 4), 1.0) for i, x in enumerate(t)]
    df = spark.createDataFrame(rows, "run long, time long, pmt long, area double").withColumn("ts", F.timestamp_micros(F.floor(F.col("time") / 1000)))
    for k in range(4):
        df.filter(f"time >= {t[k * 50]} and time <= {t[k * 50 + 49]}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    flush = spark.createDataFrame([(9, 10**15, 0, 1.0)], "run long, time long, pmt long, area double").withColumn("ts", F.timestamp_micros(F.floor(F.col("time") / 1000)))
    flush.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = event_builder.stream_signals(stream, 500_000, 5_000_000).writeStream.format("memory").queryName("signals_out").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r["left_time"], r["right_time"], r["n_pulses"]) for r in spark.table("signals_out").filter("run = 1").collect())
    batch = trigger.find_signals(df.withColumn("pulse_id", F.col("time")), 500_000).collect()
    assert got == sorted((r["left_time"], r["right_time"], r["n_pulses"]) for r in batch)
