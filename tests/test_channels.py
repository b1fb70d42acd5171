"""Channel operators against plain rules: nulls, ties, empty inputs and overlaps."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.operators import channels


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_free_regions_equal_counting_samples(spark):
    rng = np.random.default_rng(4)
    given, want = [], []
    for key in range(60):
        spans = [(int(a), int(a) + int(rng.integers(0, 9))) for a in rng.integers(-3, 45, rng.integers(1, 6))]
        given += [(key, a, b) for a, b in spans]
        covered = [any(a <= i <= b for a, b in spans) for i in range(41)]
        for free, part in itertools.groupby(range(41), key=lambda i: not covered[i]):
            part = list(part)
            if free:
                want.append((key, part[0], part[-1]))
    df = spark.createDataFrame(given, "key int, left int, right int")
    assert rows(channels.free_regions(df, ["key"], 0, F.lit(40))) == sorted(want, key=str)
    more = spark.createDataFrame([(5,), (99,), (99,)], "key int")
    assert rows(channels.free_regions(df, ["key"], 0, F.lit(40), among=more)) == sorted([*want, (99, 0, 40)], key=str)
    assert channels.free_regions(df.limit(0), ["key"], 0, F.lit(40)).count() == 0


def plain_crossing(w, start, threshold, n, stop):
    step = 1 if stop > start else -1
    side = lambda v: (v > threshold) - (v < threshold)
    here = side(w[start])
    for i in range(start + step, stop, step):
        stay = [w[i + step * k] for k in range(n) if (i + step * k - stop) * step < 0]
        if here and len(stay) == n and all(side(v) == -here for v in stay):
            return i
    return stop


@pytest.mark.parametrize("n", [1, 2, 3])
def test_crossings_to_both_sides(spark, n):
    rng = np.random.default_rng(n)
    waves = [rng.integers(-2, 3, 20).astype(float).tolist() for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(waves)), "k int, w array<double>")
    out = df.select("k", channels.next_crossing(F.col("w"), 6, 0.0, n, F.lit(18)), channels.previous_crossing(F.col("w"), 12, 0.0, n, F.lit(1))).collect()
    for k, right, left in out:
        assert right == plain_crossing(waves[k], 6, 0.0, n, 18)
        assert left == plain_crossing(waves[k], 12, 0.0, n, 1)


def test_ranks_vetoes_and_counts(spark):
    p = spark.createDataFrame([(1, 1, "S1", "tpc", 5.0), (1, 2, "s1", "veto", 5.0), (1, 3, None, "tpc", 9.0), (1, 4, "s1", "tpc", 7.0), (2, 5, "s1", "tpc", None)], "event int, peak int, type string, detector string, area double")
    ranked = channels.peaks_by_type(p, ["event"], "s1", "all", F.col("area"), "peak")
    assert sorted((r["event"], r["peak"], r["rank"]) for r in ranked.collect()) == [(1, 1, 2), (1, 2, 3), (1, 4, 1), (2, 5, 1)]
    assert channels.peaks_by_type(p, ["event"], "all", "tpc", F.col("area"), "peak", largest_first=False).filter("rank = 1 and event = 1").first()["peak"] == 1
    pulses = spark.createDataFrame([(1, 0, 2.0), (1, 3, 2.0), (1, 0, 0.0), (2, None, 1.0)], "channel int, n_hits int, gain double")
    assert rows(channels.channel_counts(pulses, ["channel"], F.col("n_hits"), F.col("gain"))) == [(1, 3, 1), (2, 1, 0)]
    assert channels.channel_counts(pulses.limit(0), ["channel"], F.col("n_hits"), F.col("gain")).count() == 0
    kept = channels.prescale(spark.range(4000), F.col("id") % 2, 0, F.col("id"), 0.25)
    share = kept.filter("id % 2 = 1 and kept").count() / 2000
    assert kept.filter("id % 2 = 0 and not kept").count() == 0 and 0.2 < share < 0.3


def test_seeds_sections_and_known_values(spark):
    nan = float("nan")
    s = spark.createDataFrame([(1, "a", nan, 0.0), (1, "b", 2.0, 1.0), (1, "c", 2.0, 2.0), (2, "a", None, 3.0)], "peak int, algorithm string, gof double, x double")
    assert rows(channels.best_seed(s, ["peak"], "gof", "algorithm", ["x"])) == [(1, 2.0, "b", 1.0)]
    t = spark.createDataFrame([(1, k, h, k) for k, h in ((0, 1.0), (1, 4.0), (2, 4.0), (9, 2.0), (5, None))], "event int, t int, h double, peak int")
    got = {r["section"]: (r["peak"], r["h"]) for r in channels.largest_per_section(t, ["event"], "t", "h", "peak", 2).collect()}
    assert got == {0: (1, 4.0), 1: (9, 2.0)}
    v = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, None), (2, 1, None)], "channel int, t int, base double")
    assert rows(channels.last_known(v, ["channel"], ["t"], "base", "known").select("channel", "t", "known")) == [(1, 1, None), (1, 2, 5.0), (1, 3, 5.0), (2, 1, None)]


def test_small_helpers(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    w = F.array(*map(F.lit, (1, 2, 3, 4, 5)))
    assert value(channels.shrunk(w, 1)) == [2, 3, 4] and value(channels.shrunk(w, 3)) == [] and value(channels.shrunk(w, 0)) == [1, 2, 3, 4, 5]
    for x, i in ((-0.6, None), (-0.5, 0), (0.49, 0), (0.5, 1), (2.4, 2), (2.5, 2), (2.6, None)):
        assert value(channels.grid_index(F.lit(x), 0.0, 1.0, 3)) == i
    areas, pattern = F.array(*map(F.lit, (6.0, 0.0, 2.0))), F.array(*map(F.lit, (0.5, 0.25, 0.25)))
    flags = lambda *f: F.array(*map(F.lit, f))
    assert value(channels.saturation_correction(areas, pattern, flags(False, True, False))) == pytest.approx(8 + 0.25 * 8 / 0.75)
    assert value(channels.saturation_correction(areas, pattern, flags(True, True, True))) == 8.0
    runs = spark.createDataFrame([(1, 0, 10), (1, 5, 30), (2, 0, 1)], "run int, start int, stop int")
    assert rows(channels.run_totals(runs, ["run"], 20)) == [(1, 2, 30, 1), (2, 1, 1, 0)]
    maps = spark.createDataFrame([("tpc", [1, 2]), ("veto", []), ("none", None)], "detector string, channels array<int>")
    assert rows(channels.detector_by_channel(maps)) == [(1, "tpc"), (2, "tpc")]


@pytest.mark.parametrize("width", [7, 100, 10_000])
def test_buckets_change_nothing(spark, width):
    """Neighbours, carried values and clusters by buckets of time equal one window a key; null keys and values, ties and negative times too."""
    from pyspark.sql.window import Window

    from pulsemill.operators import islands, peaks

    rng = np.random.default_rng(width)
    data = [(int(rng.integers(0, 3)) or None, int(rng.integers(-300, 300)), i, float(i) if rng.random() < 0.4 else None) for i in range(400)]
    df = spark.createDataFrame(data, "key int, t long, id long, v double").repartition(4)
    w = Window.partitionBy("key").orderBy("t", "id")
    both = islands.beside(islands.beside(df, ["key"], ["t", "id"], "v", "t", width, "before"), ["key"], ["t", "id"], "v", "t", width, "after", after=True)
    assert rows(both) == rows(df.withColumns({"before": F.lag("v").over(w), "after": F.lead("v").over(w)}))
    assert rows(islands.carried(df, ["key"], ["t", "id"], "v", "t", width, "known")) == rows(channels.last_known(df, ["key"], ["t", "id"], "v", "known"))
    hits = df.withColumnRenamed("t", "index_of_maximum").withColumn("channel", F.col("id") % 3)
    for one, many in ((peaks.cluster_hits(hits, ["key"], 2, "id"), peaks.cluster_hits(hits, ["key"], 2, "id", width=width)),):
        assert rows(one) == rows(many.select(one.columns))
    keep = F.col("n_channels") >= 2
    one, many = (peaks.two_pass_clusters(hits, ["key"], 1, 5, keep, "id", width=x) for x in (None, width))
    assert rows(one) == rows(many.select(one.columns))
