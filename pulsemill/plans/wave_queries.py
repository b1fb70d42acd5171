"""Waveform, pattern and position queries on the embeddings table: embedding -> waveform or per-channel areas, label -> detector."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import statistics
from ..operators import islands, peaks, positions, splitting, waves
from .catalogue import query

THRESHOLD = 0.1


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("w"))


def positive(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir).withColumn("w", F.transform("w", lambda x: F.abs(x)))


def samples(spark, sf_dir) -> DataFrame:
    return waves.samples(table(spark, sf_dir), ["vec_id"], "w")


E = "e as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as w from embeddings), s as (select vec_id, label, unnest(w) as value, cast(unnest(range(len(w))) as int) as i from e)"
RUNS = f"""{E}, a as (select *, i - row_number() over (partition by vec_id order by i) as g from s where value > {THRESHOLD}),
r as (select vec_id, cast(min(i) as int) as "left", cast(max(i) as int) as "right" from a group by vec_id, g)"""
GROWN = f"""{RUNS}, x1 as (select *, least("right" + 2, coalesce(lead("left") over (partition by vec_id order by "left") - 1, 63), 63) as right_x from r),
x as (select *, greatest("left" - 1, coalesce(lag(right_x) over (partition by vec_id order by "left") + 1, 0), 0) as left_x from x1)"""


@query(f"with {E} select vec_id, i, round(1.0 - value - b, 6) as value from (select *, avg(case when i < 8 then value end) over (partition by vec_id) as b from s)")
def wave_baseline(spark, sf_dir):
    t = table(spark, sf_dir).withColumn("p", waves.pulse_properties(F.col("w"), 8))
    t = t.select("vec_id", waves.to_pe(F.col("w"), 1.0, F.col("p.baseline"), F.lit(1.0)).alias("w"))
    return waves.samples(t, ["vec_id"], "w").withColumn("value", F.round("value", 6))


@query(f"""with {E}, b as (select *, avg(case when i < 8 then value end) over (partition by vec_id) as b from s)
select vec_id, round(any_value(b), 6) as baseline, round(avg(case when i >= 56 then value end) - any_value(b), 6) as baseline_increase,
round(coalesce(sqrt(avg(case when value < b then (value - b) * (value - b) end)), 0), 6) as noise_sigma, round(min(value) - any_value(b), 6) as minimum, round(max(value) - any_value(b), 6) as maximum from b group by vec_id""")
def pulse_props(spark, sf_dir):
    t = table(spark, sf_dir).select("vec_id", waves.pulse_properties(F.col("w"), 8).alias("p"))
    return t.select("vec_id", *(F.round(f"p.{c}", 6).alias(c) for c in ("baseline", "baseline_increase", "noise_sigma", "minimum", "maximum")))


@query(f'with {RUNS} select vec_id, "left", "right" from r')
def threshold_intervals(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", F.inline(islands.runs_in_array(F.col("w"), THRESHOLD)))


@query(f'with {GROWN} select vec_id, left_x as "left", right_x as "right" from x')
def extended_intervals(spark, sf_dir):
    r = table(spark, sf_dir).withColumn("r", islands.runs_in_array(F.col("w"), THRESHOLD))
    return r.select("vec_id", F.inline(islands.extended_in_array(F.col("r"), 1, 2, F.size("w") - 1)))


@query(f"""with {E}, k as (select vec_id, greatest(i - 3, 0) as l, least(i + 3, 63) as r from s where value > 0.2),
m as (select *, case when l <= max(r) over (partition by vec_id order by l, r rows between unbounded preceding and 1 preceding) then 0 else 1 end as new from k),
g as (select *, sum(new) over (partition by vec_id order by l, r) as run from m), o as (select vec_id, min(l) as l, max(r) as r from g group by vec_id, run)
select vec_id, cast(l + l % 2 as int) as "left", cast(r - (1 - r % 2) as int) as "right" from o""")
def zle(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", F.inline(islands.zero_length_in_array(F.col("w"), 0.2, 3)))


@query(f"""with {GROWN}, h as (select s.vec_id, left_x as "left", right_x as "right", value, i from s join x on s.vec_id = x.vec_id and i between left_x and right_x),
c as (select vec_id, "left", "right", sum(value) as area, max(value) as height, cast(min_by(i, struct_pack(a := -value, b := i)) as int) as index_of_maximum, sum(value * i) / sum(value) as center, sum(cast(value > 0.25 as int)) as n_saturated from h group by all)
select c.vec_id, c."left", c."right", round(area, 5) as area, round(height, 6) as height, index_of_maximum, cast(n_saturated as bigint) as n_saturated from c where area > 0""")
def hit_props(spark, sf_dir):
    h = waves.find_hits(table(spark, sf_dir), ["vec_id"], "w", THRESHOLD, 1, 2, 0.25)
    return h.select("vec_id", "left", "right", F.round("area", 5).alias("area"), F.round("height", 6).alias("height"), "index_of_maximum", "n_saturated")


P = f"{E}, q as (select vec_id, i, abs(value) as x, sum(abs(value)) over (partition by vec_id order by i) as c, sum(abs(value)) over (partition by vec_id) as t from s)"
_at = lambda f: f"(min_by(i + (t * {f} - (c - x)) / x, i) filter (where c >= t * {f} - t * 1e-12))"
_cross = ", ".join(f"round({_at(f)}, 5) as t{int(f * 100)}" for f in (0.1, 0.25, 0.5, 0.75, 0.9))


@query(f"with {P} select vec_id, {_cross} from q where x > 0 group by vec_id")
def area_deciles(spark, sf_dir):
    f = (0.1, 0.25, 0.5, 0.75, 0.9)
    t = positive(spark, sf_dir).select("vec_id", peaks.fraction_crossings(F.col("w"), f).alias("t"))
    return t.select("vec_id", *(F.round(F.col("t")[i], 5).alias(f"t{int(x * 100)}") for i, x in enumerate(f)))


@query(f"with {P}, d as (select vec_id, {_at(0.2)} as a, {_at(0.1)} as z, {_at(0.5)} as m, {_at(0.8)} as b from q where x > 0 group by vec_id) select vec_id, round(b - a, 5) as range_60, round(z - m, 5) as rise_10 from d")
def peak_widths(spark, sf_dir):
    d = positive(spark, sf_dir).withColumn("t", peaks.fraction_crossings(F.col("w"), peaks.DECILES))
    ranges, mid = peaks.widths(F.col("t"))
    return d.select("vec_id", F.round(ranges[3], 5).alias("range_60"), F.round(mid[1], 5).alias("rise_10"))


@query(f"with {E} select vec_id, i, round(sum(value) over (partition by vec_id order by i rows between 4 preceding and 3 following) / 8, 6) as smooth from s")
def moving_avg(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", F.posexplode(waves.smoothed(F.col("w"), 4, 3)).alias("i", "smooth")).withColumn("smooth", F.round("smooth", 6))


@query(f"with {E}, d as (select *, value - lag(value) over w as b, lead(value) over w - value as a from s window w as (partition by vec_id order by i)) select vec_id, i, case when b < 0 then 'min' else 'max' end as kind from d where (b < 0 and a > 0) or (b > 0 and a < 0)")
def local_extrema(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", F.inline(waves.extrema(F.col("w"))))


@query(f"with {E} select label, i, round(sum(value), 5) as value from s group by label, i")
def sum_waveform(spark, sf_dir):
    return waves.sum_waveform(table(spark, sf_dir), ["label"], "w").withColumn("value", F.round("value", 5))


def grid_channels(spark) -> DataFrame:
    i = F.col("id").cast("int")
    return spark.range(64).select(i.alias("channel"), (i % 8).cast("double").alias("x"), F.floor(i / 8).cast("double").alias("y"))


G = f"{E}, g as (select vec_id, i as channel, abs(value) as area, cast(i % 8 as double) as x, cast(i // 8 as double) as y from s)"


def areas(spark, sf_dir) -> DataFrame:
    return positions.channel_areas(positive(spark, sf_dir), ["vec_id"], "w", grid_channels(spark))


@query(f"with {G} select vec_id, round(sum(x * area) / sum(area), 6) as x, round(sum(y * area) / sum(area), 6) as y from g group by vec_id")
def centroid(spark, sf_dir):
    return positions.weighted_position(areas(spark, sf_dir), ["vec_id"]).select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"""with {G}, m as (select vec_id, sum(x * area) / sum(area) as mx, sum(y * area) / sum(area) as my from g group by vec_id)
select g.vec_id, round(sqrt(sum(((x - mx) * (x - mx) + (y - my) * (y - my)) * area) / sum(area)), 6) as spread from g join m on g.vec_id = m.vec_id group by g.vec_id""")
def spread(spark, sf_dir):
    return positions.weighted_position(areas(spark, sf_dir), ["vec_id"]).select("vec_id", F.round("spread", 6).alias("spread"))


@query(f"with {G} select vec_id, cast(channel as int) as channel, x, y from (select *, row_number() over (partition by vec_id order by area desc, channel) as k from g) where k = 1")
def max_pmt(spark, sf_dir):
    return positions.max_channel(areas(spark, sf_dir), ["vec_id"])


@query(f"""with {E}, p as (select label as point, i, avg(abs(value)) as pattern from s group by label, i), pt as (select point, sum(pattern) as t from p group by point),
o as (select vec_id, i, abs(value) as seen, sum(abs(value)) over (partition by vec_id) as t from s),
f as (select vec_id, p.point, sum((seen - pattern * o.t / pt.t) * (seen - pattern * o.t / pt.t) / (pattern * o.t / pt.t)) as gof from o join p on o.i = p.i join pt on p.point = pt.point group by all)
select vec_id, point, round(gof, 5) as gof from (select *, row_number() over (partition by vec_id order by gof, point) as k from f) where k = 1""")
def grid_fit(spark, sf_dir):
    return _fit(spark, sf_dir, "chi2")


@query(f"""with {E}, p as (select label as point, i, avg(abs(value)) as pattern from s group by label, i), pt as (select point, sum(pattern) as t from p group by point),
o as (select vec_id, i, abs(value) as seen, sum(abs(value)) over (partition by vec_id) as t from s),
f as (select vec_id, p.point, sum(2 * (pattern * o.t / pt.t - seen + seen * ln(seen / (pattern * o.t / pt.t)))) as gof from o join p on o.i = p.i join pt on p.point = pt.point where seen > 0 group by all)
select vec_id, point, round(gof, 5) as gof from (select *, row_number() over (partition by vec_id order by gof, point) as k from f) where k = 1""")
def gof_poisson(spark, sf_dir):
    return _fit(spark, sf_dir, "likelihood_poisson")


def _fit(spark, sf_dir, kind) -> DataFrame:
    t = positive(spark, sf_dir)
    means = waves.samples(t, ["label"], "w").groupBy("label", "i").agg(F.avg("value").alias("v"))
    # One pattern of 64 values for each label: the map of the fit.
    grid = means.groupBy(F.col("label").alias("point")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("pattern"))
    return positions.grid_fit(t, ["vec_id"], "w", grid, kind).select("vec_id", "point", F.round("gof", 5).alias("gof"))


MAP_N = 12


@query(f"""with q as (select vec_id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings),
m as (select a / {MAP_N}.0 - 0.5 as mx, b / {MAP_N}.0 - 0.5 as my, cos(a) + b as v from (select unnest(range({MAP_N})) as a), (select unnest(range({MAP_N})) as b)),
d as (select vec_id, v, sqrt((x - mx) * (x - mx) + (y - my) * (y - my)) as d, mx, my from q, m),
k as (select *, row_number() over (partition by vec_id order by d, mx, my) as k from d)
select vec_id, round(sum(v / greatest(d, 1e-6)) / sum(1 / greatest(d, 1e-6)), 5) as v from k where k <= 4 group by vec_id""")
def knn_map(spark, sf_dir):
    q = table(spark, sf_dir).select("vec_id", F.col("w")[0].alias("x"), F.col("w")[1].alias("y"))
    n = spark.range(MAP_N * MAP_N).select(F.floor(F.col("id") / MAP_N).alias("a"), (F.col("id") % MAP_N).alias("b"))
    grid = n.select((F.col("a") / float(MAP_N) - 0.5).alias("x"), (F.col("b") / float(MAP_N) - 0.5).alias("y"), (F.cos("a") + F.col("b")).alias("v"))
    return positions.interpolate(q, ["vec_id"], ["x", "y"], grid, "v").withColumn("v", F.round("v", 5))


@query(f"""with {E}, r as (select *, i // 10 as record_i from s)
select vec_id, cast(record_i as int) as record_i, cast(count(*) as int) as length, round(sum(value), 5) as area, round(max(value), 6) as top from r group by vec_id, record_i""")
def records_split(spark, sf_dir):
    r = waves.split_records(table(spark, sf_dir), ["vec_id"], "w", 10)
    top = F.array_max(F.slice("data", F.lit(1), F.col("length")))
    return r.select("vec_id", "record_i", "length", F.round("area", 5).alias("area"), F.round(top, 6).alias("top"))


@query(f"with {E} select vec_id, i, round(0.25 * coalesce(lead(value) over w, 0) + 0.5 * value + 0.25 * coalesce(lag(value) over w, 0), 6) as value from s window w as (partition by vec_id order by i)")
def fir_filter(spark, sf_dir):
    t = table(spark, sf_dir).select("vec_id", waves.fir(F.col("w"), [0.25, 0.5, 0.25]).alias("w"))
    return waves.samples(t, ["vec_id"], "w").withColumn("value", F.round("value", 6))


@query()
def robust_mean(spark, sf_dir):
    x, y = [float(i % 8) for i in range(64)], [float(i // 8) for i in range(64)]
    return positions.robust_position(positive(spark, sf_dir), ["vec_id"], "w", x, y, outlier=1.6, min_channels=8)


@query()
def neural_net(spark, sf_dir):
    rng = np.random.default_rng(5)
    layers = [(rng.normal(size=(64, 16)), rng.normal(size=16)), (rng.normal(size=(16, 2)), rng.normal(size=2))]
    return positions.neural_position(positive(spark, sf_dir), ["vec_id"], "w", layers, 10.0)


@query()
def lowess(spark, sf_dir):
    return splitting.with_array(table(spark, sf_dir), ["vec_id"], "w", lambda w: splitting.lowess(w, 0.2), "array<double>")


@query()
def local_min_split(spark, sf_dir):
    return splitting.with_array(positive(spark, sf_dir), ["vec_id"], "w", lambda w: splitting.minimum_splits(w, 0.1, 1.5), "array<long>")


@query()
def tail_separation(spark, sf_dir):
    return splitting.with_array(positive(spark, sf_dir), ["vec_id"], "w", lambda w: splitting.tail_point(w, 0.3), "long")


@query()
def desaturate(spark, sf_dir):
    t = positive(spark, sf_dir).select((F.col("vec_id") % 50).alias("event"), F.col("vec_id").alias("channel"), "w")
    return splitting.desaturate_events(t, ["event"], 0.35, 8)


@query()
def binom_pvalue(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").agg(F.count("*").alias("n"), F.sum((F.col("event_type") == "click").cast("int")).alias("k"))
    return e.select("user_id", "k", "n", statistics.binomial_p_value(F.col("k"), F.col("n"), F.lit(0.2)).alias("p"))


@query(f"with {E} select vec_id, round(sqrt(cast(w[1] * w[1] + w[2] * w[2] as double)), 6) as r, round(atan2(w[2], w[1]), 6) as phi, round(exp(w[3] / 0.5), 6) as lifetime, round(-1.5 * (w[4] - 0.1), 6) as z from e")
def coordinates(spark, sf_dir):
    from ..operators import interactions

    w = lambda i: F.col("w")[i]
    return table(spark, sf_dir).select("vec_id", F.round(F.hypot(w(0), w(1)), 6).alias("r"), F.round(F.atan2(w(1), w(0)), 6).alias("phi"), F.round(interactions.lifetime_correction(w(2), 0.5), 6).alias("lifetime"), F.round(interactions.drift_depth(w(3), 1.5, 0.1), 6).alias("z"))
