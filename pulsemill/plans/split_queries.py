"""Peak splitting and pattern fits on the embeddings table: a vector is a peak's waveform with its pulse, or a peak's areas in 64 channels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import pattern_fit, peak_splits, waves
from .catalogue import query
from .wave_queries import positive

HIT, SATURATION, HEIGHT, TAIL_HEIGHT, RATIO = 0.02, 0.3, 0.02, 0.05, 0.02

S = "e as (select vec_id, label, list_transform(embedding, lambda x: abs(cast(x as double))) as w from embeddings), s as (select vec_id, label, unnest(w) as v, cast(unnest(range(len(w))) as int) as i from e)"
MINIMA = f"""{S}, y as (select vec_id, i, v from s where i % 2 = 0),
k as (select a.vec_id, a.i, pow(1 - pow(abs(b.i - a.i) / 15.0, 3), 3) as k, cast(b.i - a.i as double) as d, b.v from y a join y b on a.vec_id = b.vec_id and abs(b.i - a.i) < 15),
m as (select vec_id, i, sum(k) as s0, sum(k * d) as s1, sum(k * d * d) as s2, sum(k * v) as t0, sum(k * d * v) as t1 from k group by vec_id, i),
l as (select vec_id, i, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) as u from m),
n as (select *, coalesce(u - lag(u) over q, 1) as b_min, coalesce(lead(u) over q - u, -1) as a_min, coalesce(u - lag(u) over q, -1) as b_max, coalesce(lead(u) over q - u, 1) as a_max from l window q as (partition by vec_id order by i)),
mx as (select vec_id, i, u from n where a_max <= 0 and b_max > 0), mn as (select vec_id, i, u from n where a_min > 0 and b_min <= 0),
cuts as (select mn.vec_id, mn.i as x from mn where (select arg_min(mx.u, mx.i) from mx where mx.vec_id = mn.vec_id and mx.i > mn.i) - mn.u > {HEIGHT}
 and exists (select 1 from mx where mx.vec_id = mn.vec_id and mx.i < mn.i and mx.u - mn.u > {HEIGHT}))"""
TAILS = f"""{S}, top as (select vec_id, max(v) as top from s group by vec_id), f as (select s.*, top from s join top using (vec_id) where v > 0.02 * top and top >= {TAIL_HEIGHT} and label <> 0),
c as (select vec_id, sum(i * v) / sum(v) as mean from f group by vec_id), g as (select f.vec_id, any_value(mean) as mean, sqrt(sum(pow(i - mean, 2) * v) / sum(v)) as sigma from f join c using (vec_id) group by f.vec_id),
p as (select f.vec_id, v, mean, sigma, exp(-0.5 * pow((i - mean) / sigma, 2)) / (sigma * sqrt(2 * pi())) as pdf from f join g using (vec_id)),
a as (select vec_id, any_value(mean) as mean, any_value(sigma) as sigma, sum(v * pdf) / sum(pdf * pdf) as amp from p group by vec_id),
cuts as (select s.vec_id, min(i) as x from s join a using (vec_id) where v < {RATIO} * amp and i > mean + 2 * sigma group by s.vec_id)"""
SPLIT = f"""h0 as (select vec_id, i, v, i - row_number() over (partition by vec_id order by i) as g from s where v > {HIT}),
h1 as (select *, (select count(*) from cuts where cuts.vec_id = h0.vec_id and x < h0.i) as piece from h0),
h as (select vec_id, min(i)::int as "left", max(i)::int as "right", sum(v) as area, arg_max(i, v) as top, sum((v > {SATURATION})::int) as n_saturated from h1 group by vec_id, g, piece),
pt as (select *, (select count(*) from cuts where cuts.vec_id = h.vec_id and x < top) as part from h)"""
HITS = 'select vec_id, part::int as part, "left", "right", round(area, 6) as area, top::int as index_of_maximum, n_saturated::bigint as n_saturated from pt'
PEAKS = """select vec_id, part::int as part, (case when part = 0 then 0 else (select list_sort(list(x)) from cuts where cuts.vec_id = pt.vec_id)[part] + 1 end)::int as "left",
coalesce((select list_sort(list(x)) from cuts where cuts.vec_id = pt.vec_id)[part + 1], 63)::int as "right", count(*) as n_hits, round(sum(area), 6) as area from pt group by vec_id, part"""


def _split(spark, sf_dir, rule, *limits, only=None):
    p = positive(spark, sf_dir)
    peaks = peak_splits.cut_points(p.select("vec_id", "label", F.lit(0).alias("left"), (F.size("w") - 1).alias("right"), "w"), "w", rule, *limits, only=only).drop("w")
    hits = waves.find_hits(p, ["vec_id"], "w", HIT, 0, 0, SATURATION)
    return peaks, peak_splits.split_hits(peaks, hits, p.select("vec_id", F.lit(0).alias("start"), "w"), ["vec_id"], ["vec_id"], SATURATION)


def _hits(parts):
    return parts.select("vec_id", "part", "left", "right", F.round("area", 6).alias("area"), "index_of_maximum", "n_saturated")


@query(f"with {MINIMA}, {SPLIT} {HITS}")
def minimum_split_hits(spark, sf_dir):
    return _hits(_split(spark, sf_dir, peak_splits.minimum_points, HEIGHT)[1])


@query(f"with {MINIMA}, {SPLIT} {PEAKS}")
def minimum_split_peaks(spark, sf_dir):
    peaks, parts = _split(spark, sf_dir, peak_splits.minimum_points, HEIGHT)
    return peak_splits.split_peaks(peaks, parts, ["vec_id"]).withColumn("area", F.round("area", 6))


@query(f"with {TAILS}, {SPLIT} {PEAKS}")
def tail_split_peaks(spark, sf_dir):
    peaks, parts = _split(spark, sf_dir, peak_splits.tail_points, TAIL_HEIGHT, RATIO, only=F.col("label") != 0)
    return peak_splits.split_peaks(peaks, parts, ["vec_id"]).withColumn("area", F.round("area", 6))


#: A square of 8 x 8 channels under a grid of 15 x 15 places; light falls off with the distance.
POINTS, SOFT = 15, 0.05
CHANNELS = "c as (select i, (i % 8) / 3.5 - 1 as cx, (i // 8) / 3.5 - 1 as cy from range(64) r(i))"
GRID = f"""{CHANNELS}, g as (select p, (p % {POINTS}) / 7.0 - 1 as x, (p // {POINTS}) / 7.0 - 1 as y from range({POINTS * POINTS}) r(p)),
m0 as (select x, y, i, 1 / ({SOFT} + pow(x - cx, 2) + pow(y - cy, 2)) as q from g, c), m as (select x, y, i, q / sum(q) over (partition by x, y) as q from m0)"""


def _patterns() -> pattern_fit.PatternMap:
    axis = np.arange(POINTS) / 7.0 - 1
    x, y = np.meshgrid(axis, axis, indexing="ij")
    i = np.arange(64)
    q = 1 / (SOFT + (x[..., None] - (i % 8 / 3.5 - 1)) ** 2 + (y[..., None] - (i // 8 / 3.5 - 1)) ** 2)
    return pattern_fit.PatternMap(q / q.sum(axis=-1, keepdims=True), ((-1.0, 1.0), (-1.0, 1.0)), ("x", "y"))


FIT = f"""{S}, {GRID}, t as (select vec_id, i, 100 * v as v, sum(100 * v) over (partition by vec_id) as total from s)"""


@query(f"""with {FIT}, f as (select vec_id, x, y, sum(pow(v + least(v, 1) - q * total, 2) / (q * total + 1)) as gof from t join m using (i) group by all)
select vec_id, round(arg_min(x, gof), 6) as x, round(arg_min(y, gof), 6) as y, round(min(gof), 4) as gof, 64 as ndf from f group by vec_id""")
def pattern_position(spark, sf_dir):
    peaks = positive(spark, sf_dir).withColumn("areas", F.transform("w", lambda v: v * 100))
    fits = pattern_fit.fit_positions(peaks, "areas", _patterns(), "chi2gamma")
    return fits.select("vec_id", F.round("fit.x", 6).alias("x"), F.round("fit.y", 6).alias("y"), F.round("fit.gof", 4).alias("gof"), "fit.ndf")


@query(f"""with {FIT}, pos as (select vec_id, sum(v * cx) / sum(v) as px, sum(v * cy) / sum(v) as py, arg_max(cx, v) as mx, arg_max(cy, v) as my from t join c using (i) where i <> 5 group by vec_id),
u as (select vec_id, i, v, sum(v) over (partition by vec_id) as total from t where i <> 5), r as (select x, y, i, q / sum(q) over (partition by x, y) as q from m where i <> 5),
f as (select vec_id, x, y, 2 * sum(v * ln(v / (q * total)) - v + q * total) as gof from u join r using (i) group by all),
sd as (select vec_id, k, (select arg_min(p, abs(p - least(greatest(sx, -1), 1))) from (select distinct round(x, 9) as p from g)) as gx, (select arg_min(p, abs(p - least(greatest(sy, -1), 1))) from (select distinct round(y, 9) as p from g)) as gy, sx, sy
 from (select vec_id, 1 as k, px as sx, py as sy from pos union all select vec_id, 2, mx, my from pos) z),
sg as (select sd.*, gof from sd join f on f.vec_id = sd.vec_id and abs(f.x - gx) < 1e-6 and abs(f.y - gy) < 1e-6),
b as (select vec_id, arg_min(sx, gof) as sx, arg_min(sy, gof) as sy, min(gof) as seed_gof from sg group by vec_id),
w as (select f.vec_id, x, y, gof, seed_gof from f join b using (vec_id)
 where round((x + 1) * 7) between floor((greatest(sx - 0.25, -1) + 1) * 7 + 0.5) and floor((least(sx + 0.25, 1 - 0.01 / 7) + 1) * 7 + 0.5)
 and round((y + 1) * 7) between floor((greatest(sy - 0.25, -1) + 1) * 7 + 0.5) and floor((least(sy + 0.25, 1 - 0.01 / 7) + 1) * 7 + 0.5))
select vec_id, round(arg_min(x, gof), 6) as x, round(arg_min(y, gof), 6) as y, round(min(gof), 4) as gof, round(min(seed_gof), 4) as seed_gof, 60 as ndf from w group by vec_id""")
def pattern_position_seeded(spark, sf_dir):
    """From the better of two seeds, the weighted mean and the brightest channel, without channel 5 (dead)."""
    i = np.arange(64)
    place = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in zip(i % 8 / 3.5 - 1, i // 8 / 3.5 - 1)))
    peaks = positive(spark, sf_dir).select("vec_id", F.transform("w", lambda v: v * 100).alias("areas"), place.alias("at"))
    peaks = peaks.withColumn("alive", F.transform("areas", lambda v, k: F.when(k == 5, 0.0).otherwise(v)))
    mean = lambda c: F.aggregate(F.zip_with("alive", "at", lambda v, p: v * p[c]), F.lit(0.0), lambda s, v: s + v) / waves.total(F.col("alive"))
    top = F.get("at", F.array_position("alive", F.array_max("alive")).cast("int") - 1)
    peaks = peaks.select("vec_id", "areas", F.array(F.struct(mean("x").alias("x"), mean("y").alias("y")), top).alias("seeds"), F.transform("areas", lambda v, k: k != 5).alias("use"))
    fits = pattern_fit.fit_positions(peaks, "areas", _patterns(), "likelihood_poisson", seeds="seeds", size=0.5, use="use", lost=3)
    return fits.select("vec_id", F.round("fit.x", 6).alias("x"), F.round("fit.y", 6).alias("y"), F.round("fit.gof", 4).alias("gof"), F.round(F.array_min("fit.seed_gofs"), 4).alias("seed_gof"), "fit.ndf")
