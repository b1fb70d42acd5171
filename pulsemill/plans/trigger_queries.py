"""Event building on the driver's events table: event -> pulse, user -> channel, type -> detector, value -> area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import islands, trigger
from .catalogue import query

S = islands.SECOND
SIGNAL_GAP, EVENT_GAP, LEFT, RIGHT = 60 * S, 600 * S, 60 * S, 120 * S
S1_RMS, S2_PULSES = 20 * S, 3
#: Width of the buckets in which pulses and signals meet event ranges: a few ranges long.
RANGE_WIDTH = 4 * EVENT_GAP
STEPS = {1: {2: 0.0, 3: 1.0}, 2: {2: 0.0, 4: 1.0}}


def pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    time = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return e.select(F.col("event_id").alias("pulse_id"), time.alias("time"), F.col("user_id").alias("pmt"), F.col("value").alias("area"), F.col("event_type").alias("detector"))


P = "p as (select event_id as pulse_id, epoch_us(ts) * 1000 as time, user_id as pmt, value as area, event_type as detector from events)"
SESS = f"""{P}, n as (select *, case when time - lag(time) over (order by time, pulse_id) < {SIGNAL_GAP} then 0 else 1 end as new from p),
s as (select *, sum(new) over (order by time, pulse_id) as sid from n),
m as (select *, time - min(time) over (partition by sid) as rel from s),
sig as (select min(time) as left_time, max(time) as right_time, count(*) as n_pulses, count(distinct pmt) as n_contributing_channels,
 sum(area) as area, avg(rel) as time_mean, stddev_pop(rel) as time_rms from m group by sid having count(*) >= 2),
cls as (select *, case when time_rms > {S1_RMS} and n_pulses >= {S2_PULSES} then 2 when time_rms > {S1_RMS} then 0 else 1 end as type from sig),
trg as (select * from cls where (type = 1 and n_pulses >= 3) or (type = 2 and n_pulses >= 4)),
en as (select *, case when left_time - lag(left_time) over (order by left_time) < {EVENT_GAP} then 0 else 1 end as new from trg),
es as (select *, sum(new) over (order by left_time) as ev from en),
rng as (select min(left_time) - {LEFT} as start, max(right_time) + {RIGHT} as stop, count(*) as n_triggers from es group by ev)"""
_SHOW = "left_time, right_time, n_pulses, n_contributing_channels, round(area, 3) as area, round(time_mean / 1e9, 10) as mean_s, round(time_rms / 1e9, 7) as rms_s"


def _show(df: DataFrame, *more: str) -> DataFrame:
    return df.select("left_time", "right_time", "n_pulses", "n_contributing_channels", F.round("area", 3).alias("area"), F.round(F.col("time_mean") / 1e9, 10).alias("mean_s"), F.round(F.col("time_rms") / 1e9, 7).alias("rms_s"), *more)


def signals(spark, sf_dir) -> DataFrame:
    return trigger.classify_signals(trigger.find_signals(pulses(spark, sf_dir), SIGNAL_GAP), S1_RMS, S2_PULSES)


def ranges(spark, sf_dir) -> DataFrame:
    t = trigger.decide_triggers(signals(spark, sf_dir), STEPS).filter("trigger")
    return trigger.event_ranges(t, EVENT_GAP, LEFT, RIGHT)


@query(f"with {SESS} select {_SHOW} from sig")
def trigger_signals(spark, sf_dir):
    return _show(trigger.find_signals(pulses(spark, sf_dir), SIGNAL_GAP))


@query(f"with {SESS} select {_SHOW}, type, (type = 1 and n_pulses >= 3) or (type = 2 and n_pulses >= 4) as trigger from cls")
def trigger_classified(spark, sf_dir):
    return _show(trigger.decide_triggers(signals(spark, sf_dir), STEPS), "type", "trigger")


@query(f"with {SESS} select start, stop, n_triggers from rng")
def event_ranges(spark, sf_dir):
    return ranges(spark, sf_dir)


@query(f"with {SESS} select left_time, n_pulses, type, start, stop from cls join rng on left_time >= start and left_time <= stop")
def signals_in_events(spark, sf_dir):
    return trigger.signals_in_events(signals(spark, sf_dir).select("left_time", "n_pulses", "type"), ranges(spark, sf_dir).drop("n_triggers"), RANGE_WIDTH)


@query(f"with {SESS} select pulse_id, time, pmt, start, stop from p join rng on time >= start and time < stop")
def event_fill(spark, sf_dir):
    return trigger.fill_events(pulses(spark, sf_dir).select("pulse_id", "time", "pmt"), ranges(spark, sf_dir).drop("n_triggers"), RANGE_WIDTH)


@query(f"with {SESS}, one as (select sid from s group by sid having count(*) = 1) select pmt, count(*) as n_lone from s where sid in (select sid from one) group by pmt")
def lone_pulses(spark, sf_dir):
    return trigger.lone_pulses(pulses(spark, sf_dir), SIGNAL_GAP).groupBy("pmt").agg(F.count("*").alias("n_lone"))


@query(f"""with {P}, i as (select unnest(generate_series((select min(time) // {3600 * S} from p), (select max(time) // {3600 * S} from p))) as interval),
c as (select distinct pmt from p), k as (select time // {3600 * S} as interval, pmt, count(*) as n from p group by all)
select i.interval, c.pmt, coalesce(n, 0) as n from i cross join c left join k on k.interval = i.interval and k.pmt = c.pmt""")
def pulse_rate(spark, sf_dir):
    return trigger.pulse_rates(pulses(spark, sf_dir), 3600 * S)


@query(f"with {SESS}, t as (select min(pmt) as a, max(pmt) as b from s group by sid having count(distinct pmt) = 2) select a, b, count(*) as n_coincidences from t group by a, b")
def pair_coincidence(spark, sf_dir):
    return trigger.pair_coincidences(pulses(spark, sf_dir), SIGNAL_GAP)


@query(f"""with {P}, m as (select 'all' as system, time, detector = 'error' as "on" from p where detector in ('error', 'signup')),
w as (select *, lag("on") over (partition by system order by time, "on") as was from m), t as (select * from w where (was is null and "on") or was <> "on"),
q as (select system, time as start, "on", lead(time) over (partition by system order by time, "on") as stop from t),
c as (select system, start, stop, unnest(generate_series(start // {3600 * S}, stop // {3600 * S})) as interval from q where "on" and stop is not null)
select system, interval, cast(sum(least(stop, (interval + 1) * {3600 * S}) - greatest(start, interval * {3600 * S})) as bigint) as dead_ns from c group by all""")
def dead_time(spark, sf_dir):
    p = pulses(spark, sf_dir).filter(F.col("detector").isin("error", "signup"))
    return trigger.dead_time(p.select(F.lit("all").alias("system"), "time", (F.col("detector") == "error").alias("on")), 3600 * S)


N_EDGES, RMS_EDGES = [2, 3, 4, 5, 8], [0.0, 1.0, 5.0, 10.0, 20.0, 40.0, 80.0]


@query(f"""with {SESS} select case when n_pulses >= 5 then 3 when n_pulses >= 4 then 2 when n_pulses >= 3 then 1 else 0 end as x_bin,
case when r >= 40 then 5 when r >= 20 then 4 when r >= 10 then 3 when r >= 5 then 2 when r >= 1 then 1 else 0 end as y_bin, count(*) as n from (select n_pulses, round(time_rms / 1e9, 7) as r from sig) group by all""")
def signal_histogram_2d(spark, sf_dir):
    s = trigger.find_signals(pulses(spark, sf_dir), SIGNAL_GAP)
    return trigger.histogram_2d(s, F.col("n_pulses"), N_EDGES, F.round(F.col("time_rms") / 1e9, 7), RMS_EDGES)


@query(f"""with {P}, i as (select unnest(generate_series((select min(time) // {86400 * S} from p), (select max(time) // {86400 * S} from p))) as k),
c as (select time // {86400 * S} as k, count(*) as n from p group by 1) select i.k * {86400 * S} as start, (i.k + 1) * {86400 * S} as stop, coalesce(n, 0) as n_pulses from i left join c on c.k = i.k""")
def fixed_segments(spark, sf_dir):
    return trigger.fixed_segments(pulses(spark, sf_dir), 86400 * S)


@query(f"""with {SESS} select left_time, right_time, n_pulses, round(area, 3) as area, type, trigger from (
select left_time, right_time, n_pulses, area, type, (type = 1 and n_pulses >= 3) or (type = 2 and n_pulses >= 4) as trigger from cls
union all select time, time, 1, area, 9, true from p where detector = 'purchase')""")
def any_pulse_trigger(spark, sf_dir):
    s = trigger.decide_triggers(signals(spark, sf_dir), STEPS)
    p = pulses(spark, sf_dir).filter("detector = 'purchase'")
    return trigger.any_pulse_triggers(s, p, 9).withColumn("area", F.round("area", 3))


@query(f"""with {P}, g as (select time, lead(time) over (order by time) - time as d from p),
b as (select max(time) as break_after from g where d > {900 * S}) select coalesce(break_after, (select max(time) from p)) as break_after, (select max(time) from p) as last_time from b""")
def last_break(spark, sf_dir):
    return trigger.last_break(pulses(spark, sf_dir), 900 * S)


@query(f"""with {P}, o as (select pulse_id, time as left_a, time + cast(area * 1e9 as bigint) as right_a, pmt from p where detector = 'click'),
q as (select pulse_id as other, time as left_b, time + {300 * S} as right_b from p where detector = 'error')
select pulse_id, count(other) as n_overlaps from o left join q on left_b <= right_a and right_b >= left_a group by pulse_id""")
def overlap_count(spark, sf_dir):
    p = pulses(spark, sf_dir)
    stop = F.col("time") + F.round(F.col("area") * 1e9).cast("long")
    a = p.filter("detector = 'click'").select("pulse_id", F.col("time").alias("left_a"), stop.alias("right_a"))
    b = p.filter("detector = 'error'").select(F.col("time").alias("left_b"), (F.col("time") + 300 * S).alias("right_b"))
    n = islands.overlap_pairs(a, b, [], 3600 * S).groupBy("pulse_id").agg(F.count("*").alias("n"))
    return a.join(n, "pulse_id", "left").select("pulse_id", F.coalesce("n", F.lit(0)).alias("n_overlaps"))


@query(f"""with {P}, a as (select detector, list_sort(list(distinct pmt)) as s from p where pmt % 3 <> 0 or detector <> 'click' group by detector)
select x.detector as a, y.detector as b, len(list_intersect(x.s, y.s)) as n_both, len(list_distinct(list_concat(x.s, y.s))) as n_either,
len(list_filter(x.s, lambda z: not list_contains(y.s, z))) as n_only_a, list_contains(x.s, 7) as has_7 from a x join a y on x.detector < y.detector""")
def channel_sets(spark, sf_dir):
    p = pulses(spark, sf_dir).filter("pmt % 3 <> 0 or detector <> 'click'").groupBy("detector").agg(F.collect_set("pmt").alias("s"))
    x, y = p.select(F.col("detector").alias("a"), F.col("s").alias("x")), p.select(F.col("detector").alias("b"), F.col("s").alias("y"))
    pairs = x.join(F.broadcast(y), F.col("a") < F.col("b"))  # one row per detector
    size = lambda c: F.size(c).cast("long")
    return pairs.select("a", "b", size(F.array_intersect("x", "y")).alias("n_both"), size(F.array_union("x", "y")).alias("n_either"), size(F.array_except("x", "y")).alias("n_only_a"), F.array_contains("x", F.lit(7).cast("long")).alias("has_7"))


@query(f"""with {P}, h as (select *, row_number() over (partition by pmt order by time, pulse_id) as k, time - lag(time) over (partition by pmt order by time, pulse_id) - 1 as gap from p),
c as (select *, sum(case when gap <= {7200 * S} then 0 else 1 end) over (partition by pmt order by time, pulse_id) as cluster from h)
select pmt, cast(cluster as bigint) as cluster, count(*) as n_hits, min(time) as "left", max(time) as "right", round(sum(area), 3) as area from c group by all""")
def hit_gap_clusters(spark, sf_dir):
    from ..operators.peaks import cluster_hits

    hits = pulses(spark, sf_dir).select("pmt", F.col("time").alias("index_of_maximum"), "pulse_id", "area")
    c = cluster_hits(hits, ["pmt"], 7200 * S, tie="pulse_id")
    return c.groupBy("pmt", "cluster").agg(F.count("*").alias("n_hits"), F.min("index_of_maximum").alias("left"), F.max("index_of_maximum").alias("right"), F.round(F.sum("area"), 3).alias("area"))


@query(f"""with {P}, h as (select *, time - lag(time) over (partition by detector order by time, pulse_id) - 1 as gap from p),
c as (select *, sum(case when gap <= {60 * S} then 0 else 1 end) over (partition by detector order by time, pulse_id) as cluster from h),
k as (select *, count(distinct pmt) over (partition by detector, cluster) >= 3 as tight from (select *, 0 as z from c)),
r as (select *, time - lag(time) over (partition by detector order by time, pulse_id) - 1 as gap2 from k where not tight),
r2 as (select *, sum(case when gap2 <= {3600 * S} then 0 else 1 end) over (partition by detector order by time, pulse_id) as cluster2 from r),
o as (select detector, 1 as pass, cluster, time from k where tight union all select detector, 2, cluster2, time from r2)
select detector, pass, cast(cluster as bigint) as cluster, count(*) as n_hits, min(time) as "left", max(time) as "right" from o group by all""")
def two_pass_clusters(spark, sf_dir):
    from ..operators.peaks import two_pass_clusters as clusters

    hits = pulses(spark, sf_dir).select("detector", F.col("time").alias("index_of_maximum"), "pulse_id", F.col("pmt").alias("channel"))
    keep = F.col("n_channels") >= 3
    c = clusters(hits, ["detector"], 60 * S, 3600 * S, keep, tie="pulse_id", width=86400 * S)
    return c.groupBy("detector", "pass", "cluster").agg(F.count("*").alias("n_hits"), F.min("index_of_maximum").alias("left"), F.max("index_of_maximum").alias("right"))


@query(f"""with {P}, a as (select pulse_id, time, pmt, area, row_number() over (partition by pmt order by area desc, pulse_id) as k1 from p where detector = 'click'),
b as (select pulse_id, time, pmt, area, row_number() over (partition by pmt order by area desc, pulse_id) as k2 from p where detector = 'purchase')
select a.pmt as event, a.pulse_id as s1, b.pulse_id as s2, b.time - a.time as drift_time, cast(row_number() over (partition by a.pmt order by k2, k1) as int) as interaction_id from a join b on a.pmt = b.pmt and b.time >= a.time where k1 <= 3 and k2 <= 3 and b.area >= 10""")
def interactions(spark, sf_dir):
    from ..operators.interactions import pair_interactions

    p = pulses(spark, sf_dir).select(F.col("pmt").alias("event"), F.col("pulse_id").alias("peak_id"), F.col("time").alias("t"), "area", "detector", F.lit(0).alias("tight_coincidence"))
    s1, s2 = p.filter("detector = 'click'"), p.filter("detector = 'purchase'")
    return pair_interactions(s1, s2, ["event"], 3, 3, 10.0).select("event", "s1", "s2", "drift_time", "interaction_id")
