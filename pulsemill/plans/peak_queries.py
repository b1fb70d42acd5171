"""Peak queries on orders and lineitem: order -> peak, line -> hit, customer -> event."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import interactions, islands, peaks
from .catalogue import query


def hits(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))
    return li.select(
        F.col("l_orderkey").alias("peak_id"),
        F.col("l_linenumber").alias("hit_id"),
        (F.col("l_suppkey") % 16).cast("int").alias("channel"),
        day.alias("index_of_maximum"),
        (day - F.col("l_linenumber")).alias("left"),
        (day + F.col("l_quantity").cast("int")).alias("right"),
        day.cast("double").alias("center"),
        F.col("l_quantity").alias("area"),
        F.col("l_discount").alias("height"),
    )


H = """h as (select l_orderkey as peak_id, l_linenumber as hit_id, cast(l_suppkey % 16 as int) as channel, date_diff('day', date '1990-01-01', cast(l_shipdate as date)) as d,
l_quantity as area, l_discount as height from lineitem), hh as (select *, cast(d - hit_id as int) as l, cast(d + cast(area as int) as int) as r from h)"""


@query(f'with {H} select peak_id, sum(area) as area, count(*) as n_hits, count(distinct channel) as n_channels, min_by(l, struct_pack(a := d, b := l)) as "left", max(r) as "right", count(distinct channel) = 1 as lone from hh group by peak_id')
def peak_basics(spark, sf_dir):
    return peaks.peak_basics(hits(spark, sf_dir), ["peak_id"])


@query(f"""with {H}, t as (select *, cast(d - min(d) over (partition by peak_id) as double) as rel from hh)
select peak_id, round(sum(height * area) / sum(area), 12) as mean_amplitude, round(sum(case when channel < 8 then area else 0 end) / sum(area), 12) as area_fraction_top,
round(avg(case when channel < 8 then 1.0 else 0.0 end), 6) as hits_fraction_top, round(sum(rel * area) / sum(area), 10) as hit_time_mean,
round(sqrt(greatest(sum(rel * rel * area) / sum(area) - pow(sum(rel * area) / sum(area), 2), 0)), 4) as hit_time_std,
max_by(channel, struct_pack(a := area, b := -channel)) as largest_hit_channel, max(area) as largest_hit_area from t group by peak_id""")
def peak_properties(spark, sf_dir):
    p = peaks.peak_properties(hits(spark, sf_dir), ["peak_id"], F.col("channel") < 8)
    digits = {"mean_amplitude": 12, "area_fraction_top": 12, "hits_fraction_top": 6, "hit_time_mean": 10, "hit_time_std": 4}
    return p.select("peak_id", *(F.round(c, n).alias(c) for c, n in digits.items()), "largest_hit_channel", "largest_hit_area")


@query(f"""with {H}, k as (select distinct peak_id from h), c as (select unnest(range(16)) as channel), s as (select peak_id, channel, sum(area) as v from h group by all)
select k.peak_id, list(coalesce(v, 0.0) order by c.channel) as per_channel from k cross join c left join s on s.peak_id = k.peak_id and s.channel = c.channel group by k.peak_id""")
def per_channel_array(spark, sf_dir):
    return peaks.per_channel(hits(spark, sf_dir), ["peak_id"], 16, F.col("area"))


@query(f"""with {H}, m as (select peak_id, max_by(d, struct_pack(a := area, b := -d)) as t from h group by peak_id)
select h.peak_id, count(distinct case when abs(d - t) <= 5 then channel end) as tight_5, count(distinct case when abs(d - t) <= 30 then channel end) as tight_30 from h join m on h.peak_id = m.peak_id group by h.peak_id""")
def tight_coincidence(spark, sf_dir):
    h = hits(spark, sf_dir)
    t = h.groupBy("peak_id").agg(F.max_by("index_of_maximum", F.struct("area", -F.col("index_of_maximum"))).alias("t"))
    return peaks.tight_coincidence(h.join(t, "peak_id"), "t", ["peak_id"], [5, 30])


@query("""with p as (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rk from orders)  select o_custkey, o_orderkey, o_totalprice, cast(rk as int) as rank from p where rk <= 3""")
def top_k_peaks(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_totalprice")
    return peaks.top_peaks(o, ["o_custkey"], F.col("o_totalprice"), 3, "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice", "rank")


@query("""with l as (select o_custkey as event, max_by(o_orderkey, struct_pack(a := o_totalprice, b := -o_orderkey)) as big from orders where o_orderstatus = 'F' group by 1),
f as (select o_custkey as event, min(o_orderkey) as main from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' group by 1)
select l.event, coalesce(main, big) as main_s2 from l left join f on l.event = f.event""")
def main_peak(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderstatus = 'F'")
    p = o.select(F.col("o_custkey").alias("event"), F.col("o_orderkey").alias("peak_id"), F.col("o_totalprice").alias("area"), F.lit("s2").alias("type"))
    first = o.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("event")).agg(F.min("o_orderkey").alias("s2")).withColumn("interaction_id", F.lit(1))
    return interactions.main_peaks(p, first, ["event"], "s2")


SHAPE = f"""{H}, b as (select peak_id, sum(area) as area, count(distinct channel) as n_channels, sum(case when channel < 8 then area else 0 end) / sum(area) as aft, max(d) - min(d) as width from h group by peak_id),
c as (select *, case when n_channels = 1 then 'lone_hit' else 'unknown' end as old, width / 2.0 as rise from b)"""


def _shapes(spark, sf_dir):
    h = hits(spark, sf_dir)
    b = h.groupBy("peak_id").agg(F.sum("area").alias("area"), F.count_distinct("channel").alias("n_channels"), (F.sum(F.when(F.col("channel") < 8, F.col("area")).otherwise(0.0)) / F.sum("area")).alias("area_fraction_top"), (F.max("index_of_maximum") - F.min("index_of_maximum")).alias("width"))
    return b.withColumns({"type": F.when(F.col("n_channels") == 1, "lone_hit").otherwise("unknown"), "rise_time": F.col("width") / 2.0, "tight_coincidence": F.col("n_channels")})


@query(f"with {SHAPE} select peak_id, case when old = 'lone_hit' then old when area > 50 and width < 100 then 's1' when area > 50 and width > 250 then 's2' when area <= 50 and width < 75 then 's1' when area <= 50 then 's2' else old end as type from c")
def classify_a(spark, sf_dir):
    return peaks.classify_by_width(_shapes(spark, sf_dir)).select("peak_id", "type")


@query(f"with {SHAPE} select peak_id, case when old = 'lone_hit' then old when rise <= (case when width < 100 then 70 else 50 end) and n_channels >= 3 and aft <= 0.7 then 's1' when n_channels >= 4 and rise > 80 then 's2' else 'unknown' end as type from c")
def classify_b(spark, sf_dir):
    return peaks.classify_by_shape(_shapes(spark, sf_dir)).select("peak_id", "type")


@query(f"""with {H}, n as (select channel, cast(count(*) % 7 as double) as pen from h group by channel), w as (select h.*, pen, sum(case when pen >= 3 then 0 else area end) over (partition by peak_id) as wit from h join n on h.channel = n.channel)
select peak_id, hit_id, pen >= 3 and pen * 8 > wit as is_rejected from (select peak_id, hit_id, pen, wit from w)""")
def noise_rejection(spark, sf_dir):
    h = hits(spark, sf_dir)
    c = h.groupBy("channel").agg((F.count("*") % 7).cast("double").alias("n_noise")).select("channel", F.col("n_noise"), F.lit(0.0).alias("n_lone"), F.lit(0.0).alias("base"))
    return peaks.reject_noise(h, ["peak_id"], c, 8.0, 1.0, 24.0).select("peak_id", "hit_id", "is_rejected")


@query("""with k as (select distinct l_orderkey as channel, l_linenumber as n from lineitem where (l_partkey + l_linenumber) % 3 <> 0), g as (select channel, n, n - row_number() over (partition by channel order by n) as g from k)
select channel, cast(min(n) as int) as "left", cast(max(n) as int) as "right", count(*) as n_parts from g group by channel, g""")
def coalesce_intervals(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("(l_partkey + l_linenumber) % 3 <> 0")
    p = li.select(F.col("l_orderkey").alias("channel"), F.col("l_linenumber").alias("left"), F.col("l_linenumber").alias("right")).distinct()
    r = islands.adjacent_intervals(p, ["channel"], "left", "right")
    return r.groupBy("channel", "run").agg(F.min("left").alias("left"), F.max("right").alias("right"), F.count("*").alias("n_parts")).drop("run")


@query()
def natural_breaks(spark, sf_dir):
    from ..operators.splitting import split_natural

    h = hits(spark, sf_dir).select("peak_id", "hit_id", F.col("index_of_maximum").cast("double").alias("t"), "area")
    return split_natural(h, ["peak_id"], "hit_id", "t", "area", 5.0, [(0.0, 0.6), (2.0, 0.5), (4.0, 0.4)])
