"""Trees, rejection and the composed hit finder on the driver's tables: customer -> orders -> lines; lines as hits; vectors as pulses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import peaks, waves
from ..sources.flat import nest
from ..sources.tree import flatten_tree, nest_tree
from .catalogue import query


def _customers(spark, sf_dir) -> DataFrame:
    """A row for each customer, with orders and, in them, lines."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    inner = nest(orders.withColumnRenamed("o_orderkey", "l_orderkey"), lines, ["l_orderkey"], ["l_linenumber"], "lines").withColumnRenamed("l_orderkey", "o_orderkey")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return nest(customers, inner, ["o_custkey"], ["o_orderkey"], "orders").withColumnRenamed("o_custkey", "c_custkey")


@query("""with l as (select l_orderkey, count(*) as n from lineitem group by 1),
o as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) - 1 as k, coalesce(n, 0) as n from orders left join l on l_orderkey = o_orderkey where o_custkey in (select c_custkey from customer))
select o_custkey as c_custkey, k::int as orders_index, o_orderkey, n::bigint as n_lines, coalesce(sum(n) over (order by o_custkey, k rows between unbounded preceding and 1 preceding), 0)::bigint as lines_start from o""")
def tree_orders(spark, sf_dir):
    return flatten_tree(_customers(spark, sf_dir), ["c_custkey"])["orders"]


@query("""select c_custkey, o_orderkey, l_linenumber, l_partkey, l_quantity::double as l_quantity, (row_number() over (partition by c_custkey, o_orderkey order by l_linenumber, l_partkey, l_quantity) - 1)::int as lines_index
from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey""")
def tree_round_trip(spark, sf_dir):
    """Flattened to three tables, nested again, and taken apart by hand."""
    whole = _customers(spark, sf_dir)
    again = nest_tree(flatten_tree(whole, ["c_custkey"]), ["c_custkey"], whole.schema)
    orders = again.select("c_custkey", F.explode("orders").alias("o"))
    lines = orders.select("c_custkey", "o.o_orderkey", F.posexplode("o.lines").alias("lines_index", "l"))
    return lines.select("c_custkey", "o_orderkey", "l.l_linenumber", "l.l_partkey", "l.l_quantity", "lines_index")


BASE, THRESHOLD = {3: 60.0, 5: 2.0}, 4.0
HITS = """h as (select l_suppkey as event, l_partkey % 250 as peak, l_orderkey * 8 + l_linenumber as hit, l_orderkey % 12 as channel, l_quantity::double as area, l_orderkey as "left", l_orderkey + l_linenumber as "right", l_orderkey as index_of_maximum from lineitem),
b as (select event, peak from h group by all having count(distinct channel) = 1),
lone as (select h.event, channel, "left" from h join b using (event, peak)),
n as (select event, channel, count(*) as n from (select event, channel from lone where "left" < 30000 union all select event, channel from lone where "left" < 30000) group by all),
noise as (select event, channel, count(*) as n from h where area <= 2 group by all),
pen0 as (select event, channel, n / 2 * 1.0 as p from n union all select event, channel, n * 0.5 from noise union all select event, c, v from (select event from lone union select event from h where area <= 2) e, (values (3, 60.0), (5, 2.0)) x(c, v)),
pen as (select event, channel, sum(p) as p from pen0 group by all having sum(p) >= 4.0),
m as (select h.*, p, sum(case when p is null then area else 0 end) over (partition by event, peak) as witness from h left join pen using (event, channel)),
k as (select *, coalesce(p > witness, false) as gone from m)"""


def _rejected(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = F.col("l_orderkey")
    hits = li.select(F.col("l_suppkey").alias("event"), (F.col("l_partkey") % 250).alias("peak"), (order * 8 + F.col("l_linenumber")).alias("hit"), (order % 12).alias("channel"), F.col("l_quantity").cast("double").alias("area"), order.alias("left"), (order + F.col("l_linenumber")).alias("right"), order.alias("index_of_maximum"))
    alone = hits.groupBy("event", "peak").agg(F.count_distinct("channel").alias("n")).filter("n = 1").select("event", "peak")
    lone = hits.join(alone, ["event", "peak"], "left_semi").select("event", "channel", "left")
    penalties = peaks.channel_penalties(lone, hits.filter("area <= 2").select("event", "channel"), BASE, ["event"], 0.5, 1.0, 30000)
    return peaks.reject_and_rebuild(hits, penalties, ["event"], "peak", THRESHOLD)


@query(f"""with {HITS} select event, peak, round(sum(area), 3) as area, count(*) as n_hits, count(distinct channel) as n_channels, arg_min("left", "left") as "left", max("right") as "right", count(distinct channel) = 1 as lone,
any_value(suspicious) as n_suspicious from k join (select event, peak, count(distinct case when p is not null then channel end) as suspicious from k group by all) s using (event, peak) where not gone group by event, peak""")
def noise_rebuilt_peaks(spark, sf_dir):
    rebuilt = _rejected(spark, sf_dir)[1]
    return rebuilt.withColumns({"area": F.round("area", 3), "n_suspicious": F.size("suspicious_channels").cast("long")}).drop("suspicious_channels")


@query(f"""with {HITS}, r as (select event, channel, count(*) as n from k where gone group by all),
one as (select event, min(channel) as channel from k where not gone group by event, peak having count(distinct channel) = 1), o as (select event, channel, count(*) as n from one group by all)
select coalesce(r.event, o.event) as event, coalesce(r.channel, o.channel) as channel, coalesce(r.n, 0) as n_rejected, coalesce(o.n, 0) as n_lone from r full join o on r.event = o.event and r.channel = o.channel""")
def noise_rebuilt_counts(spark, sf_dir):
    return _rejected(spark, sf_dir)[2]


REFERENCE, SCALE = 16000, 1000


@query(f"""with e as (select vec_id, label, list_transform(embedding, lambda x: {REFERENCE} - cast(floor({SCALE} * cast(x as double)) as int)) as raw from embeddings),
s as (select vec_id, label, {REFERENCE} - unnest(raw) as v, cast(unnest(range(len(raw))) as int) as i from e),
b as (select *, avg(case when i < 16 then v end) over (partition by vec_id) as base from s), w as materialized (select vec_id, label, i, base, v, v - base as v0 from b),
p as (select vec_id, any_value(label) as label, any_value(base) as base, coalesce(sqrt(sum(case when v < base then (v - base) * (v - base) end) / count(*) filter (v < base)), 0) as noise, min(v) - any_value(base) as low from w group by vec_id),
t as materialized (select vec_id, base, floor(greatest(noise * 1.5, 20.0, -low * 0.2)) as threshold from p where label % 5 <> 4),
a as (select w.vec_id, i, i - row_number() over (partition by w.vec_id order by i) as g from w join t using (vec_id) where v0 > threshold),
r0 as materialized (select vec_id, min(i) as l, max(i) as r, row_number() over (partition by vec_id order by min(i)) as k from a group by vec_id, g), r as (select * from r0 where k <= 6),
x1 as (select *, least(r + 3, coalesce(lead(l) over q - 1, 63), 63) as rx from r window q as (partition by vec_id order by l)),
x as (select vec_id, greatest(l - 1, coalesce(lag(rx) over q + 1, 0), 0) as l, rx as r from x1 window q as (partition by vec_id order by l)),
h as (select x.vec_id, x.l, x.r, sum(v0) as area, max(v0) as height, arg_max(i, v0) as top, sum(v0 * i) / sum(v0) as center from x join w on w.vec_id = x.vec_id and i between l and r group by all having sum(v0) > 0)
select h.vec_id, threshold, (select count(*) from r where r.vec_id = h.vec_id)::int as n_hits_found, l::int as "left", r::int as "right", round(area / 100, 6) as area, round(height / 100, 6) as height, top::int as index_of_maximum, round(center, 6) as center from h join t using (vec_id)""")
def pulse_hits(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.transform("embedding", lambda x: (REFERENCE - F.floor(SCALE * x.cast("double"))).cast("int")).alias("raw"))
    found = waves.find_pulse_hits(e, ["vec_id"], "raw", float(REFERENCE), 16, 1.5, 20.0, 0.2, 1, 3, factor=F.lit(0.01), alive=F.col("label") % 5 != 4, most=6)
    hits = found.select("vec_id", F.col("threshold").cast("double").alias("threshold"), "n_hits_found", F.explode("hits").alias("h")).select("vec_id", "threshold", "n_hits_found", "h.*")
    return hits.select("vec_id", "threshold", "n_hits_found", "left", "right", F.round("area", 6).alias("area"), F.round("height", 6).alias("height"), "index_of_maximum", F.round("center", 6).alias("center"))


def band_passed(spark, sf_dir):
    """Each vector through the band-pass; a recursion that SQL has no words for."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return waves.band_pass(e, ["vec_id"], "embedding", 0.05, 0.4)


query()(band_passed)
