"""Channel and selection queries on lineitem (order -> event, line -> peak), events (user -> channel) and embeddings (waveforms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import channels
from .catalogue import query
from .wave_queries import table


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("select n_nationkey as channel, r_name as detector from nation join region on n_regionkey = r_regionkey")
def detector_map(spark, sf_dir):
    lists = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list("n_nationkey").alias("channels"))  # a list for each of the regions
    named = lists.join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("r_name", "detector")
    return channels.detector_by_channel(named)


@query("""select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) as rank
from lineitem where lower(l_returnflag) = 'r' and l_linestatus = 'F'""")
def peaks_by_type(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("detector"))
    return channels.peaks_by_type(p, ["l_orderkey"], "r", "F", F.col("l_extendedprice"), "l_linenumber").select("l_orderkey", "l_linenumber", "rank")


@query("""select l_orderkey, n, n <= 4 or cast(('0x' || substr(md5(cast(l_orderkey as varchar)), 1, 8)) as bigint) / 4294967296.0 < 0.25 as kept
from (select l_orderkey, count(*) as n from lineitem group by l_orderkey)""")
def prescaled_veto(spark, sf_dir):
    n = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return channels.prescale(n, F.col("n"), 4, F.col("l_orderkey"), 0.25)


@query("""select l_suppkey as channel, count(*) as n_pulses, cast(coalesce(sum(cast(l_quantity < 10 and l_tax > 0 as int)), 0) as bigint) as n_noise_pulses from lineitem group by l_suppkey""")
def channel_counts(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "channel")
    return channels.channel_counts(p, ["channel"], F.when(F.col("l_quantity") < 10, 0).otherwise(1), F.col("l_tax"))


@query("""with o as (select l_orderkey, any_value(l_suppkey) as channel, any_value(l_quantity) as pos from lineitem group by l_orderkey having count(*) = 1)
select channel, count(*) as n_lone, cast(sum(cast(pos < 25 as int)) as bigint) as n_lone_before from o group by channel""")
def lone_hit_counts(spark, sf_dir):
    one = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.first("l_suppkey").alias("channel"), F.first("l_quantity").alias("at"), F.count("*").alias("n")).filter("n = 1")
    return channels.lone_hits(one, ["channel"], F.col("at"), 25)


@query("""select l_returnflag as run, count(*) as n_events, cast(sum(least(l_linenumber * 3, 12)) as bigint) as total_time, cast(sum(cast(l_linenumber * 3 > 12 as int)) as bigint) as n_truncated from lineitem group by l_returnflag""")
def run_totals(spark, sf_dir):
    r = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("run"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + 3 * F.col("l_linenumber")).alias("stop"))
    out = channels.run_totals(r, ["run"], 12)
    return out.withColumn("total_time", F.col("total_time").cast("long"))


@query("""with t as (select user_id, event_id, value, epoch_us(ts) // 1000000 as t from events), b as (select user_id, min(t) as lo, max(t) as hi from t group by user_id),
s as (select t.user_id, event_id, value, cast(floor((t - lo) * 5 / (hi - lo + 1)) as bigint) as section from t join b on t.user_id = b.user_id)
select user_id, section, event_id, value from (select *, row_number() over (partition by user_id, section order by value desc, event_id) as k from s) where k = 1""")
def largest_per_section(spark, sf_dir):
    t = read(spark, sf_dir, "events").select("user_id", "event_id", "value", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).alias("t"))
    return channels.largest_per_section(t, ["user_id"], "t", "value", "event_id", 5)


INTERVALS = "i as (select l_orderkey, 10 * l_linenumber as \"left\", cast(floor(10 * l_linenumber + max(l_quantity) % 10) as int) as \"right\" from lineitem group by l_orderkey, l_linenumber)"


@query(f"""with {INTERVALS}, a as (select l_orderkey, "right" + 1 as "left", coalesce(lead("left") over (partition by l_orderkey order by "left") - 1, 99) as "right" from i
union all select l_orderkey, 0 as "left", min("left") - 1 as "right" from i group by l_orderkey) select l_orderkey, cast("left" as bigint) as "left", cast("right" as bigint) as "right" from a where "left" <= "right" """)
def free_regions(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    i = line.select("l_orderkey", (10 * F.col("l_linenumber")).alias("left"), F.floor(10 * F.col("l_linenumber") + F.col("l_quantity") % 10).cast("int").alias("right"))
    out = channels.free_regions(i, ["l_orderkey"], 0, F.lit(99))
    return out.select("l_orderkey", F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"))


@query("""select a.l_orderkey, 1 as s1, 2 as s2, a.l_quantity as s1_area, b.l_quantity as s2_area from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey where a.l_linenumber = 1 and b.l_linenumber = 2""")
def interaction_peaks(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("area"))
    found = p.groupBy("l_orderkey").agg(F.lit(1).alias("s1"), F.lit(2).alias("s2"))
    return channels.interaction_peaks(found, p, ["l_orderkey"], "l_linenumber", ["area"])


@query("""select l_orderkey, gof, l_linenumber, l_quantity from (select *, row_number() over (partition by l_orderkey order by gof, l_linenumber) as k from
(select l_orderkey, l_linenumber, l_quantity, l_extendedprice as gof from lineitem where l_discount > 0.02)) where k = 1""")
def best_seed(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).otherwise(float("nan")).alias("gof"))
    return channels.best_seed(p, ["l_orderkey"], "gof", "l_linenumber", ["l_quantity"])


@query("""select event_id, last_value(case when event_type = 'click' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as baseline from events""")
def last_baseline(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumns({"v": F.when(F.col("event_type") == "click", F.col("value")), "t": F.unix_micros(F.col("ts").cast("timestamp"))})
    return channels.last_known(e, ["user_id"], ["t", "event_id"], "v", "baseline", width=7 * 86_400_000_000).select("event_id", "baseline")


@query("""with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as w from embeddings),
s as (select vec_id, w[1] as x, unnest(range(1, 62)) as i, w from e),
c as (select vec_id, i from s where (x < 0.05 and w[i + 1] > 0.05 and w[i + 2] > 0.05) or (x > 0.05 and w[i + 1] < 0.05 and w[i + 2] < 0.05))
select e.vec_id, cast(coalesce(min(i), 63) as int) as i from e left join c on c.vec_id = e.vec_id group by e.vec_id""")
def next_crossing(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", channels.next_crossing(F.col("w"), 0, 0.05, 2, F.lit(63)).alias("i"))


@query("""select vec_id, cast(len(w) as int) as n, round(list_sum(w), 6) as area from (select vec_id, list_transform(embedding, lambda x: cast(x as double))[5:60] as w from embeddings)""")
def shrunk_pulses(spark, sf_dir):
    t = table(spark, sf_dir).withColumn("w", channels.shrunk(F.col("w"), 4))
    return t.select("vec_id", F.size("w").alias("n"), F.round(F.aggregate("w", F.lit(0.0), lambda s, x: s + x), 6).alias("area"))


@query("""with q as (select vec_id, (cast(embedding[1] as double) + 0.2) / 0.05 as pos from embeddings)
select vec_id, case when pos >= -0.5 and pos <= 8.5 then cast(least(greatest(floor(pos + 0.5), 0), 8) as int) end as i from q""")
def grid_index(spark, sf_dir):
    return table(spark, sf_dir).select("vec_id", channels.grid_index(F.col("w")[0], -0.2, 0.05, 9).alias("i"))


@query("""with s as (select vec_id, unnest(embedding) as v, unnest(range(64)) as i from embeddings), a as (select vec_id, abs(cast(v as double)) as x, 1.0 / (i + 1) as p, abs(cast(v as double)) > 0.25 as c from s),
t as (select vec_id, sum(case when c then 0 else x end) as seen, sum(case when c then 0 else p end) as expected, sum(p) as whole, sum(x) as area from a group by vec_id)
select vec_id, round(case when expected > 0 then seen + (whole - expected) * seen / expected else area end, 5) as area from t""")
def saturation_correction(spark, sf_dir):
    t = table(spark, sf_dir).withColumn("a", F.transform("w", lambda x: F.abs(x)))
    pattern = F.transform("a", lambda x, i: F.lit(1.0) / (i + 1))
    return t.select("vec_id", F.round(channels.saturation_correction(F.col("a"), pattern, F.transform("a", lambda x: x > 0.25)), 5).alias("area"))


@query("select p_partkey, md5(concat_ws('|', p_name, p_brand)) as id from part")
def hash_ids(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", channels.hash_id(F.col("p_name"), F.col("p_brand")).alias("id"))
