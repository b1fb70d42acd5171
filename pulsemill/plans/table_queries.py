"""Joins, sets, flat tables, registry and text helpers on the driver's relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational
from ..sources import flat
from .catalogue import query


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("select o_orderkey, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 45)")
def semi_filter(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return relational.filter_on_fields(o, read(spark, sf_dir, "lineitem").filter("l_quantity > 45"), ["o_orderkey"], ["l_orderkey"])


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)")
def anti_filter(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return relational.filter_on_fields(o, read(spark, sf_dir, "lineitem").filter("l_quantity > 45"), ["o_orderkey"], ["l_orderkey"], keep=False)


@query("select s_suppkey, coalesce(n_nationkey, 999) as channel from supplier left join (select n_nationkey from nation where n_nationkey < 20) on s_nationkey = n_nationkey")
def channel_lookup(spark, sf_dir):
    dim = read(spark, sf_dir, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("key"), F.col("n_nationkey").alias("channel"))
    return relational.lookup(read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), ["s_nationkey"], dim, ["key"], "channel", 999).select("s_suppkey", "channel")


@query("""with r as (select o_orderkey as run, o_custkey as ext, epoch_us(o_orderdate) as start, epoch_us(o_orderdate) + 86400000000 * 30 as stop, o_orderstatus as status from orders),
p as (select c_custkey as ext, epoch_us(timestamp '1996-01-01') as t from customer)
select p.ext, max(run) as run from p left join r on p.ext = r.ext and start < t and stop > t group by p.ext""")
def run_registry(spark, sf_dir):
    start = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    runs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_custkey").alias("ext"), start.alias("start"), (start + 86400000000 * 30).alias("stop"))
    at = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ext"), F.unix_micros(F.lit("1996-01-01").cast("timestamp")).alias("t"))
    return relational.run_at(at, runs, ["ext"]).select("ext", "run")


@query("""select o_orderkey from orders where o_orderstatus = 'F' and o_orderkey > 1197 and o_orderpriority <> '1-URGENT' and o_orderdate < timestamp '1997-01-01'""")
def retention(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return relational.expired(o, F.col("o_orderstatus") == "F", F.col("o_orderkey") > 1197, F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate"), F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey")


@query("""with n as (select o_orderkey, count(l_orderkey) as n_lines from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey)
select o_orderkey, n_lines, cast(coalesce(sum(n_lines) over (order by o_orderkey rows between unbounded preceding and 1 preceding), 0) as bigint) as lines_start from n""")
def flatten_child_offsets(spark, sf_dir):
    n = read(spark, sf_dir, "orders").select("o_orderkey").join(read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines")), "o_orderkey", "left").na.fill(0, ["n_lines"])
    return flat.child_offsets(n, "o_orderkey", "n_lines", "lines_start")


@query("""select l_orderkey, count(*) as n, round(sum(l_quantity), 2) as q from lineitem group by l_orderkey""")
def nest_flatten(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    nested = flat.nest(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), li, ["l_orderkey"], ["l_linenumber"], "lines")
    back = flat.flatten(nested, ["l_orderkey"], "lines")
    return back.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("q"))


@query("select event_id, json_extract_string(props, '$.page') as page, json_extract_string(props, '$.k') as k from events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query(r"""select page_id, regexp_extract(url, '^([a-z]+)://([^/:]+)', 1) as scheme, regexp_extract(url, '^([a-z]+)://([^/:]+)', 2) as host, replace(url, '|', '.') as section from pages""")
def text_helpers(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    parts = relational.uri_parts(F.col("url"))
    return p.select("page_id", parts["scheme"].alias("scheme"), parts["host"].alias("host"), relational.escape_section(F.col("url")).alias("section"))


@query("select event_id, user_id from (select *, row_number() over (order by event_id) as n from events) where n % 10 = 0")
def sample_every_nth(spark, sf_dir):
    return relational.every_nth(read(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 10)


@query("select user_id, case when n > 70 then 'blank' else 'kept' end as pulses, n from (select user_id, count(*) as n from events group by user_id)")
def blank_high_energy(spark, sf_dir):
    n = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", F.when(F.col("n") > 70, "blank").otherwise("kept").alias("pulses"), "n")


@query("select user_id, count(*) as n, round(avg(value), 6) as mean, min(value) as lo, max(value) as hi, round(stddev_pop(value), 6) as sigma from events group by user_id")
def truth_aggregates(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.round(F.stddev_pop("value"), 6).alias("sigma"))


@query("select c_custkey, case when abs(us) < 1000 then printf('%.1f us', us) when abs(us) < 1000000 then printf('%.1f ms', us / 1000) else printf('%.1f s', us / 1000000) end as human from (select c_custkey, cast(c_custkey * c_custkey * 7 as double) as us from customer)")
def human_time(spark, sf_dir):
    us = (F.col("c_custkey") * F.col("c_custkey") * 7).cast("double")
    return read(spark, sf_dir, "customer").select("c_custkey", relational.human_time(us * 1000).alias("human"))
