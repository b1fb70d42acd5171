"""Queries that write the driver's events by a source of the library and read them back: by range, as a stream, as binary events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.islands import SECOND as S
from ..sources import binary_events, pulse_ranges
from .catalogue import query
from .stream_queries import _folder
from .trigger_queries import P, pulses

WEEK = 7 * 86_400 * S
MARGIN = 86_400 * S


def _written(spark, sf_dir) -> str:
    pulse_ranges.register(spark)
    path = f"{_folder(spark)}/pulses"
    pulse_ranges.write_pulses(pulses(spark, sf_dir).select(F.lit(0).alias("run"), "time", "pmt", "area"), path, WEEK)
    return path


@query(f"with {P}, m as (select min(time) + {WEEK} as lo from p) select pmt, time, area from p, m where time >= lo and time < lo + {WEEK}")
def pulse_range_read(spark, sf_dir):
    lo = (pulses(spark, sf_dir).agg(F.min("time")).first()[0] or 0) + WEEK
    read = spark.read.format("pulse_ranges").option("path", _written(spark, sf_dir)).load()
    return read.filter((F.col("time") >= lo) & (F.col("time") < lo + WEEK)).select("pmt", "time", "area")


@query(f"""with {P}, m as (select (max(time) - {MARGIN}) // {WEEK} * {WEEK} as until from p)
select pmt, count(*) as n, max(time) as last_time, round(sum(area), 3) as area from p, m where time < until group by pmt""")
def pulse_range_stream(spark, sf_dir):
    folder = _folder(spark)
    stream = spark.readStream.format("pulse_ranges").option("path", _written(spark, sf_dir)).option("margin", MARGIN).load()
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/out")
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    read = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    return read.groupBy("pmt").agg(F.count("*").alias("n"), F.max("time").alias("last_time"), F.round(F.sum("area"), 3).alias("area"))


@query("""with n as (select user_id, event_id, row_number() over (partition by user_id order by event_id) as k from events),
s as (select user_id, event_id, 1 + event_id % 40 as channel, 16 * k as "left", unnest(range(8)) as i from n)
select user_id as event_number, channel::int as channel, count(distinct event_id) as n_pulses, min("left")::int as "left", sum((event_id * (i + 1)) % 4001 - 2000)::bigint as total from s group by all""")
def binary_round_trip(spark, sf_dir):
    """An event for each user, a pulse of eight samples for each of its rows; written as binary event files, read and summed up."""
    from pyspark.sql.window import Window

    binary_events.register(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id")
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    data = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: ((F.col("event_id") * i) % 4001 - 2000).cast("short"))
    pulse = F.struct((1 + F.col("event_id") % 40).cast("int").alias("channel"), (16 * k).cast("int").alias("left"), data.alias("data"))
    each = rows.select(F.col("user_id").cast("long").alias("event_number"), pulse.alias("p"))
    events = each.groupBy("event_number").agg(F.array_sort(F.collect_list("p")).alias("pulses"))
    length = (16 * (F.size("pulses") + 2)).cast("int")
    events = events.select(F.lit("users").alias("dataset"), "event_number", (F.col("event_number") * 1000).alias("start_time"), length.alias("length"), "pulses")
    path = f"{_folder(spark)}/events"
    events.repartitionByRange("event_number").sortWithinPartitions("event_number").write.format("binary_events").option("path", path).option("channels", 64).mode("append").save()
    back = spark.read.format("binary_events").option("path", path).load().select("event_number", F.explode("pulses").alias("p")).select("event_number", "p.*")
    total = F.aggregate("data", F.lit(0).cast("long"), lambda s, x: s + x)
    return back.groupBy("event_number", "channel").agg(F.count("*").alias("n_pulses"), F.min("left").alias("left"), F.sum(total).alias("total"))
