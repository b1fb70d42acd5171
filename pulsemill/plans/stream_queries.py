"""Queries that run a stream to its end: the driver's events as a stream of pulses, by the event builder of pulsemill.streaming."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.islands import SECOND as S
from ..streaming.event_stream import Rules, stream_events
from .catalogue import query
from .trigger_queries import EVENT_GAP, LEFT, RIGHT, S1_RMS, S2_PULSES, SESS, SIGNAL_GAP, STEPS

DAY = 86_400
RULES = Rules(SIGNAL_GAP, EVENT_GAP, LEFT, RIGHT, S1_RMS, S2_PULSES, STEPS, None, width=DAY * S // 4, interval=DAY * S)
#: Pulses that a partition of state gets at least: a partition is a store and two Python workers' tasks a batch, however empty.
STATE_ROWS = 250_000
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _folder(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints, which driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='streams-')}/streams/{uuid.uuid4().hex}"


def stream_all(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The output of one kind of the event builder over all events, read as a stream; a row of another run moves the watermark past the end."""
    folder = _folder(spark)
    time = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    read = lambda df, run: df.select(F.lit(run).cast("long").alias("run"), F.col("ts").cast("timestamp").alias("ts"), time.alias("time"), F.col("user_id").cast("long").alias("pmt"), F.col("value").cast("double").alias("area"))
    last = batch.agg(F.max("ts").alias("ts"))
    closing = read(last.select((F.col("ts").cast("timestamp") + F.expr("interval 3 days")).alias("ts"), F.lit(0).alias("user_id"), F.lit(0.0).alias("value")), -1)
    closing.write.parquet(f"{folder}/closing")
    # The source reads whole folders or patterns; the driver's table may be either a file or a folder.
    stream = read(spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/events*.parquet"), 0)
    stream = stream.unionByName(spark.readStream.schema(closing.schema).parquet(f"{folder}/closing"))
    parts = max(spark.sparkContext.defaultParallelism, batch.count() // STATE_ROWS)
    settings = {"spark.sql.streaming.stateStore.providerClass": STORE, "spark.sql.shuffle.partitions": str(min(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))))}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = stream_events(stream, RULES, kinds=(kind,))
        run = out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{folder}/out")
        run.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(out.schema).parquet(f"{folder}/out").filter("run = 0")


@query(f"""with {SESS} select start, stop, n_triggers, count(*) as n_signals, sum(n_pulses)::bigint as n_pulses, round(sum(area), 3) as area,
max(round(time_rms / 1e9, 6)) as widest_s, count(*) filter (type = 2) as n_wide from rng join cls on left_time >= start and left_time <= stop group by all""")
def stream_event_ranges(spark, sf_dir):
    events = stream_all(spark, sf_dir, "event").select("start", "stop", "n_triggers", F.explode("signals").alias("s"))
    return events.groupBy("start", "stop", "n_triggers").agg(
        F.count("*").alias("n_signals"),
        F.sum("s.n_pulses").alias("n_pulses"),
        F.round(F.sum("s.area"), 3).alias("area"),
        F.max(F.round(F.col("s.time_rms") / 1e9, 6)).alias("widest_s"),
        F.count_if(F.col("s.type") == 2).alias("n_wide"),
    )


@query(f"""with {SESS}, one as (select min(time) as time, min(pmt) as pmt, max(pmt) as other, count(*) as n, count(distinct pmt) as channels from s group by sid),
d as (select unnest(generate_series((select min(time) // {DAY * S} from p), (select max(time) // {DAY * S} from p))) as interval),
c as (select time // {DAY * S} as interval, 'pulses' as name, count(*) as n from p group by 1
 union all select time // {DAY * S}, 'lone', count(*) from one where n = 1 group by 1
 union all select time // {DAY * S}, 'pair', count(*) from one where channels = 2 group by 1
 union all select time // {DAY * S}, 'signals', count(*) from one where n > 1 group by 1
 union all select (start + {LEFT}) // {DAY * S}, 'events', count(*) from rng group by 1)
select d.interval, x.name, coalesce(n, 0) as n from d cross join (values ('pulses'), ('lone'), ('pair'), ('signals'), ('events')) x(name) left join c on c.interval = d.interval and c.name = x.name""")
def stream_intervals(spark, sf_dir):
    return stream_all(spark, sf_dir, "interval").select("interval", "name", "n")


@query(f"""with {SESS}, one as (select min(time) as time, min(pmt) as pmt, max(pmt) as other, count(*) as n, count(distinct pmt) as channels from s group by sid)
select time // {DAY * S} as interval, 'pulses' as name, pmt as a, cast(null as bigint) as b, count(*) as n from p group by all
union all select time // {DAY * S}, 'lone', pmt, null, count(*) from one where n = 1 group by all
union all select time // {DAY * S}, 'pair', pmt, other, count(*) from one where channels = 2 group by all""")
def stream_tallies(spark, sf_dir):
    return stream_all(spark, sf_dir, "tally").select("interval", "name", "a", "b", "n")
