"""Event building from a stream of pulses(time long ns, pmt, area): signals, classes, triggers, event ranges and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .islands import beside, bucket_of, bucket_width, gap_sessions, point_in_range

SIGNAL_GAP, EVENT_GAP = 300, 250_000
#: Buckets of triggers hold so many event separations; joins with ranges use buckets of the extended event's usual length.
SEPARATIONS, RANGE = 4096, 4_000_000


def find_signals(pulses: DataFrame, separation: int = SIGNAL_GAP, bucket: int | None = None, tie: str = "pulse_id") -> DataFrame:
    """Signals: runs of two or more pulses, each less than `separation` after the one before.

    Mean and population rms are taken from the signal's own start, so they keep the nanoseconds; time_mean and time_rms are
    in ns relative to left_time. Without a bucket, its width follows from the counted pulses.
    """
    s = gap_sessions(pulses, "time", tie, separation, bucket or bucket_width(pulses, "time"), "signal_id")
    rel = (F.col("time") - F.min("time").over(Window.partitionBy("signal_id"))).cast("double")
    out = s.withColumn("rel", rel).groupBy("signal_id").agg(
        F.min("time").alias("left_time"),
        F.max("time").alias("right_time"),
        F.count("*").alias("n_pulses"),
        F.count_distinct("pmt").alias("n_contributing_channels"),
        F.sum("area").alias("area"),
        F.avg("rel").alias("time_mean"),
        F.stddev_pop("rel").alias("time_rms"),
    )
    return out.filter("n_pulses >= 2").drop("signal_id")


def lone_pulses(pulses: DataFrame, separation: int, tie: str = "pulse_id") -> DataFrame:
    """The pulses that are in no signal."""
    s = gap_sessions(pulses, "time", tie, separation, bucket_width(pulses, "time"), "signal_id")
    alone = s.groupBy("signal_id").agg(F.count("*").alias("n")).filter("n = 1").select("signal_id")
    return s.join(alone, "signal_id", "left_semi").drop("signal_id")


def classify_signals(signals: DataFrame, s1_max_rms: float, s2_min_pulses: int) -> DataFrame:
    """type 2 for wide signals with enough pulses, 0 for other wide ones, 1 for narrow ones."""
    wide = F.col("time_rms") > s1_max_rms
    return signals.withColumn("type", F.when(wide & (F.col("n_pulses") >= s2_min_pulses), 2).when(wide, 0).otherwise(1))


def trigger_probability(steps: dict[int, dict[int, float]], kind: Column, n: Column) -> Column:
    """Step table {type: {least pulses: probability}}; the last step reached holds, and 0 where none is."""
    p = F.lit(0.0)
    for t, table in steps.items():
        own = F.lit(0.0)
        for least in sorted(table):
            own = F.when(n >= least, F.lit(float(table[least]))).otherwise(own)
        p = F.when(kind == t, own).otherwise(p)
    return p


def decide_triggers(signals: DataFrame, steps: dict[int, dict[int, float]]) -> DataFrame:
    """trigger: certain for probabilities 0 and 1, else drawn by a hash of the signal's start, so a rerun decides alike."""
    p = trigger_probability(steps, F.col("type"), F.col("n_pulses"))
    u = F.pmod(F.xxhash64("left_time"), F.lit(1_000_000)) / 1e6
    return signals.withColumn("trigger", (p >= 1) | ((p > 0) & (u < p)))


def event_ranges(triggers: DataFrame, separation: int, left_extension: int, right_extension: int, max_length: int | None = None, bucket: int | None = None) -> DataFrame:
    """start, stop, n_triggers: triggers are one event unless `separation` or more apart; ranges are extended, and cut to max_length.

    Triggers are numbered in buckets of `bucket`, by default some thousand separations, so that a long run is many tasks.
    """
    if separation < left_extension + right_extension:
        raise ValueError("event separation must be at least the sum of the extensions")
    s = gap_sessions(triggers.select(F.col("left_time").alias("time"), F.col("right_time"), F.col("left_time").alias("_tie")), "time", "_tie", separation, bucket or SEPARATIONS * separation, name="event")
    out = s.groupBy("event").agg((F.min("time") - left_extension).alias("start"), (F.max("right_time") + right_extension).alias("stop"), F.count("*").alias("n_triggers"))
    if max_length is not None:
        out = out.withColumn("stop", F.least("stop", F.col("start") + max_length))
    return out.drop("event")


def signals_in_events(signals: DataFrame, ranges: DataFrame, width: int = RANGE) -> DataFrame:
    """Signals whose left_time is in [start, stop], with their event's range. width: some ranges' length, so that a bucket meets few of them."""
    return point_in_range(signals, "left_time", ranges, "start", "stop", width, closed=True)


def fill_events(pulses: DataFrame, ranges: DataFrame, width: int = RANGE) -> DataFrame:
    """Pulses of each event: those that start in [start, stop). width: as for signals_in_events()."""
    return point_in_range(pulses, "time", ranges, "start", "stop", width)


def pulse_rates(pulses: DataFrame, interval: int, pmts: bool = True) -> DataFrame:
    """Counts by interval of time (and pmt), with rows of 0 for intervals without pulses."""
    n = bucket_of("time", interval)
    seen = pulses.groupBy(n.alias("interval"), *(["pmt"] if pmts else [])).agg(F.count("*").alias("n"))
    ends = pulses.agg(F.min(n).alias("lo"), F.max(n).alias("hi")).filter("lo is not null")
    every = ends.select(F.explode(F.sequence("lo", "hi")).alias("interval"))
    if not pmts:
        return every.join(seen, "interval", "left").select("interval", F.coalesce("n", F.lit(0)).alias("n"))
    channels = pulses.groupBy("pmt").agg(F.count("*").alias("_")).select("pmt")
    full = every.crossJoin(channels)  # the size of the report itself: a row for each interval and channel
    return full.join(seen, ["interval", "pmt"], "left").select("interval", "pmt", F.coalesce("n", F.lit(0)).alias("n"))


def pair_coincidences(pulses: DataFrame, separation: int, tie: str = "pulse_id") -> DataFrame:
    """Upper triangle of the counts of signals seen by exactly two channels."""
    s = gap_sessions(pulses, "time", tie, separation, bucket_width(pulses, "time"), "signal_id")
    two = s.groupBy("signal_id").agg(F.min("pmt").alias("a"), F.max("pmt").alias("b"), F.count_distinct("pmt").alias("n"))
    return two.filter("n = 2").groupBy("a", "b").agg(F.count("*").alias("n_coincidences"))


def dead_time(marks: DataFrame, interval: int, keys: tuple[str, ...] = ("system",), width: int | None = None) -> DataFrame:
    """Dead time per interval of time from marks(keys, time, on). Repeated marks change nothing; an open one at the end is not counted.

    Marks meet the ones before and after them in buckets of `width`, by default a thousand intervals.
    """
    width = width or 1000 * interval
    turns = beside(marks, keys, ["time", "on"], "on", "time", width, "_was").filter("(_was is null and on) or _was <> on")
    spans = beside(turns, keys, ["time", "on"], "time", "time", width, "stop", after=True).filter("on and stop is not null").withColumnRenamed("time", "start")
    cells = spans.withColumn("interval", F.explode(F.sequence(bucket_of("start", interval), bucket_of("stop", interval))))
    part = F.least(F.col("stop"), (F.col("interval") + 1) * interval) - F.greatest(F.col("start"), F.col("interval") * interval)
    return cells.groupBy(*keys, "interval").agg(F.sum(part).alias("dead_ns"))


def histogram_2d(signals: DataFrame, x: Column, x_edges: list[float], y: Column, y_edges: list[float]) -> DataFrame:
    """Counts by bins of clipped values; the last bin is closed on both sides."""

    def bin_of(value: Column, edges: list[float]) -> Column:
        n = F.lit(0)
        for i, edge in enumerate(edges[1:-1], 1):
            n = F.when(value >= edge, i).otherwise(n)
        return n

    return signals.groupBy(bin_of(x, x_edges).alias("x_bin"), bin_of(y, y_edges).alias("y_bin")).agg(F.count("*").alias("n"))


def fixed_segments(pulses: DataFrame, length: int) -> DataFrame:
    """Consecutive ranges of `length` over the pulses' time, with their counts."""
    return pulse_rates(pulses, length, pmts=False).select((F.col("interval") * length).alias("start"), ((F.col("interval") + 1) * length).alias("stop"), F.col("n").alias("n_pulses"))


def any_pulse_triggers(signals: DataFrame, pulses: DataFrame, code: int) -> DataFrame:
    """signals with each of the pulses as a triggering signal of its own."""
    each = pulses.select(F.col("time").alias("left_time"), F.col("time").alias("right_time"), F.lit(1).cast("long").alias("n_pulses"), F.col("area"), F.lit(code).alias("type"), F.lit(True).alias("trigger"))
    return signals.select("left_time", "right_time", "n_pulses", "area", "type", "trigger").unionByName(each)


def last_break(pulses: DataFrame, gap: int, until: int | None = None) -> DataFrame:
    """Time of the last pulse after which nothing comes for more than `gap` (until `until`, which counts as a pulse)."""
    source = pulses.select("time") if until is None else pulses.select("time").union(pulses.sparkSession.range(1).select(F.lit(until).alias("time")))
    numbered = gap_sessions(source.withColumn("_tie", F.col("time")), "time", "_tie", gap + 1, bucket_width(source, "time"), "s")
    ends = numbered.groupBy("s").agg(F.max("time").alias("last_time"))
    return ends.orderBy(F.desc("s")).limit(2).agg(F.min("last_time").alias("break_after"), F.max("last_time").alias("last_time"))
