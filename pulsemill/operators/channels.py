"""Channels and selections: detector maps, counts per channel, vetoes, free regions, preferred entries, crossings and corrections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .islands import carried


def detector_by_channel(detectors: DataFrame, detector: str = "detector", channels: str = "channels") -> DataFrame:
    """channel, detector: the inverted lists of detectors(detector, channels array)."""
    return detectors.select(F.explode(channels).alias("channel"), F.col(detector).alias("detector"))


def peaks_by_type(peaks: DataFrame, event: Sequence[str], kind: str, detector: str, by: Column, tie: str, largest_first: bool = True) -> DataFrame:
    """Peaks of a type (lower case) and detector, 'all' for any, with their rank inside the event by `by`, then `tie`."""
    some = peaks if kind == "all" else peaks.filter(F.lower("type") == kind)
    some = some if detector == "all" else some.filter(F.col("detector") == detector)
    order = by.desc() if largest_first else by.asc()
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*event).orderBy(order, F.col(tie))))


def hashed_share(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, so reruns decide alike."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def prescale(events: DataFrame, count: Column, most: int, key: Column, probability: float) -> DataFrame:
    """events with kept: false for those of more than `most` pulses, but for a share `probability` of them."""
    return events.withColumn("kept", (count <= most) | (hashed_share(key) < probability))


def channel_counts(pulses: DataFrame, keys: Sequence[str], n_hits: Column, gain: Column) -> DataFrame:
    """Pulses of each channel, and those without a hit where the channel is alive (gain over 0)."""
    noise = F.sum(((n_hits == 0) & (gain > 0)).cast("long"))
    return pulses.groupBy(*keys).agg(F.count("*").alias("n_pulses"), F.coalesce(noise, F.lit(0)).alias("n_noise_pulses"))


def lone_hits(peaks: DataFrame, keys: Sequence[str], left: Column, limit: int) -> DataFrame:
    """Lone-hit peaks of each channel: all, and those that start before a limit. peaks: those of one hit."""
    return peaks.groupBy(*keys).agg(F.count("*").alias("n_lone"), F.sum((left < limit).cast("long")).alias("n_lone_before"))


def run_totals(ranges: DataFrame, keys: Sequence[str], max_length: int) -> DataFrame:
    """Events, total live time and truncated events of each run, from ranges(keys, start, stop)."""
    length = F.col("stop") - F.col("start")
    return ranges.groupBy(*keys).agg(F.count("*").alias("n_events"), F.sum(F.least(length, F.lit(max_length))).alias("total_time"), F.sum((length > max_length).cast("long")).alias("n_truncated"))


def largest_per_section(peaks: DataFrame, event: Sequence[str], time: str, height: str, tie: str, sections: int) -> DataFrame:
    """The highest peak in each of `sections` equal parts of its event's time; of equal ones the first by `tie`."""
    w = Window.partitionBy(*event)
    first, length = F.min(time).over(w), F.max(time).over(w) - F.min(time).over(w) + 1
    part = peaks.withColumn("section", F.floor((F.col(time) - first) * sections / length))
    return part.groupBy(*event, "section").agg(F.max_by(tie, F.struct(F.col(height), -F.col(tie))).alias(tie), F.max(height).alias(height))


def free_regions(intervals: DataFrame, keys: Sequence[str], first: int, last: Column, among: DataFrame | None = None) -> DataFrame:
    """keys, left, right of the stretches of [first, last] that no interval(left, right) covers. Intervals may overlap, hold each other and lie beyond the bounds.

    among(keys): keys that are free as a whole if they have no interval; without it only keys with an interval are seen.
    """
    w = Window.partitionBy(*keys).orderBy("left", "right")
    reached = F.max("right").over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = intervals.select(*keys, (reached + 1).alias("left"), F.coalesce(F.lead("left").over(w) - 1, last).alias("right"))
    before = intervals.groupBy(*keys).agg(F.min("left").alias("_l")).select(*keys, F.lit(first).alias("left"), (F.col("_l") - 1).alias("right"))
    out = after.unionByName(before)
    if among is not None:
        whole = among.select(*keys).distinct().join(intervals.select(*keys).distinct(), list(keys), "left_anti")
        out = out.unionByName(whole.select(*keys, F.lit(first).alias("left"), last.alias("right")))
    return out.select(*keys, F.greatest("left", F.lit(first)).alias("left"), F.least(F.col("right"), last).alias("right")).filter("left <= right")


def interaction_peaks(found: DataFrame, peaks: DataFrame, event: Sequence[str], peak: str, columns: Sequence[str]) -> DataFrame:
    """found(event, s1, s2) with both peaks' columns, as s1_* and s2_*."""
    out = found
    for side in ("s1", "s2"):
        own = peaks.select(*event, F.col(peak).alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        out = out.join(own, [*event, side])
    return out


def best_seed(positions: DataFrame, keys: Sequence[str], gof: str, order: str, columns: Sequence[str]) -> DataFrame:
    """The position with the smallest goodness of fit that is a number, the first by `order` of equal ones."""
    good = positions.filter(F.col(gof).isNotNull() & ~F.isnan(gof))
    best = good.groupBy(*keys).agg(F.min_by(F.struct(gof, order, *columns), F.struct(gof, order)).alias("b"))
    return best.select(*keys, "b.*")


def last_known(pulses: DataFrame, channel: Sequence[str], order: Sequence[str], value: str, name: str, width: int | None = None) -> DataFrame:
    """pulses with the channel's last value that is not null, up to and with the row's own. width: of buckets of the first order column, a whole number, for long runs."""
    if width is not None:
        return carried(pulses, channel, order, value, order[0], width, name)
    w = Window.partitionBy(*channel).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return pulses.withColumn(name, F.last(value, ignorenulls=True).over(w))


def next_crossing(w: Column, start: int, threshold: float, min_length: int, stop: Column) -> Column:
    """First sample after `start` on the other side of the threshold (strictly) that stays there for min_length samples before `stop`; else stop."""
    x = F.get(w, F.lit(start))
    beyond = lambda v: ((x < threshold) & (v > threshold)) | ((x > threshold) & (v < threshold))
    stays = lambda i: F.forall(F.slice(w, i + 1, F.lit(min_length)), beyond)
    found = F.filter(F.sequence(F.lit(start + 1), stop - min_length), lambda i: stays(i))
    return F.when(stop - start - 1 < min_length, stop).otherwise(F.coalesce(F.get(found, F.lit(0)), stop))


def previous_crossing(w: Column, start: int, threshold: float, min_length: int, stop: Column) -> Column:
    """next_crossing() to the left: the first sample before `start` on the other side that stays there for min_length samples after `stop`; else stop."""
    return start - next_crossing(F.reverse(F.slice(w, 1, start + 1)), 0, threshold, min_length, start - stop)


def shrunk(w: Column, n: int) -> Column:
    """An array without n samples on each side; empty if it is no longer than that."""
    return F.slice(w, F.lit(n + 1), F.greatest(F.size(w) - 2 * n, F.lit(0)))


def grid_index(x: Column, first: float, step: float, n: int) -> Column:
    """Nearest of n grid points; null beyond half a cell outside the grid."""
    at = (x - first) / step
    return F.when((at >= -0.5) & (at <= n - 0.5), F.least(F.greatest(F.floor(at + 0.5), F.lit(0)), F.lit(n - 1)).cast("int"))


def saturation_correction(areas: Column, pattern: Column, confused: Column) -> Column:
    """Total area with the confused channels' (an array of booleans) replaced by what the pattern expects from the others; as it is if none is left."""
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    good = lambda a: add(F.zip_with(a, confused, lambda x, c: F.when(c, 0.0).otherwise(x)))
    seen, expected = good(areas), good(pattern)
    return F.when(expected > 0, seen + (add(pattern) - expected) * seen / expected).otherwise(add(areas))


def hash_id(*columns: Column) -> Column:
    return F.md5(F.concat_ws("|", *columns))
