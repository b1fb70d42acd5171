"""Peaks from hits(keys, index_of_maximum, channel, left, right, area, ...): clustering, properties, classification, rejection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .islands import gap_sessions, keyed_islands


def cluster_hits(hits: DataFrame, keys: Sequence[str], threshold: int, tie: str = "hit_id", name: str = "cluster", width: int | None = None) -> DataFrame:
    """hits with a cluster number; a cluster ends where more than `threshold` free samples follow the largest maximum so far.

    Free samples between maxima at i and j are j - i - 1. As rows are ordered, the largest maximum so far is the row before.
    A key's hits, an event's, are one window; where a key holds a whole run, give the width of buckets to number them in.
    """
    if width is not None:
        return gap_sessions(hits, "index_of_maximum", tie, threshold + 2, width, name, keys)
    w = Window.partitionBy(*keys).orderBy("index_of_maximum", tie)
    gap = F.col("index_of_maximum") - F.lag("index_of_maximum").over(w) - 1
    return keyed_islands(hits, keys, ["index_of_maximum", tie], gap > threshold, name)


def two_pass_clusters(hits: DataFrame, keys: Sequence[str], small_gap: int, large_gap: int, keep: Column, tie: str = "hit_id", width: int | None = None) -> DataFrame:
    """Clusters by the small gap that satisfy `keep` (over n_channels, n_hits, span) are final (pass 1); the hits left are clustered again by the large gap (pass 2)."""
    first = cluster_hits(hits, keys, small_gap, tie, width=width)
    stats = first.groupBy(*keys, "cluster").agg(F.count_distinct("channel").alias("n_channels"), F.count("*").alias("n_hits"), (F.max("index_of_maximum") - F.min("index_of_maximum")).alias("span"))
    marked = first.join(stats.select(*keys, "cluster", keep.alias("_kept")), [*keys, "cluster"])
    done = marked.filter("_kept").drop("_kept").withColumn("pass", F.lit(1))
    rest = cluster_hits(marked.filter("not _kept").drop("_kept", "cluster"), keys, large_gap, tie, width=width).withColumn("pass", F.lit(2))
    return done.unionByName(rest)


def peak_basics(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """area, n_hits, n_channels, left (of the first hit by maximum, not the smallest), right, and lone for peaks of one channel."""
    out = hits.groupBy(*keys).agg(
        F.sum("area").alias("area"),
        F.count("*").alias("n_hits"),
        F.count_distinct("channel").alias("n_channels"),
        F.min_by("left", F.struct("index_of_maximum", "left")).alias("left"),
        F.max("right").alias("right"),
    )
    return out.withColumn("lone", F.col("n_channels") == 1)


def peak_properties(hits: DataFrame, keys: Sequence[str], top: Column) -> DataFrame:
    """Area-weighted mean and standard deviation of the hits' centres, mean height, share of area in the top array, largest hit."""
    total = F.sum("area")
    # Centres are taken from the peak's first one, so large times keep their digits.
    rel = hits.withColumn("_t", (F.col("center") - F.min("center").over(Window.partitionBy(*keys))).cast("double"))
    out = rel.groupBy(*keys).agg(
        (F.sum(F.col("height") * F.col("area")) / total).alias("mean_amplitude"),
        (F.sum(F.when(top, F.col("area")).otherwise(0.0)) / total).alias("area_fraction_top"),
        (F.sum(F.when(top, 1.0).otherwise(0.0)) / F.count("*")).alias("hits_fraction_top"),
        (F.sum(F.col("_t") * F.col("area")) / total).alias("hit_time_mean"),
        (F.sum(F.col("_t") * F.col("_t") * F.col("area")) / total).alias("_m2"),
        F.max_by("channel", F.struct("area", -F.col("channel"))).alias("largest_hit_channel"),
        F.max("area").alias("largest_hit_area"),
    )
    return out.withColumn("hit_time_std", F.sqrt(F.greatest(F.col("_m2") - F.col("hit_time_mean") * F.col("hit_time_mean"), F.lit(0.0)))).drop("_m2")


def per_channel(hits: DataFrame, keys: Sequence[str], n_channels: int, value: Column) -> DataFrame:
    """keys and a dense array of `value` sums by channel, 0 where a channel has none."""
    sums = hits.groupBy(*keys, "channel").agg(F.sum(value).alias("v"))
    # At most n_channels entries for each key.
    m = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("channel", "v"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(n_channels - 1)), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(0.0)))
    return m.select(*keys, dense.alias("per_channel"))


def tight_coincidence(hits: DataFrame, peak_time: str, keys: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """Distinct channels with a maximum within each window of the peak's own maximum."""
    near = lambda w: F.count_distinct(F.when(F.abs(F.col("index_of_maximum") - F.col(peak_time)) <= w, F.col("channel"))).alias(f"tight_{w}")
    return hits.groupBy(*keys).agg(*(near(w) for w in windows))


def fraction_crossings(w: Column, fractions: Sequence[float]) -> Column:
    """Positions in samples where the running sum of w reaches each fraction of its total, with the part of the sample it takes.

    A fraction of 1 is reached at the end of the last sample that adds to the sum.
    """

    def one(f: float, total: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(None).cast("double").alias("at"))

        def step(acc: Column, x: Column) -> Column:
            new = acc["sum"] + x
            goal = total * f
            here = acc["i"] + F.when(x == 0, 0.0).otherwise((goal - acc["sum"]) / x)
            return F.struct(new.alias("sum"), (acc["i"] + 1).alias("i"), F.when(acc["at"].isNull() & (new >= goal - F.abs(total) * 1e-12), here).otherwise(acc["at"]).alias("at"))

        return F.aggregate(w, zero, step, lambda a: F.coalesce(a["at"], a["i"].cast("double")))

    # The total is bound once, not summed again at every step.
    return F.transform(F.array(F.aggregate(w, F.lit(0.0), lambda a, x: a + x)), lambda t: F.array(*(one(f, t) for f in fractions)))[0]


DECILES = [i / 10 for i in range(11)]


def widths(deciles: Column) -> tuple[Column, Column]:
    """(range of the central k * 10 % of the area, time of each decile from the median) for k = 0..5 and deciles 0..10."""
    at = lambda i: F.element_at(deciles, i + 1)
    return F.array(*(at(5 + k) - at(5 - k) for k in range(6))), F.array(*(at(i) - at(5) for i in range(11)))


def centred(w: Column, field: int, center: Column) -> Column:
    """w laid into `field` samples so that its sample `center` is at field // 2; what hangs over is cut off, the rest is 0."""
    shift = F.lit(field // 2) - center
    return F.transform(F.sequence(F.lit(0), F.lit(field - 1)), lambda i: F.coalesce(F.when(i - shift >= 0, F.get(w, i - shift)), F.lit(0.0)))


def classify_by_shape(peaks: DataFrame) -> DataFrame:
    """Second detector's classes from rise_time, width (central 50 %), tight_coincidence, n_channels and area_fraction_top (kept in [0, 1])."""
    aft = F.least(F.greatest("area_fraction_top", F.lit(0.0)), F.lit(1.0))
    fast = F.col("rise_time") <= F.when(F.col("width") < 100, 70.0).otherwise(50.0)
    s1 = fast & (F.col("tight_coincidence") >= 3) & (aft <= 0.7)
    s2 = (F.col("n_channels") >= 4) & (F.col("rise_time") > 80)
    kind = F.when(F.col("type").isin("lone_hit", "noise"), F.col("type")).when(s1, "s1").when(s2, "s2").otherwise("unknown")
    return peaks.withColumn("type", kind)


def classify_by_width(peaks: DataFrame) -> DataFrame:
    """First detector's classes: by area and width; where no rule holds the old type stays."""
    a, w = F.col("area"), F.col("width")
    kind = F.when((a > 50) & (w < 100), "s1").when((a > 50) & (w > 250), "s2").when((a <= 50) & (w < 75), "s1").when(a <= 50, "s2").otherwise(F.col("type"))
    return peaks.withColumn("type", F.when(F.col("type").isin("lone_hit", "noise"), F.col("type")).otherwise(kind))


def reject_noise(hits: DataFrame, keys: Sequence[str], channels: DataFrame, noise_weight: float, lone_weight: float, threshold: float) -> DataFrame:
    """hits with is_rejected: in a suspicious channel (penalty at the threshold), if the channel's penalty exceeds the area that other channels saw in the peak.

    channels(event, channel, n_noise, n_lone, base): one row for each channel of an event.
    """
    penalty = F.col("n_noise") * noise_weight + F.col("n_lone") * lone_weight + F.col("base")
    bad = channels.select(*[c for c in channels.columns if c in keys], "channel", penalty.alias("penalty")).filter(F.col("penalty") >= threshold)
    on = [c for c in bad.columns if c != "penalty"]
    marked = hits.join(bad, on, "left")  # a row for each event and channel: Spark broadcasts it if it is small
    witness = F.sum(F.when(F.col("penalty").isNull(), F.col("area")).otherwise(0.0)).over(Window.partitionBy(*keys))
    return marked.withColumn("is_rejected", F.coalesce(F.col("penalty") > witness, F.lit(False)))


def channel_penalties(lone: DataFrame, noise: DataFrame, base: dict[int, float], event: Sequence[str], noise_weight: float, lone_weight: float, before: int) -> DataFrame:
    """event, channel, penalty of channels with any: noise pulses, lone hits that start before a sample, and the detector's own base.

    lone(event, channel, left): the hits that are peaks of their own; noise(event, channel): pulses without a hit; base: penalties of the detector's bad channels, which
    count in every event that has a lone hit or a noise pulse.
    """
    n = lambda df, weight: df.groupBy(*event, "channel").agg((F.count("*") * F.lit(float(weight))).alias("penalty"))
    seen = n(lone.filter(F.col("left") < before), lone_weight).unionByName(n(noise, noise_weight))
    if base:
        events = lone.select(*event).union(noise.select(*event)).distinct()
        own = F.explode(F.array(*(F.struct(F.lit(c).alias("channel"), F.lit(float(v)).alias("penalty")) for c, v in sorted(base.items())))).alias("_b")
        seen = seen.unionByName(events.select(*event, own).select(*event, F.col("_b.channel").cast(lone.schema["channel"].dataType).alias("channel"), "_b.penalty"))
    return seen.groupBy(*event, "channel").agg(F.sum("penalty").alias("penalty"))


def reject_and_rebuild(hits: DataFrame, penalties: DataFrame, event: Sequence[str], peak: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits with is_rejected, peaks made of the others, counts) of hits(event, peak, channel, area, left, right, index_of_maximum).

    A channel is suspicious if its penalty reaches the threshold. A peak's hits in a suspicious channel are rejected if the
    penalty exceeds the peak's area in channels that are not. What is left is put together again by peak_basics(), with
    suspicious_channels, those the peak had; a peak that lost all its hits is gone. counts(event, channel, n_rejected, n_lone):
    rejected hits, and hits that are now peaks of one channel.
    """
    keys = [*event, peak]
    bad = penalties.filter(F.col("penalty") >= threshold)
    marked = hits.join(bad, [*event, "channel"], "left")
    sums = marked.groupBy(*keys).agg(F.sum(F.when(F.col("penalty").isNull(), F.col("area")).otherwise(0.0)).alias("_witness"), F.array_sort(F.collect_set(F.when(F.col("penalty").isNotNull(), F.col("channel")))).alias("suspicious_channels"))
    judged = marked.join(sums, keys).withColumn("is_rejected", F.coalesce(F.col("penalty") > F.col("_witness"), F.lit(False)))
    kept = judged.filter("not is_rejected")
    peaks = peak_basics(kept, keys).join(sums.drop("_witness"), keys)
    lone = kept.join(peaks.filter("lone").select(*keys), keys, "left_semi").dropDuplicates(keys)
    count = lambda df, name: df.groupBy(*event, "channel").agg(F.count("*").alias(name))
    counts = count(judged.filter("is_rejected"), "n_rejected").join(count(lone, "n_lone"), [*event, "channel"], "full")
    counts = counts.select(*event, "channel", F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"), F.coalesce("n_lone", F.lit(0)).alias("n_lone"))
    return judged.select(*hits.columns, "is_rejected"), peaks, counts


def top_peaks(peaks: DataFrame, event: Sequence[str], by: Column, k: int, tie: str) -> DataFrame:
    """The k largest peaks of each event, with their rank; ties by `tie`."""
    return peaks.withColumn("rank", F.row_number().over(Window.partitionBy(*event).orderBy(by.desc(), F.col(tie)))).filter(F.col("rank") <= k)


def shrink_events(peaks: DataFrame, event: Sequence[str], n_peaks: int, heavy: Sequence[str]) -> DataFrame:
    """Empty the heavy array columns of large events' peaks, but for the five largest s1 and all s2."""
    size = F.count("*").over(Window.partitionBy(*event))
    rank = F.row_number().over(Window.partitionBy(*event, "type").orderBy(F.desc("area"), "peak_id"))
    light = (size > n_peaks) & ~((F.col("type") == "s2") | ((F.col("type") == "s1") & (F.col("_rank") <= 5)))
    out = peaks.withColumn("_rank", rank).withColumn("_light", light)
    return out.withColumns({c: F.when(F.col("_light"), F.array().cast(peaks.schema[c].dataType)).otherwise(F.col(c)) for c in heavy}).drop("_rank", "_light")
