"""Waveforms as arrays: baselines, thresholds, hits, smoothing, records; per-row higher-order functions where the loop is local."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .islands import adjacent_intervals, extended_in_array, runs_in_array


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def pulse_properties(w: Column, n_baseline: int) -> Column:
    """Struct of baseline (mean of the first samples), increase (mean of the last ones over it), noise (rms below it of samples under it), minimum and maximum over it; nulls and no noise for an empty array."""
    n = F.least(F.size(w), F.lit(n_baseline))

    def with_baseline(b: Column) -> Column:
        under = F.filter(w, lambda x: x < b)
        noise = F.when(F.size(under) == 0, F.lit(0.0)).otherwise(F.sqrt(total(F.transform(under, lambda x: (x - b) * (x - b))) / F.size(under)))
        last = F.try_divide(total(F.slice(w, F.size(w) - n + 1, n)), n)
        return F.struct(b.alias("baseline"), (last - b).alias("baseline_increase"), noise.alias("noise_sigma"), (F.array_min(w) - b).alias("minimum"), (F.array_max(w) - b).alias("maximum"))

    return F.transform(F.array(F.try_divide(total(F.slice(w, F.lit(1), n)), n)), with_baseline)[0]


def to_pe(w: Column, reference: float, baseline: Column, factor: Column) -> Column:
    """Baseline-subtracted, inverted and scaled samples."""
    return F.transform(w, lambda x: (F.lit(reference) - x - baseline) * factor)


def adc_to_pe(gain: Column, dt: float, volts: float, bits: int, resistor: float, amplification: float, electron: float = 1.602176634e-19) -> Column:
    """Photoelectrons of one ADC count in one sample; 0 for a gain of 0, and a gain of 2e6 where the channel is unknown."""
    g = F.coalesce(gain, F.lit(2e6))
    return F.when(g == 0, 0.0).otherwise(F.lit(dt * volts / (2**bits * resistor * amplification * electron)) / g)


def samples(df: DataFrame, keys: Sequence[str], w: str, name: str = "value") -> DataFrame:
    """One row for each sample: keys, i (from 0) and its value."""
    return df.select(*keys, F.posexplode(w).alias("i", name))


def hit_threshold(noise: Column, minimum: Column, noise_factor: float, absolute: float, minimum_factor: float) -> Column:
    return F.floor(F.greatest(noise * noise_factor, F.lit(absolute), -minimum * minimum_factor))


def hit_properties(found: DataFrame, sampled: DataFrame, keys: Sequence[str], saturation: float) -> DataFrame:
    """Area, height, first maximum, centre, mean absolute deviation from it and saturated samples of hits(keys, left, right).

    sampled(keys, i, value). The centre is in samples from the pulse's start.
    """
    w = sampled.join(found, list(keys)).filter("i between left and right")
    by = [*keys, "left", "right"]
    out = w.groupBy(*by).agg(
        F.sum("value").alias("area"),
        F.max("value").alias("height"),
        F.max_by("i", F.struct("value", -F.col("i"))).alias("index_of_maximum"),
        (F.sum(F.col("value") * F.col("i")) / F.sum("value")).alias("center"),
        F.sum((F.col("value") > saturation).cast("int")).alias("n_saturated"),
    )
    spread = w.join(out.select(*by, "center", "area"), by).groupBy(*by).agg((F.sum(F.abs(F.col("i") - F.col("center")) * F.col("value")) / F.first("area")).alias("sum_absolute_deviation"))
    return out.join(spread, by)


def hits_in_array(w: Column, bounds: Column, saturation: float) -> Column:
    """Structs with the properties of hit_properties() for each of the bounds of one array."""

    def measured(b: Column) -> Column:
        def with_samples(x: Column) -> Column:
            def with_sums(area: Column, center: Column) -> Column:
                far = total(F.transform(x, lambda v, i: F.abs(i + b["left"] - center) * v))
                return F.struct(
                    b["left"].alias("left"),
                    b["right"].alias("right"),
                    area.alias("area"),
                    F.array_max(x).alias("height"),
                    (b["left"] + F.array_position(x, F.array_max(x)).cast("int") - 1).alias("index_of_maximum"),
                    center.alias("center"),
                    F.size(F.filter(x, lambda v: v > saturation)).cast("long").alias("n_saturated"),
                    (far / area).alias("sum_absolute_deviation"),
                )

            moment = total(F.transform(x, lambda v, i: v * (i + b["left"])))
            sums = F.struct(total(x).alias("area"), moment.alias("moment"))
            return F.transform(F.array(sums), lambda s: F.when(s["area"] > 0, with_sums(s["area"], s["moment"] / s["area"])))[0]

        return F.transform(F.array(F.slice(w, b["left"] + 1, b["right"] - b["left"] + 1)), with_samples)[0]

    return F.filter(F.transform(bounds, measured), lambda h: h.isNotNull())


def find_hits(df: DataFrame, keys: Sequence[str], w: str, threshold: float, left_by: int, right_by: int, saturation: float, longest: int = 350, most: int | None = None, gain: str | None = None) -> DataFrame:
    """Threshold runs of each waveform, extended on both sides, with their properties; only hits of positive area.

    Runs of more than `longest` samples are split. Of a waveform's hits the first `most` are kept. Waveforms of a channel
    whose `gain` is 0 have none. All of it happens inside the waveform's row.
    """
    source = df if gain is None else df.filter(F.col(gain) > 0)
    pieces = lambda r: F.transform(F.sequence(r["left"], r["right"], F.lit(longest)), lambda a: F.struct(a.alias("left"), F.least(a + longest - 1, r["right"]).alias("right")))
    bounded = source.withColumn("_runs", F.flatten(F.transform(runs_in_array(F.col(w), threshold), pieces)))
    bounded = bounded.withColumn("_bounds", extended_in_array(F.col("_runs"), left_by, right_by, F.size(w) - 1))
    kept = hits_in_array(F.col(w), F.col("_bounds"), saturation)
    return bounded.select(*keys, F.explode(kept if most is None else F.slice(kept, 1, most)).alias("h")).select(*keys, "h.*")


def smoothed(w: Column, before: int, after: int) -> Column:
    """moving_average() of one array."""
    from_i = lambda i: F.greatest(i - before, F.lit(0))
    return F.transform(w, lambda x, i: total(F.slice(w, from_i(i) + 1, F.least(i + after, F.size(w) - 1) - from_i(i) + 1)) / (before + after + 1))


def extrema(w: Column) -> Column:
    """array<struct<i, kind>>: local_extrema() of one array."""
    kind = lambda b, a: F.when((b < 0) & (a > 0), "min").when((b > 0) & (a < 0), "max")
    at = F.transform(w, lambda x, i: F.struct(i.alias("i"), kind(x - F.when(i > 0, F.get(w, i - 1)), F.get(w, i + 1) - x).alias("kind")))
    return F.filter(at, lambda e: e["kind"].isNotNull())


def sum_waveform(df: DataFrame, keys: Sequence[str], w: str, factor: Column | float = 1.0) -> DataFrame:
    """Sparse sum over waveforms: keys, i, value."""
    return df.select(*keys, (F.lit(factor) if isinstance(factor, float) else factor).alias("_f"), F.posexplode(w).alias("i", "v")).groupBy(*keys, "i").agg(F.sum(F.col("v") * F.col("_f")).alias("value"))


def concatenate_adjacent(pulses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge pulses(keys, left, right, raw_data) that follow each other without a gap."""
    runs = adjacent_intervals(pulses, keys, "left", "right")
    # A run is one stretch of one channel, as long as the event at most.
    merged = runs.groupBy(*keys, "run").agg(F.min("left").alias("left"), F.max("right").alias("right"), F.array_sort(F.collect_list(F.struct("left", "raw_data"))).alias("p"))
    return merged.select(*keys, "left", "right", F.flatten(F.transform("p", lambda x: x["raw_data"])).alias("raw_data"))


def cut_to_bounds(pulses: DataFrame, length: Column, outside: str = "drop") -> DataFrame:
    """Pulses(left, raw_data) cut to [0, length); those wholly outside are dropped, or fail the query if outside is 'error'."""
    right = F.col("left") + F.size("raw_data") - 1
    out = (F.col("left") >= length) | (right < 0)
    if outside == "error":
        kept = pulses.withColumn("raw_data", F.when(out, F.raise_error(F.lit("pulse outside the event")).cast(pulses.schema["raw_data"].dataType)).otherwise(F.col("raw_data")))
    else:
        kept = pulses.filter(~out)
    lo = F.greatest(F.lit(0), -F.col("left"))
    n = F.least(right, length - 1) - F.greatest(F.col("left"), F.lit(0)) + 1
    return kept.withColumns({"raw_data": F.slice("raw_data", lo.cast("int") + 1, n.cast("int")), "left": F.greatest(F.col("left"), F.lit(0)), "right": F.least(right, length - 1)})


def moving_average(s: DataFrame, keys: Sequence[str], value: str, before: int, after: int) -> DataFrame:
    """Box average over a fixed number of samples; samples beyond the ends count as 0."""
    w = Window.partitionBy(*keys).orderBy("i").rowsBetween(-before, after)
    return s.withColumn("smooth", F.sum(value).over(w) / (before + after + 1))


def local_extrema(s: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Samples where the sign of the first difference changes; kind is 'min' or 'max'."""
    w = Window.partitionBy(*keys).orderBy("i")
    before, after = F.col(value) - F.lag(value).over(w), F.lead(value).over(w) - F.col(value)
    kind = F.when((before < 0) & (after > 0), "min").when((before > 0) & (after < 0), "max")
    return s.withColumn("kind", kind).filter("kind is not null")


def split_records(df: DataFrame, keys: Sequence[str], w: str, size: int) -> DataFrame:
    """Records of `size` samples (the last padded with 0): keys, record_i, length, data, area."""
    n = F.size(w)
    parts = df.select(*keys, F.col(w).alias("_w"), F.explode(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).alias("record_i"))
    own = F.slice("_w", F.col("record_i") * size + 1, F.lit(size))
    out = parts.select(*keys, "record_i", own.alias("d"))
    pad = F.array_repeat(F.lit(0.0), F.lit(size) - F.size("d"))
    return out.select(*keys, "record_i", F.size("d").alias("length"), F.concat(F.transform("d", lambda x: x.cast("double")), pad).alias("data"), total(F.transform("d", lambda x: x.cast("double"))).alias("area"))


def fir(w: Column, response: Sequence[float]) -> Column:
    """Convolution with an impulse response, as long as w, centred on the response's middle."""
    half = len(response) // 2
    terms = lambda i: [F.coalesce(F.when(i + half - k >= 0, F.get(w, i + half - k)), F.lit(0.0)) * r for k, r in enumerate(response)]
    return F.transform(w, lambda x, i: sum(terms(i)[1:], terms(i)[0]))


def band_pass_coefficients(low: float, high: float) -> tuple[float, float, float]:
    """(b, a1, a2) of the first-order Butterworth band-pass between two frequencies (as parts of half the sampling rate): y = b (x - x_2) - a1 y_1 - a2 y_2."""
    if not 0 < low < high < 1:
        raise ValueError("bounds of the band must be between 0 and half the sampling rate, the lower one first")
    lo, hi = np.tan(np.pi * low / 2), np.tan(np.pi * high / 2)
    width, centre = hi - lo, lo * hi
    whole = 1 + width + centre
    return width / whole, 2 * (centre - 1) / whole, (1 - width + centre) / whole


def band_passed(w: np.ndarray, low: float, high: float, pad: int = 9) -> np.ndarray:
    """Rows of w (m, n) filtered forwards and backwards, so without shift in phase. Ends are continued by `pad` samples mirrored in the end point, and the filter starts in the steady state of the first."""
    b, a1, a2 = band_pass_coefficients(low, high)
    n = w.shape[1]
    if n < 2:
        return np.zeros_like(w, dtype=float)
    pad = min(pad, n - 1)
    x = np.concatenate([2 * w[:, :1] - w[:, pad:0:-1], w, 2 * w[:, -1:] - w[:, -2 : -2 - pad : -1]], axis=1).astype(float)
    for _ in range(2):
        z1, z2 = -b * x[:, 0], -b * x[:, 0]  # what a constant input leaves
        y = np.empty_like(x)
        for i in range(x.shape[1]):
            v = b * x[:, i] + z1
            z1, z2 = z2 - a1 * v, -b * x[:, i] - a2 * v
            y[:, i] = v
        x = y[:, ::-1]
    return x[:, pad : pad + n]


def band_pass(df: DataFrame, keys: Sequence[str], w: str, low: float, high: float, name: str = "filtered") -> DataFrame:
    """keys and the filtered array of each waveform; waveforms of one length in an Arrow batch go through the recursion together."""

    @F.pandas_udf("array<double>")
    def run(arrays: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(arrays), index=arrays.index, dtype=object)
        known = arrays[arrays.notna()]
        for _, same in known.groupby(known.map(len)):
            if len(same.iloc[0]):
                out[same.index] = pd.Series(list(band_passed(np.stack(same.to_numpy()).astype(float), low, high)), index=same.index)
            else:
                out[same.index] = pd.Series([np.zeros(0)] * len(same), index=same.index)
        return out

    return df.select(*keys, run(F.col(w)).alias(name))


#: A run of more samples over the threshold than this is split at the minima of its moving average over BOX samples.
LONG_RUN, BOX = 350, 100


def split_long_runs(w: Column, runs: Column, longest: int = LONG_RUN, box: int = BOX) -> Column:
    """Runs (left, right) with those of more than longest + 1 samples cut after each minimum of their moving average; the run's last sample takes no part in the average."""

    def cut(r: Column) -> Column:
        def at_minima(u: Column) -> Column:
            lows = F.filter(F.sequence(F.lit(0), F.size(u) - 1), lambda i: (i > 0) & (i < F.size(u) - 1) & (F.get(u, i) <= F.get(u, i - 1)) & (F.get(u, i + 1) > F.get(u, i)))
            ends = F.transform(lows, lambda i: r["left"] + i)
            starts = F.concat(F.array(r["left"]), F.transform(ends, lambda e: e + 1))
            return F.zip_with(starts, F.concat(ends, F.array(r["right"])), lambda a, b: F.struct(a.cast("int").alias("left"), b.cast("int").alias("right")))

        inside = F.slice(w, r["left"] + 1, r["right"] - r["left"])
        pieces = F.transform(F.array(smoothed(inside, box // 2, box - box // 2 - 1)), at_minima)[0]
        return F.when(r["right"] - r["left"] > longest, pieces).otherwise(F.array(F.struct(r["left"].cast("int").alias("left"), r["right"].cast("int").alias("right"))))

    return F.flatten(F.transform(runs, cut))


def find_pulse_hits(
    pulses: DataFrame,
    keys: Sequence[str],
    raw: str,
    reference: float,
    n_baseline: int,
    noise_factor: float,
    absolute: float,
    minimum_factor: float,
    left_by: int,
    right_by: int,
    factor: Column | float = 1.0,
    alive: Column | None = None,
    most: int = 1000,
    single: tuple[int, int] | None = None,
) -> DataFrame:
    """One row a pulse: keys, baseline, noise_sigma, threshold, n_hits_found and hits, from raw ADC counts to photoelectrons in one row.

    The pulse is turned over (reference - raw) and its baseline (mean of its first samples) taken off; the threshold is the
    largest of noise, absolute counts and minimum; runs over it are split if long, the first `most` are kept, grown on both
    sides and measured (left, right, area, height, index_of_maximum, center, n_saturated, sum_absolute_deviation); hits of no
    positive area go. n_hits_found counts before that, so 0 marks a noise pulse. Areas and heights are times `factor`. A pulse
    for which `alive` is false has no threshold and no hits. single: these bounds are measured instead, whatever their area.
    """
    scale = F.lit(factor) if isinstance(factor, float) else factor
    use = F.lit(True) if alive is None else F.coalesce(alive, F.lit(False))
    none = F.array().cast("array<struct<left: int, right: int>>")

    # Each step is bound by a lambda, so the plan holds it once however often the next one uses it.
    def with_level(w: Column, p: Column) -> Column:
        level = F.when(use, hit_threshold(p["noise_sigma"], p["minimum"], noise_factor, absolute, minimum_factor))
        return _bind(level, lambda t: with_threshold(w, p, t))

    def with_threshold(w: Column, p: Column, t: Column) -> Column:
        if single is not None:
            found = F.array(F.struct(F.lit(single[0]).alias("left"), F.lit(single[1]).alias("right")))
        else:
            found = _bind(runs_in_array(w, t), lambda r: F.slice(split_long_runs(w, r), 1, most))
        return _bind(F.when(use & (F.size(w) > 0), found).otherwise(none), lambda f: with_found(w, p, t, f))

    def with_found(w: Column, p: Column, t: Column, found: Column) -> Column:
        # A sample clipped at 0 counts reads reference - baseline; half a count less, so rounding doesn't hide it.
        ceiling = F.lit(reference) - p["baseline"] - 0.5
        if single is not None:
            hits = F.transform(found, lambda b: _measured_anyway(w, single, ceiling))
        else:
            hits = _bind(extended_in_array(found, left_by, right_by, F.size(w) - 1), lambda bounds: hits_in_array(w, bounds, ceiling))
        scaled = F.transform(hits, lambda h: F.struct(*(((h[c] * scale) if c in ("area", "height") else h[c]).alias(c) for c in HIT_FIELDS)))
        return F.struct(p["baseline"].alias("baseline"), p["noise_sigma"].alias("noise_sigma"), t.alias("threshold"), F.size(found).alias("n_hits_found"), scaled.alias("hits"))

    turned = F.transform(raw, lambda x: F.lit(reference) - x)
    found = _bind(turned, lambda v: _bind(pulse_properties(v, n_baseline), lambda p: _bind(F.transform(v, lambda x: x - p["baseline"]), lambda w: with_level(w, p))))
    return pulses.select(*keys, found.alias("_h")).select(*keys, "_h.*")


HIT_FIELDS = ("left", "right", "area", "height", "index_of_maximum", "center", "n_saturated", "sum_absolute_deviation")


def _bind(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _measured_anyway(w: Column, bounds: tuple[int, int], saturation: Column) -> Column:
    """The properties of one stretch, also if its area is not positive; its centre and deviation are then null."""
    x = F.slice(w, bounds[0] + 1, bounds[1] - bounds[0] + 1)
    area = total(x)
    moment = total(F.transform(x, lambda v, i: v * (i + bounds[0])))
    center = F.when(area > 0, moment / area)
    return F.struct(
        F.lit(bounds[0]).alias("left"),
        F.lit(bounds[1]).alias("right"),
        area.alias("area"),
        F.array_max(x).alias("height"),
        (bounds[0] + F.array_position(x, F.array_max(x)).cast("int") - 1).alias("index_of_maximum"),
        center.alias("center"),
        F.size(F.filter(x, lambda v: v > saturation)).cast("long").alias("n_saturated"),
        (total(F.transform(x, lambda v, i: F.abs(i + bounds[0] - center) * v)) / area).alias("sum_absolute_deviation"),
    )
