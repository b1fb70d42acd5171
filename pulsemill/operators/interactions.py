"""Pairs of light and charge peaks, and their corrected properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pair_interactions(s1: DataFrame, s2: DataFrame, event: Sequence[str], max_s1: int, max_s2: int, min_s2_area: float) -> DataFrame:
    """event, s1, s2, drift_time, interaction_id for peaks(event, peak_id, t, area, tight_coincidence).

    The largest s1 (by tight coincidence, then area) and s2 (by area) of each event are ranked first, so the join on the
    event pairs a bounded number. Numbered with the s2 outside and the s1 inside.
    """
    k1 = F.row_number().over(Window.partitionBy(*event).orderBy(F.desc("tight_coincidence"), F.desc("area"), "peak_id"))
    k2 = F.row_number().over(Window.partitionBy(*event).orderBy(F.desc("area"), "peak_id"))
    a = s1.withColumn("k1", k1).filter(F.col("k1") <= max_s1).select(*event, F.col("peak_id").alias("s1"), F.col("t").alias("t1"), "k1")
    b = s2.withColumn("k2", k2).filter((F.col("k2") <= max_s2) & (F.col("area") >= min_s2_area)).select(*event, F.col("peak_id").alias("s2"), F.col("t").alias("t2"), "k2")
    pairs = a.join(b, list(event)).filter("t2 >= t1")
    return pairs.select(*event, "s1", "s2", (F.col("t2") - F.col("t1")).alias("drift_time"), F.row_number().over(Window.partitionBy(*event).orderBy("k2", "k1")).alias("interaction_id"))


def drift_depth(drift_time: Column, velocity: float, gate_time: float) -> Column:
    return -F.lit(velocity) * (drift_time - gate_time)


def lifetime_correction(drift_time: Column, lifetime: float) -> Column:
    return F.exp(drift_time / lifetime)


def field_correction(df: DataFrame, dr: Column, dz: Column) -> DataFrame:
    """Corrected x, y, z. The angle is computed once, before x is replaced."""
    r, phi = F.hypot("x", "y") + dr, F.atan2("y", "x")
    moved = df.withColumns({"_r": r, "_phi": phi, "_z": F.col("z") + dz})
    return moved.withColumns({"x": F.col("_r") * F.cos("_phi"), "y": F.col("_r") * F.sin("_phi"), "z": F.col("_z")}).drop("_r", "_phi", "_z")


def discriminator(cs1: Column, cs2: Column) -> Column:
    return F.log10(cs2 / cs1)


def preferred_position(positions: DataFrame, keys: Sequence[str], algorithms: Sequence[str]) -> DataFrame:
    """Position of each peak by the first algorithm of the list that gave a number; positions(keys, algorithm, x, y)."""
    rank = F.array_position(F.array(*map(F.lit, algorithms)), F.col("algorithm"))
    good = positions.filter(F.col("x").isNotNull() & ~F.isnan("x")).withColumn("rank", rank).filter("rank > 0")
    best = good.groupBy(*keys).agg(F.min_by(F.struct("algorithm", "x", "y"), "rank").alias("p"))
    return best.select(*keys, "p.algorithm", "p.x", "p.y")


def main_peaks(peaks: DataFrame, interactions: DataFrame, event: Sequence[str], kind: str) -> DataFrame:
    """Each event's main peak of a kind: the one of its first interaction, else the largest."""
    first = interactions.filter("interaction_id = 1").select(*event, F.col(kind).alias("_main"))
    largest = peaks.filter(F.lower("type") == kind).groupBy(*event).agg(F.max_by("peak_id", F.struct("area", -F.col("peak_id"))).alias("_largest"))
    return largest.join(first, list(event), "left").select(*event, F.coalesce("_main", "_largest").alias(f"main_{kind}"))


def corrected_interactions(interactions: DataFrame, s1: DataFrame, s2: DataFrame, event: Sequence[str], velocity: float, gate_time: float, lifetime: float, light: DataFrame | None = None, charge: DataFrame | None = None, patterns=None, statistic: str = "likelihood_poisson", saturation: bool = False) -> DataFrame:
    """interactions(event, s1, s2, drift_time, x, y) with z, the corrections of both areas and their products, and the s1's pattern fits.

    s1(event, peak_id, area, areas, hits, confused) and s2(event, peak_id, area, saturation_correction): arrays over the map's
    channels; confused marks saturated and dead ones. light(x, y, z, light_yield) and charge(x, y, light_yield) are maps of
    relative yields, interpolated; patterns is a PatternMap over x, y, z. A correction that has no map is 1; with a null place
    the spatial ones are null. Outside the pattern map the saturation correction is 1 and the fits are null.
    """
    from .channels import saturation_correction
    from .pattern_fit import expected_patterns, goodness_at
    from .positions import interpolate

    first = s1.select(*event, F.col("peak_id").alias("s1"), F.col("area").alias("s1_area"), "areas", "hits", "confused")
    second = s2.select(*event, F.col("peak_id").alias("s2"), F.col("area").alias("s2_area"), F.coalesce("saturation_correction", F.lit(1.0)).alias("s2_saturation_correction"))
    keys = [*event, "s1", "s2"]
    out = interactions.join(first, [*event, "s1"]).join(second, [*event, "s2"])
    out = out.withColumns({"z": drift_depth(F.col("drift_time"), velocity, gate_time), "s2_lifetime_correction": lifetime_correction(F.col("drift_time"), lifetime)})
    for name, table, dims in (("s1_spatial_correction", light, ["x", "y", "z"]), ("s2_spatial_correction", charge, ["x", "y"])):
        if table is None:
            out = out.withColumn(name, F.lit(1.0))
        else:
            found = interpolate(out.select(*keys, *dims), keys, dims, table, "light_yield").select(*keys, (1 / F.col("light_yield")).alias(name))
            out = out.join(found, keys, "left")
    if patterns is None:
        out = out.withColumns({"s1_saturation_correction": F.lit(1.0), "s1_pattern_fit": F.lit(None).cast("double"), "s1_pattern_fit_hits": F.lit(None).cast("double")})
    else:
        out = expected_patterns(out, patterns, ["x", "y", "z"], "_expected")
        whole = F.aggregate("areas", F.lit(0.0), lambda s, v: s + v)
        out = out.withColumn("s1_saturation_correction", F.when(F.col("_expected").isNull() | (whole <= 0), 1.0).otherwise(saturation_correction(F.col("areas"), F.col("_expected"), F.col("confused")) / whole))
        out = out.withColumn("_use", F.transform("confused", lambda c: ~c))
        out = goodness_at(out, "areas", patterns, ["x", "y", "z"], statistic, "s1_pattern_fit", use="_use")
        out = goodness_at(out, "hits", patterns, ["x", "y", "z"], statistic, "s1_pattern_fit_hits", use="_use").drop("_expected", "_use")
    light_part = F.col("s1_spatial_correction") * (F.col("s1_saturation_correction") if saturation else F.lit(1.0))
    charge_part = F.col("s2_lifetime_correction") * F.col("s2_spatial_correction") * (F.col("s2_saturation_correction") if saturation else F.lit(1.0))
    out = out.withColumns({"s1_area_correction": light_part, "s2_area_correction": charge_part})
    return out.withColumns({"cs1": F.col("s1_area") * F.col("s1_area_correction"), "cs2": F.col("s2_area") * F.col("s2_area_correction")}).drop("areas", "hits", "confused")
