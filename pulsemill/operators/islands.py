"""Ordered-run operators: gap sessions, adjacent intervals, threshold runs and interval joins, all as joins and windows.

All times are long nanoseconds; all interval bounds are inclusive unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SECOND = 1_000_000_000
DAY = 86_400 * SECOND


def bucket_of(time: Column | str, width: int) -> Column:
    """Number of the bucket of `width` that holds a long time, by whole numbers: doubles would round the nanoseconds of our century."""
    t = F.col(time) if isinstance(time, str) else time
    return F.call_function("div", t - F.pmod(t, F.lit(width)), F.lit(width))


def keyed_islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str = "island") -> DataFrame:
    """df with a running number per key that grows by one at each row where `starts` (which may use lag over the order) is true or null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_new", F.coalesce(starts, F.lit(True)).cast("int")).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def lagged(column: str, keys: Sequence[str], order: Sequence[str], n: int = 1) -> Column:
    return F.lag(column, n).over(Window.partitionBy(*keys).orderBy(*order))


#: Rows that a bucket of time holds on average, and buckets at most (the table of bucket edges is numbered in one task).
BUCKET_ROWS, MOST_BUCKETS = 20_000, 100_000


def bucket_width(df: DataFrame, time: str) -> int:
    """Width of time buckets by the counted rows and the time they span, so that the number of tasks grows with the rows."""
    r = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"), F.count(time).alias("n")).first()
    if not r["n"]:
        return DAY
    buckets = max(1, min(r["n"] // BUCKET_ROWS, MOST_BUCKETS))
    return (r["hi"] - r["lo"]) // buckets + 1


def _with_bucket(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with the columns of other, which has a row for each of df's keys (null is a key like any) and bucket _b."""
    if not keys:
        return df.join(other, "_b")  # Spark broadcasts it if it is small
    renamed = other.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_kb"), *(c for c in other.columns if c not in (*keys, "_b")))
    on = F.col("_b") == F.col("_kb")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(renamed, on).drop("_kb", *(f"_k{i}" for i in range(len(keys))))


def gap_sessions(df: DataFrame, time: str, tie: str, gap: int, bucket: int = DAY, name: str = "session", keys: Sequence[str] = ()) -> DataFrame:
    """df with a session number, global or for each value of the keys: a row joins the session of the row before it if it is less than `gap` later.

    No window spans the whole table or all of a key. Rows are numbered inside buckets of time; the first row of a bucket
    looks back to the last time of the bucket before it (an aggregate of a row per key and bucket), and sessions of earlier
    buckets are added as an offset. The result doesn't depend on the bucket size. Ties are ordered by `tie`.
    """
    df = df.withColumn("_b", bucket_of(time, bucket))
    across = Window.partitionBy(*keys).orderBy("_b") if keys else Window.orderBy("_b")
    edges = df.groupBy(*keys, "_b").agg(F.max(time).alias("_last"))
    # One row for each bucket of time: a table of days or hours, not of rows.
    edges = edges.withColumn("_before", F.lag("_last").over(across)).select(*keys, "_b", "_before")
    w = Window.partitionBy(*keys, "_b").orderBy(time, tie)
    joined = _with_bucket(df, edges, keys)
    joined = joined.withColumn("_prev", F.coalesce(F.lag(time).over(w), "_before"))
    joined = joined.withColumn("_new", F.coalesce((F.col(time) - F.col("_prev") >= gap).cast("long"), F.lit(1)))
    joined = joined.withColumn("_local", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    starts = joined.groupBy(*keys, "_b").agg(F.sum("_new").alias("_n"))
    offsets = starts.withColumn("_offset", F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(*keys, "_b", "_offset")
    return _with_bucket(joined, offsets, keys).withColumn(name, F.col("_local") + F.col("_offset")).drop("_b", "_before", "_prev", "_new", "_local", "_offset")


def beside(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, time: str, width: int, name: str, after: bool = False) -> DataFrame:
    """df with the value of the row before (or after) each in its key, null for the first (last). order begins with `time`; windows hold a key's bucket of time, no more."""
    b = df.withColumn("_b", bucket_of(time, width))
    step, end = (F.lead, F.min_by) if after else (F.lag, F.max_by)
    held = F.struct(F.col(value).alias("v"))  # tells a null value from no row
    ends = b.groupBy(*keys, "_b").agg(end(held, F.struct(*order)).alias("_end"))
    ends = ends.withColumn("_edge", step("_end").over(Window.partitionBy(*keys).orderBy("_b"))).drop("_end")
    local = step(held).over(Window.partitionBy(*keys, "_b").orderBy(*order))
    return _with_bucket(b.withColumn("_near", local), ends, keys).withColumn(name, F.coalesce("_near", "_edge")["v"]).drop("_b", "_near", "_edge")


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, time: str, width: int, name: str) -> DataFrame:
    """df with each key's last value that is not null, up to and with the row's own, by buckets as beside()."""
    b = df.withColumn("_b", bucket_of(time, width))
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = b.groupBy(*keys, "_b").agg(F.max_by(value, known).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_edge", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    local = F.last(value, ignorenulls=True).over(Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return _with_bucket(b.withColumn("_near", local), ends, keys).withColumn(name, F.coalesce("_near", "_edge")).drop("_b", "_near", "_edge")


def point_in_range(points: DataFrame, time: str, ranges: DataFrame, start: str, stop: str, width: int, keys: Sequence[str] = (), closed: bool = False, how: str = "inner") -> DataFrame:
    """Join points to the ranges that hold them: start <= time < stop, or <= stop if closed.

    Ranges are spread over the buckets of `width` that they touch and joined on the bucket, so Spark hashes instead of
    comparing everything with everything. A point has one bucket, so no pair comes twice.
    """
    p = points.withColumn("_b", bucket_of(time, width))
    r = ranges.withColumn("_b", F.explode(F.sequence(bucket_of(start, width), bucket_of(stop, width))))
    p, r = p.alias("p"), r.alias("r")
    inside = (F.col(f"p.{time}") >= F.col(f"r.{start}")) & ((F.col(f"p.{time}") <= F.col(f"r.{stop}")) if closed else (F.col(f"p.{time}") < F.col(f"r.{stop}")))
    on = (F.col("p._b") == F.col("r._b")) & inside
    for k in keys:
        on = on & (F.col(f"p.{k}") == F.col(f"r.{k}"))
    taken = set(points.columns)
    return p.join(r, on, how).select(*(F.col(f"p.{c}") for c in points.columns), *(F.col(f"r.{c}") for c in ranges.columns if c not in taken))


def overlap_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], width: int, strict: bool = False) -> DataFrame:
    """Pairs of intervals a(id_a, left_a, right_a) and b(id_b, left_b, right_b) that overlap; strict leaves out those that only touch.

    Both sides are spread over buckets; a pair is made in the first bucket that both touch, so it comes once.
    """
    first = lambda x: bucket_of(f"left_{x}", width)
    spread = lambda d, x: d.withColumn("_b", F.explode(F.sequence(first(x), bucket_of(f"right_{x}", width))))
    joined = spread(a, "a").join(spread(b, "b"), [*keys, "_b"])
    meets = (F.col("left_a") < F.col("right_b")) & (F.col("right_a") > F.col("left_b")) if strict else (F.col("left_a") <= F.col("right_b")) & (F.col("right_a") >= F.col("left_b"))
    return joined.filter(meets & (F.col("_b") == F.greatest(first("a"), first("b")))).drop("_b")


def adjacent_intervals(df: DataFrame, keys: Sequence[str], left: str, right: str) -> DataFrame:
    """df with the number of the run of intervals that follow each other without a gap (left = previous right + 1)."""
    return keyed_islands(df, keys, [left], lagged(right, keys, [left]) + 1 != F.col(left), "run")


def extend_intervals(df: DataFrame, keys: Sequence[str], left_by: int, right_by: int, first: Column, last: Column) -> DataFrame:
    """Intervals(left, right) grown on both sides: the right side first, up to the next interval; then the left, down to the grown one before."""
    w = Window.partitionBy(*keys).orderBy("left")
    right = F.least(F.col("right") + right_by, F.coalesce(F.lead("left").over(w) - 1, last), last)
    grown = df.withColumn("right_x", right)
    left = F.greatest(F.col("left") - left_by, F.coalesce(F.lag("right_x").over(w) + 1, first), first)
    return grown.withColumn("left_x", left)


def threshold_runs(samples: DataFrame, keys: Sequence[str], index: str, value: str, threshold: float) -> DataFrame:
    """keys, left, right of the maximal runs of samples above the threshold (strictly)."""
    above = samples.filter(F.col(value) > threshold)
    runs = keyed_islands(above, keys, [index], lagged(index, keys, [index]) + 1 != F.col(index), "run")
    return runs.groupBy(*keys, "run").agg(F.min(index).alias("left"), F.max(index).alias("right")).drop("run")


def zero_length_encoding(samples: DataFrame, keys: Sequence[str], index: str, value: str, threshold: float, margin: int, last: Column) -> DataFrame:
    """keys, left, right of the stretches kept around samples above the threshold: margin on each side, clipped, overlaps merged, even starts and odd stops."""
    runs = threshold_runs(samples, keys, index, value, threshold)
    grown = runs.join(samples.select(*keys).distinct(), list(keys)).select(*keys, F.greatest(F.col("left") - margin, F.lit(0)).alias("left"), F.least(F.col("right") + margin, last).alias("right"))
    before = F.max("right").over(Window.partitionBy(*keys).orderBy("left", "right").rowsBetween(Window.unboundedPreceding, -1))
    merged = keyed_islands(grown.withColumn("_before", before), keys, ["left", "right"], F.col("left") > F.col("_before"), "run").groupBy(*keys, "run").agg(F.min("left").alias("left"), F.max("right").alias("right"))
    return merged.select(*keys, (F.col("left") + F.col("left") % 2).alias("left"), (F.col("right") - (1 - F.col("right") % 2)).alias("right"))


def runs_in_array(w: Column, threshold: float) -> Column:
    """array<struct<left, right>>: the maximal runs of samples above the threshold (strictly) of one array, without leaving its row."""
    at = F.sequence(F.lit(0), F.size(w) - 1)
    above = lambda i: F.coalesce(F.when(i >= 0, F.get(w, i)) > threshold, F.lit(False))
    starts = F.filter(at, lambda i: above(i) & ~above(i - 1))
    stops = F.filter(at, lambda i: above(i) & ~above(i + 1))
    empty = F.array().cast("array<struct<left: int, right: int>>")
    return F.when(F.size(w) == 0, empty).otherwise(F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("left"), b.alias("right"))))


def extended_in_array(runs: Column, left_by: int, right_by: int, last: Column) -> Column:
    """extend_intervals() over one array of runs inside [0, last]."""
    right = lambda r, i: F.least(r["right"] + right_by, F.coalesce(F.get(runs, i + 1)["left"] - 1, last), last)

    def grown(r: Column, i: Column) -> Column:
        before = F.when(i > 0, right(F.get(runs, i - 1), i - 1) + 1)
        return F.struct(F.greatest(r["left"] - left_by, F.coalesce(before, F.lit(0)), F.lit(0)).alias("left"), right(r, i).alias("right"))

    return F.transform(runs, grown)


def zero_length_in_array(w: Column, threshold: float, margin: int) -> Column:
    """zero_length_encoding() of one array: its runs grown by the margin, merged where they touch, with even starts and odd stops."""
    last = F.size(w) - 1
    none = F.array().cast("array<struct<left: int, right: int>>")

    def merge(out: Column, r: Column) -> Column:
        left, right = F.greatest(r["left"] - margin, F.lit(0)), F.least(r["right"] + margin, last)
        before = F.try_element_at(out, F.lit(-1))
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(before["left"].alias("left"), F.greatest(before["right"], right).alias("right"))))
        apart = F.concat(out, F.array(F.struct(left.alias("left"), right.alias("right"))))
        return F.when(F.size(out) == 0, apart).when(left <= before["right"], joined).otherwise(apart)

    merged = F.aggregate(runs_in_array(w, threshold), none, merge)
    return F.transform(merged, lambda r: F.struct((r["left"] + r["left"] % 2).alias("left"), (r["right"] - (1 - r["right"] % 2)).alias("right")))
