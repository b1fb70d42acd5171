"""Lookups, semi-filters, registry queries and small text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def filter_on_fields(df: DataFrame, other: DataFrame, fields: Sequence[str], fields_2: Sequence[str] | None = None, keep: bool = True) -> DataFrame:
    """Rows of df whose key fields appear in other (keep), or don't."""
    keys = other.select(*(F.col(b).alias(a) for a, b in zip(fields, fields_2 or fields)))
    return df.join(keys, list(fields), "left_semi" if keep else "left_anti")


def lookup(df: DataFrame, on: Sequence[str], dim: DataFrame, key: Sequence[str], value: str, default) -> DataFrame:
    """df with a value of a dimension table; unknown keys get the default. Spark broadcasts the dimension if its size allows."""
    d = dim.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), F.col(value))
    cond = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(on)]
    joined = df.join(d, cond, "left").drop(*(f"_k{i}" for i in range(len(key))))
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))


def run_at(points: DataFrame, runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest run of each point's key that holds its time: start < t and (stop > t or no stop); null if none does."""
    held = points.join(runs, list(keys)).filter((F.col("start") < F.col("t")) & (F.col("stop").isNull() | (F.col("stop") > F.col("t"))))
    best = held.groupBy(*keys, "t").agg(F.max("run").alias("run"))
    return points.join(best, [*keys, "t"], "left")


def expired(runs: DataFrame, processed: Column, recent: Column, preserved: Column, end: Column, before: Column) -> DataFrame:
    """Runs that may be deleted: processed, of the given range, not preserved, and ended before the grace time."""
    return runs.filter(processed & recent & ~preserved & (end < before))


def every_nth(df: DataFrame, order: str, n: int, width: int = 4096) -> DataFrame:
    """Every n-th row by an integer column, numbered by blocks of it with running offsets, so nothing is sorted in one task."""
    b = df.withColumn("_b", F.floor(F.col(order) / width))
    sizes = b.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    numbered = b.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order))).join(offsets, "_b")
    return numbered.filter((F.col("_r") + F.col("_o")) % n == 0).select(df.columns)


def uri_parts(uri: Column) -> Column:
    pattern = r"^([a-z]+)://([^/:]+)(?::([0-9]+))?(?:/([^?]*))?"
    return F.struct(*(F.regexp_extract(uri, pattern, i).alias(n) for i, n in enumerate(("scheme", "host", "port", "path"), 1)))


def escape_section(name: Column) -> Column:
    return F.replace(name, F.lit("|"), F.lit("."))


def human_time(ns: Column) -> Column:
    """Nanoseconds as text in the largest fitting of us, ms and s."""
    us = ns / 1000
    return F.when(F.abs(us) < 1e3, F.format_string("%.1f us", us)).when(F.abs(us) < 1e6, F.format_string("%.1f ms", us / 1e3)).otherwise(F.format_string("%.1f s", us / 1e6))


def cast_model(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """df with the declared columns and types; unknown or missing columns are an error if strict, and values that can't be cast fail the query."""
    wrong = set(df.columns) ^ set(types)
    if strict and wrong:
        raise ValueError(f"columns differ from the model: {sorted(wrong)}")
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items() if c in df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN floats and the integer marker -99999 as nulls."""
    kinds = dict(df.dtypes)
    floats = {c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c, k in kinds.items() if k in ("float", "double")}
    ints = {c: F.when(F.col(c) == -99999, None).otherwise(F.col(c)) for c, k in kinds.items() if k in ("int", "bigint")}
    return df.withColumns({**floats, **ints}) if floats or ints else df
