"""Flat tables and nested rows: flatten, nest, offsets, conversion, folder reading and writing."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def flatten(df: DataFrame, keys: Sequence[str], child: str) -> DataFrame:
    """One row for each element of a list of structs, with the parent's keys and the element's number."""
    own = [f.name for f in df.schema[child].dataType.elementType.fields if f.name not in keys]
    out = df.select(*keys, F.posexplode(child).alias(f"{child}_index", "_c"))
    return out.select(*keys, f"{child}_index", *(F.col(f"_c.{c}").alias(c) for c in own))


def nest(parents: DataFrame, children: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """parents with their children as a list of structs in order; parents without children get an empty list."""
    own = [c for c in children.columns if c not in keys]
    first = [*order, *(c for c in own if c not in order)]
    # A parent's children are what one event or peak holds.
    lists = children.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*first))).alias(name))
    joined = parents.join(lists, list(keys), "left")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(joined.schema[name].dataType)))


def child_offsets(df: DataFrame, order: str, size: str, name: str, width: int = 4096) -> DataFrame:
    """df with the running count of children before each row, by blocks of the order column with running offsets."""
    b = df.withColumn("_b", F.floor(F.col(order) / width))
    sums = b.groupBy("_b").agg(F.sum(size).alias("_n"))
    before = sums.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    local = F.coalesce(F.sum(size).over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return b.withColumn("_l", local).join(before, "_b").withColumn(name, F.col("_l") + F.col("_o")).drop("_b", "_l", "_o")


#: Formats by name; what each can hold.
FORMATS = {
    "parquet": {"arrays": True, "append": True},
    "orc": {"arrays": True, "append": True},
    "json": {"arrays": True, "append": True},
    "csv": {"arrays": False, "append": True},
}


def read_folder(spark: SparkSession, path: str, kind: str, schema=None, event: int | None = None) -> DataFrame:
    """Files of one format in a folder (those that start with _ or . are skipped); one event only if asked, by pushed-down filter."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}")
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.option("header", True).format(kind).load(path)
    return df if event is None else df.filter(F.col("event_number") == event)


def write_folder(df: DataFrame, path: str, kind: str, rows_per_file: int = 0, mode: str = "error", drop: Sequence[str] = (), metadata: dict | None = None) -> None:
    """Write a folder; files roll at rows_per_file; columns in `drop` are left out; metadata goes to a sidecar folder."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}")
    df = df.drop(*drop)
    if not FORMATS[kind]["arrays"]:
        df = df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes))
    df.write.mode(mode).option("header", True).option("maxRecordsPerFile", rows_per_file).format(kind).save(path)
    if metadata is not None:
        df.sparkSession.createDataFrame([(json.dumps(metadata),)], "metadata string").write.mode("overwrite").text(f"{path.rstrip('/')}.metadata")


def convert(spark: SparkSession, source: str, kind: str, target: str, to: str, schema=None) -> None:
    """Copy a folder to another format; arrays need a target that holds them or become JSON."""
    write_folder(read_folder(spark, source, kind, schema), target, to, mode="overwrite")


def event_numbers(df: DataFrame) -> DataFrame:
    """First event, last event and count from file names like name-run-first-last-n.ext."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"-(\d+)-(\d+)(?:-(\d+))?\.[a-z0-9]+$", 0)
    part = lambda i: F.regexp_extract(name, r"-(\d+)-(\d+)(?:-(\d+))?\.", i).cast("long")
    return df.select(F.col("_metadata.file_name").alias("file"), part(1).alias("first"), part(2).alias("last"), part(3).alias("n")).distinct()
