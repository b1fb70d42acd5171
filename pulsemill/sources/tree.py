"""Whole trees of nested lists as flat tables, one for each level, and back. The schema drives the recursion.

A table has the root's keys, the place in each list on the way (`<list>_index`), its own fields, and for each list in it the
number of elements (`n_<list>`) and the place of the first one among all rows of that list's table (`<list>_start`).
Tables are named by the way to them: "peaks", "peaks.hits". Arrays of plain values stay arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from .flat import child_offsets

ROOT = ""


def _lists(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType)]


def _descendants(schema: StructType, way: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """The ways to all lists of structs, outer ones first."""
    out = []
    for name in _lists(schema):
        out += [(*way, name), *_descendants(schema[name].dataType.elementType, (*way, name))]
    return out


def _total(of: Column, way: Sequence[str]) -> Column:
    """Number of elements at the end of a way through lists of one row."""
    lists = F.coalesce(of.getField(way[0]), F.array())
    if len(way) == 1:
        return F.size(lists).cast("long")
    return F.aggregate(F.transform(lists, lambda x: _total(x, way[1:])), F.lit(0).cast("long"), lambda s, n: s + n)


def flatten_tree(df: DataFrame, keys: Sequence[str], order: str | None = None) -> dict[str, DataFrame]:
    """Tables of all levels of df, by their ways; the root's is "". keys identify a root row; `order`, a whole-numbered key, numbers them.

    A null list is taken as empty and a null element as one of nulls. Field names of a list's structs must not clash with the
    keys, with the index columns on the way to it or with n_<list> and <list>_start of its own lists.
    """
    order = order or keys[0]
    ways = _descendants(df.schema)
    whole = df.select(*keys, F.struct(*df.columns).alias("_row"))
    # How many rows of each list's table come from root rows before this one: counted in the row, carried on by blocks.
    sizes = whole.select(*keys, *(_total(F.col("_row"), way).alias("n:" + ".".join(way)) for way in ways))
    for way in ways:
        sizes = child_offsets(sizes, order, f"`n:{'.'.join(way)}`", "s:" + ".".join(way))
    starts = sizes.select(*keys, *(F.col(f"`s:{'.'.join(way)}`").alias("s:" + ".".join(way)) for way in ways))
    tables: dict[str, DataFrame] = {}

    def visit(rows: DataFrame, schema: StructType, way: tuple[str, ...], indices: list[str]) -> None:
        """rows: keys, indices and the struct _row of one level."""
        own, lists = [f.name for f in schema.fields if way or f.name not in keys], _lists(schema)
        taken = {*keys, *indices} & {*own} | {n for x in lists for n in (f"n_{x}", f"{x}_start")} & {f.name for f in schema.fields}
        if taken:
            raise ValueError(f"fields of {'.'.join(way) or 'the root'} clash with columns of its table: {sorted(taken)}")
        out = rows.select(*keys, *indices, "_row")
        if lists:
            here = Window.partitionBy(*keys).orderBy(*indices).rowsBetween(Window.unboundedPreceding, -1) if indices else None  # rows of one root row
            out = out.join(starts, list(keys))
            for x in lists:
                n = _total(F.col("_row"), [x])
                base = F.col(f"`s:{'.'.join((*way, x))}`")
                out = out.withColumn(f"n_{x}", n).withColumn(f"{x}_start", base if here is None else base + F.coalesce(F.sum(n).over(here), F.lit(0)))
        counts = [c for x in lists for c in (f"n_{x}", f"{x}_start")]
        tables[".".join(way)] = out.select(*keys, *indices, *(F.col("_row").getField(c).alias(c) for c in own if c not in lists), *counts)
        for x in lists:
            inner = schema[x].dataType.elementType
            at = f"{x}_index"
            visit(rows.select(*keys, *indices, F.posexplode(F.col("_row").getField(x)).alias(at, "_row")), inner, (*way, x), [*indices, at])

    visit(whole, df.schema, (), [])
    return tables


def nest_tree(tables: dict[str, DataFrame], keys: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of `schema` that flatten_tree() made the tables of: its inverse. Lists come back in the order of their index; rows without elements have empty lists."""

    def built(way: tuple[str, ...], part: StructType, indices: list[str]) -> DataFrame:
        rows, lists = tables[".".join(way)], _lists(part)
        by = [*keys, *indices]
        for x in lists:
            at = f"{x}_index"
            inner = part[x].dataType.elementType
            children = built((*way, x), inner, [*indices, at])
            fields = F.struct(*(F.col(f.name) for f in inner.fields))
            lists_of = children.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), fields.alias("row")))).alias("_l"))
            rows = rows.join(lists_of, by, "left")
            empty = F.array().cast(rows.schema["_l"].dataType)
            rows = rows.withColumn(x, F.transform(F.coalesce("_l", empty), lambda e: e["row"])).drop("_l")
        return rows.select(*dict.fromkeys([*by, *(f.name for f in part.fields)]))

    return built((), schema, []).select(*(f.name for f in schema.fields))
