"""Users' own clusterers, positions, aggregates and fields as stages of named pipelines and, where SQL can call them, as SQL functions.

    @clusterer("by_half")
    def by_half(hits):                      # hits of one peak, a pandas frame in order of their maxima
        return (hits["index_of_maximum"] > hits["index_of_maximum"].mean()).astype(int)

    Pipeline(["by_half"], {"by_half": {"keys": ["event", "peak_id"]}}).run(hits)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from ..operators.peaks import peak_basics
from .pipelines import STAGES, Stage


def _register(name: str, factory: Callable[..., Stage]) -> None:
    if name in STAGES:
        raise ValueError(f"there is a stage {name!r} already")
    STAGES[name] = factory


def split_by(hits: DataFrame, keys: Sequence[str], function: Callable[[pd.DataFrame], Sequence[int]], part: str = "part") -> DataFrame:
    """hits with the number that `function` gives each hit of its peak. A peak's hits, one group, come to it in order of their maxima."""
    if part in hits.columns:
        raise ValueError(f"hits have a column {part!r} already")
    schema = StructType([*hits.schema.fields, StructField(part, IntegerType())])

    def run(peak: pd.DataFrame) -> pd.DataFrame:
        peak = peak.sort_values("index_of_maximum", kind="stable").reset_index(drop=True)
        numbers = np.asarray(function(peak.copy()))
        if numbers.shape != (len(peak),):
            raise ValueError(f"a clusterer must give one number a hit: {len(peak)} hits, result of shape {numbers.shape}")
        return peak.assign(**{part: numbers.astype("int32")})

    return hits.groupBy(*keys).applyInPandas(run, schema)


def clusterer(name: str, finalize: Callable[[DataFrame], DataFrame] | None = None):
    """Register function(hits of a peak) -> a number for each as the stage `name`. Its section gives `keys`, and `rebuild` for peaks instead of hits.

    With rebuild, hits of one peak and number become a peak by peak_basics(). finalize, a function of the whole result, comes last.
    """

    def add(function):
        def factory(keys: Sequence[str], rebuild: bool = False, **_) -> Stage:
            def run(hits: DataFrame) -> DataFrame:
                out = split_by(hits, keys, function)
                out = peak_basics(out, [*keys, "part"]) if rebuild else out
                return finalize(out) if finalize else out

            return run

        _register(name, factory)
        return function

    return add


def register_clusterer(spark: SparkSession, name: str, function: Callable[[list[float], list[float]], Sequence[int]]) -> None:
    """A table function for SQL: select .. from peaks, lateral name(times, areas) gives rows (hit int, part int) of a peak's arrays."""
    from pyspark.sql.functions import udtf

    class Clusters:
        def eval(self, times, areas) -> Iterator[tuple[int, int]]:
            numbers = function(list(times or []), list(areas or []))
            if len(numbers) != len(times or []):
                raise ValueError("a clusterer must give one number a hit")
            for i, n in enumerate(numbers):
                yield i, int(n)

    spark.udtf.register(name, udtf(Clusters, returnType="hit int, part int"))


def position_hook(name: str):
    """Register function(areas, x, y) -> (x, y), a dict with x and y (and goodness_of_fit, ndf), or None, as the stage `name`.

    Its section gives areas (an array column), the channels' places x and y, and `position` (the new column, a struct with the
    algorithm's name). Lone hits (a column lone that is true) and peaks without area in these channels don't come to the
    function; for them, and where it gives up, x and y are null.
    """

    def add(function):
        def factory(areas: str, x: Sequence[float], y: Sequence[float], position: str | None = None, **_) -> Stage:
            px, py = np.asarray(x, float), np.asarray(y, float)

            def place(a) -> tuple:
                found = function(np.asarray(a, float)[: len(px)], px, py)
                if found is None:
                    return None, None, None, None
                if not isinstance(found, dict):
                    found = dict(zip(("x", "y"), found))
                values = [found.get(k) for k in ("x", "y", "goodness_of_fit", "ndf")]
                return tuple(None if v is None or np.isnan(v) else v for v in values)

            @F.pandas_udf("x double, y double, goodness_of_fit double, ndf int")
            def run(a: pd.Series, use: pd.Series) -> pd.DataFrame:
                rows = [place(v) if u else (None,) * 4 for v, u in zip(a, use)]
                return pd.DataFrame(rows, columns=["x", "y", "goodness_of_fit", "ndf"]).astype(object).where(lambda d: d.notna(), None)

            def stage(peaks: DataFrame) -> DataFrame:
                seen = F.aggregate(F.slice(areas, 1, len(px)), F.lit(0.0), lambda s, v: s + v.cast("double")) != 0
                lone = F.coalesce(F.col("lone"), F.lit(False)) if "lone" in peaks.columns else F.lit(False)
                found = peaks.withColumn("_p", run(F.col(areas), F.coalesce(seen, F.lit(False)) & ~lone))
                return found.withColumn(position or name, F.struct(F.lit(name).alias("algorithm"), "_p.x", "_p.y", "_p.goodness_of_fit", "_p.ndf")).drop("_p")

            return stage

        _register(name, factory)
        return function

    return add


def aggregate_hook(kind: str | DataType) -> Callable[[Callable[..., object]], Callable[..., Column]]:
    """A grouped aggregate of a user's function of pandas series. Spark gives it whole groups, so it is for peaks and events, not for channels or runs."""
    return lambda function: F.pandas_udf(function, kind, F.PandasUDFType.GROUPED_AGG)


def extra_fields(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """df with new columns by SQL expressions over its own; a field may use earlier ones. Nothing is evaluated as Python.

    An expression that Spark can't resolve, that aggregates or calls a table function, or a name that is taken, is a ValueError
    that names the field.
    """
    for name, text in fields.items():
        if name in df.columns:
            raise ValueError(f"extra field {name!r}: there is a column of this name")
        try:
            out = df.withColumn(name, F.expr(text))
            out.schema  # noqa: B018  resolves the expression
        except AnalysisException as e:
            raise ValueError(f"extra field {name!r}: {e.getMessage()}") from e
        df = out
    return df


def _extra_fields(fields: dict[str, str], **_) -> Stage:
    return lambda df: extra_fields(df, fields)


STAGES.setdefault("extra_fields", _extra_fields)
