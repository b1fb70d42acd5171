"""Named pipelines: lists of DataFrame stages, and configuration by merging sections (later wins), without evaluating text."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..functions.units import quantity

Stage = Callable[[DataFrame], DataFrame]
STAGES: dict[str, Callable[..., Stage]] = {}


def stage(function):
    """Register a factory of stages under its name."""
    STAGES[function.__name__] = function
    return function


def merge(*configs: dict[str, dict]) -> dict[str, dict]:
    """Sections merged key by key; later configurations win."""
    out: dict[str, dict] = {}
    for config in configs:
        for section, values in config.items():
            out[section] = {**out.get(section, {}), **values}
    return out


def resolve(config: dict[str, dict]) -> dict[str, dict]:
    """Texts that start with '=' are quantities with units."""
    value = lambda v: quantity(v[1:]) if isinstance(v, str) and v.startswith("=") else v
    return {s: {k: value(v) for k, v in values.items()} for s, values in config.items()}


class Pipeline:
    """Stages by name, each with DEFAULT and its own section as arguments; run() chains them into one plan."""

    def __init__(self, names: Sequence[str], config: dict[str, dict] | None = None):
        unknown = [n for n in names if n not in STAGES]
        if unknown:
            raise ValueError(f"unknown stages: {unknown}")
        config = resolve(config or {})
        self.stages = [(n, STAGES[n](**{**config.get("DEFAULT", {}), **config.get(n, {})})) for n in names]
        self.planning: dict[str, float] = {}

    def run(self, df: DataFrame) -> DataFrame:
        for name, f in self.stages:
            began = time.perf_counter()
            df = df.transform(f)
            self.planning[name] = time.perf_counter() - began
        return df


@stage
def keep_events(numbers: Sequence[int], **_) -> Stage:
    return lambda df: df.filter(df["event_number"].isin(list(numbers)))


@stage
def drop_columns(columns: Sequence[str], **_) -> Stage:
    return lambda df: df.drop(*columns)


@stage
def gap_signals(separation: float, **_) -> Stage:
    from ..operators.trigger import find_signals

    return lambda df: find_signals(df, int(separation))


@stage
def classify(s1_max_rms: float, s2_min_pulses: int, **_) -> Stage:
    from ..operators.trigger import classify_signals

    return lambda df: classify_signals(df, s1_max_rms, s2_min_pulses)


#: Presets: stage lists with their configuration.
PRESETS = {
    "trigger": (("gap_signals", "classify"), {"gap_signals": {"separation": "=300 * ns"}, "classify": {"s1_max_rms": "=200 * ns", "s2_min_pulses": 7}}),
}
