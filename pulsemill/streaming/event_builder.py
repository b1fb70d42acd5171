"""Streaming event building: open signals are carried in state between micro-batches, and everything is flushed by event time.

Each micro-batch's pulses are cut into signals together with the pulses that were still open. A signal is closed once a
gap of `separation` lies between its last pulse and the watermark; older pulses that come later are counted, not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SIGNALS = "run long, left_time long, right_time long, n_pulses long, n_contributing_channels long, area double, time_mean double, time_rms double, late long"
_STATE = "time array<long>, pmt array<long>, area array<double>, closed_to long"


def _signals(pulses: pd.DataFrame, separation: int) -> list[pd.DataFrame]:
    new = pulses["time"].diff().fillna(separation) >= separation
    return [g for _, g in pulses.groupby(new.cumsum())]


def _row(run: int, g: pd.DataFrame, late: int) -> dict:
    rel = (g["time"] - g["time"].iloc[0]).astype(float)
    return {
        "run": run, "left_time": int(g["time"].iloc[0]), "right_time": int(g["time"].iloc[-1]), "n_pulses": len(g), "n_contributing_channels": int(g["pmt"].nunique()),
        "area": float(g["area"].sum()), "time_mean": float(rel.mean()), "time_rms": float(rel.std(ddof=0)), "late": late,
    }


def _step(separation: int, margin: int):
    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run_id = int(key[0])
        old = state.get if state.exists else ([], [], [], -(1 << 62))
        carried = pd.DataFrame({"time": list(old[0]), "pmt": list(old[1]), "area": list(old[2])})
        closed_to = int(old[3])
        flush = state.hasTimedOut
        got = [] if flush else [b[["time", "pmt", "area"]] for b in batches]
        pulses = pd.concat([carried, *got], ignore_index=True) if got else carried
        late = int((pulses["time"] < closed_to).sum())
        pulses = pulses[pulses["time"] >= closed_to].sort_values(["time", "pmt"], kind="stable").reset_index(drop=True)
        if not len(pulses):
            if flush:
                state.remove()
            return
        # What lies within the margin of the newest pulse may still get company.
        until = pulses["time"].iloc[-1] - margin if not flush else None
        rows, kept = [], []
        for g in _signals(pulses, separation):
            if flush or g["time"].iloc[-1] + separation <= until:
                closed_to = max(closed_to, int(g["time"].iloc[-1]) + 1)
                if len(g) > 1:
                    rows.append(_row(run_id, g, late))
            else:
                kept.append(g)
        if flush:
            state.remove()
        else:
            rest = pd.concat(kept) if kept else pulses.iloc[:0]
            state.update((rest["time"].astype("int64").tolist(), rest["pmt"].astype("int64").tolist(), rest["area"].astype(float).tolist(), closed_to))
            state.setTimeoutTimestamp(max(int(pulses["time"].iloc[-1] // 1_000_000) + 1, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame(rows)

    return run


def stream_signals(pulses: DataFrame, separation: int, margin: int, delay: str = "0 seconds") -> DataFrame:
    """Signals of a stream pulses(run, ts timestamp, time long ns, pmt, area), one state per run.

    margin: how far behind the newest pulse signals stay open; delay: the watermark's. When the watermark passes a run's
    last pulse, its open signals are flushed.
    """
    marked = pulses.withWatermark("ts", delay)
    return marked.groupBy("run").applyInPandasWithState(_step(separation, margin), SIGNALS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def stream_rates(pulses: DataFrame, interval: str, delay: str) -> DataFrame:
    """Counts by channel and tumbling window of a stream pulses(ts, pmt), each window once, when the watermark has passed it."""
    return pulses.withWatermark("ts", delay).groupBy(F.window("ts", interval), "pmt").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "pmt", "n")
