"""Events, monitor tallies and late counts of a pulse stream, by two chained stateful operators.

The first is keyed by (run, bucket of time), so the buckets of a run are worked on by as many tasks. It keeps a bucket's
pulses as list state; when the watermark passes the bucket's end, a timer cuts them into clusters and sums them up. The
second sees clusters and counts only, no pulses. Under one key of a run it joins the clusters that touch across a bucket's
edge, carries open signals and events over, and closes events, intervals of monitoring (empty ones too) and late counts;
channels' counts of pulses, which may be nearly as many as the pulses, are summed up under a key of each interval. Only
clusters that may go on beyond their bucket bring their channels. Pulses go to the first operator, and are kept there, in
packets: the pulses of a bucket that one batch of Arrow rows holds. A bucket's clusters leave it packed in one row, and
other state is packed too, as Spark hands rows and state to Python one by one.

Frontier: the last bucket edge before the watermark (timers fire when the watermark lies beyond them, not at them); all
pulses before it are known. Rows of a bucket that has been closed are late: they are counted and not used.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

MS = 1_000_000
NO_TRIGGER = -(1 << 62)
#: What the event builder gives, the names of an interval's counts, and the key beside run of all that is not a channel's count.
KINDS = ("event", "tally", "interval", "late")
NAMES = ("pulses", "lone", "pair", "signals", "events")
STITCHED = -(1 << 63)
#: Rows of a frame that leaves an operator, signals of one row of state.
ROWS = 50_000
_PACKET = "run long, bucket long, ts timestamp, time binary, pmt binary, area binary"
_CLUSTER = "left long, right long, size long, channels long, pmt long, other long, mean double, m2 double, area double"
_COLUMNS = [c.split(" ")[0] for c in _CLUSTER.split(", ")]
#: kind bucket: its pulses' number n, its clusters' whole and real numbers by column (size: of pulses; pmt, other: least and greatest channel), all channels of the first cluster (head) and last (tail) if they may touch others. kind count: channels and their pulses (whole). kind late: n. A column costs Python as much as a hundred numbers, so there are few.
PARTS = "run long, ts timestamp, kind string, interval long, n long, whole binary, real binary, head binary, tail binary"
_SIGNAL = "left_time long, right_time long, n_pulses long, n_contributing_channels long, area double, time_mean double, time_rms double, type int, trigger boolean"
_FIELDS = [f.split(" ")[0] for f in _SIGNAL.split(", ")]
_PACKED = np.dtype([(f, {"long": "i8", "double": "f8", "int": "i4", "boolean": "?"}[t]) for f, t in (x.split(" ") for x in _SIGNAL.split(", "))])
_CELL = ["interval", "name", "a", "b", "n"]
OUTPUT = f"run long, kind string, start long, stop long, n_triggers long, signals array<struct<{_SIGNAL.replace(' ', ': ').replace(',:', ',')}>>, interval long, name string, a long, b long, n long"
PARTS_COLUMNS = [c.split(" ")[0] for c in PARTS.split(", ")]
OUTPUT_COLUMNS = ["run", "kind", "start", "stop", "n_triggers", "signals", "interval", "name", "a", "b", "n"]


@dataclass(frozen=True)
class Rules:
    """What makes signals, triggers and events; times in ns. width: of a bucket; interval: of the monitor, a multiple of width."""

    separation: int = 300
    event_separation: int = 250_000
    left_extension: int = 100_000
    right_extension: int = 100_000
    s1_max_rms: float = 200.0
    s2_min_pulses: int = 7
    steps: dict = field(default_factory=lambda: {1: {50: 1.0}, 2: {7: 1.0}})
    max_length: int | None = None
    width: int = 1_000_000_000
    interval: int = 5_000_000_000

    def __post_init__(self):
        if self.event_separation < self.left_extension + self.right_extension:
            raise ValueError("event separation must be at least the sum of the extensions")
        if self.width % MS or self.interval % self.width:
            raise ValueError("width must be whole milliseconds and interval a multiple of width")
        if self.separation > self.width:
            raise ValueError("pulses of a signal must lie in one bucket or in neighbouring ones: separation <= width")

    def judged(self, c: pd.DataFrame) -> np.ndarray:
        """Clusters of two or more pulses as signals, with types and triggers as operators.trigger decides them."""
        out = np.empty(len(c), _PACKED)
        for field_, column in zip(_FIELDS, ("left", "right", "size", "channels", "area", "mean")):
            out[field_] = c[column]
        n = out["n_pulses"]
        out["time_rms"] = np.sqrt(np.maximum(c["m2"].to_numpy(float), 0.0) / n)
        wide = out["time_rms"] > self.s1_max_rms
        out["type"] = np.where(wide, np.where(n >= self.s2_min_pulses, 2, 0), 1)
        p = np.zeros(len(c))
        for kind, steps in self.steps.items():
            for least in sorted(steps):
                p[(out["type"] == kind) & (n >= least)] = float(steps[least])
        out["trigger"] = p >= 1
        for i in np.flatnonzero((p > 0) & (p < 1)):
            drawn = xxhash.xxh64_intdigest(struct.pack("<q", int(out["left_time"][i])), 42)
            out["trigger"][i] = (drawn - (1 << 64) if drawn >> 63 else drawn) % 1_000_000 / 1e6 < p[i]
        return out


def _clusters(time: np.ndarray, pmt: np.ndarray, area: np.ndarray, separation: int) -> tuple[dict, list[np.ndarray]]:
    """The arrays of _CLUSTER over the clusters of one bucket's pulses, and their channels."""
    order = np.lexsort((pmt, time))
    time, pmt, area = time[order], pmt[order], area[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(time) >= separation]))
    n = np.diff(np.append(first, len(time)))
    rel = (time - np.repeat(time[first], n)).astype(float)
    mean = np.add.reduceat(rel, first) / n
    m2 = np.add.reduceat((rel - np.repeat(mean, n)) ** 2, first)
    cluster = np.repeat(np.arange(len(first)), n)
    order = np.lexsort((pmt, cluster))
    cluster, seen = cluster[order], pmt[order]
    new = np.concatenate([[True], (np.diff(cluster) != 0) | (np.diff(seen) != 0)])
    cluster, seen = cluster[new], seen[new]
    channels = np.bincount(cluster, minlength=len(first))
    stops = np.cumsum(channels)
    arrays = (time[first], time[first + n - 1], n, channels, seen[stops - channels], seen[stops - 1], mean, m2, np.add.reduceat(area, first))
    return dict(zip(_COLUMNS, arrays)), np.split(seen, stops[:-1])


def _bytes(arrays: dict, columns: list[str]) -> bytes:
    return np.stack([arrays[c] for c in columns]).tobytes()


def _numbers(packed: bytes | None, kind: type = np.int64, columns: int = 1) -> np.ndarray:
    return np.frombuffer(packed or b"", kind).reshape(columns, -1)


def cluster_bucket(pulses: pd.DataFrame, separation: int) -> pd.DataFrame:
    """left, right, n, mean and m2 (of times from left), area, pmts of the clusters of one bucket's pulses(time, pmt, area)."""
    c, pmts = _clusters(pulses["time"].to_numpy(np.int64), pulses["pmt"].to_numpy(np.int64), pulses["area"].to_numpy(float), separation)
    return pd.DataFrame({"left": c["left"], "right": c["right"], "n": c["size"], "mean": c["mean"], "m2": c["m2"], "area": c["area"], "pmts": [x.tolist() for x in pmts]})


def _packed(width: int):
    """Rows run, bucket, ts, time, pmt, area of _PACKET from Arrow rows run, ts, time, pmt, area: a row for each run and bucket of a batch; ts is the latest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            run, time, pmt, area = (batch[c].to_numpy(zero_copy_only=False) for c in ("run", "time", "pmt", "area"))
            bucket = time // width
            order = np.lexsort((bucket, run))
            run, bucket = run[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(run) != 0) | (np.diff(bucket) != 0)]))
            ends = [*first[1:].tolist(), len(run)]
            pieces = lambda x: [x[order[i:j]].tobytes() for i, j in zip(first, ends)]
            ts = pc.fill_null(batch["ts"].cast(pa.int64()), -(1 << 63)).to_numpy()[order]
            latest = pa.array(np.maximum.reduceat(ts, first), mask=np.maximum.reduceat(ts, first) == -(1 << 63))
            yield pa.RecordBatch.from_arrays(
                [pa.array(run[first]), pa.array(bucket[first]), latest.cast(batch.schema.field("ts").type), *(pa.array(pieces(x), pa.binary()) for x in (time, pmt, area))],
                names=["run", "bucket", "ts", "time", "pmt", "area"],
            )

    return run


def _packets(pdf: pd.DataFrame) -> list[tuple[bytes, bytes, bytes]]:
    """Packets of time, pmt and area: as they are, or one of rows that are a pulse each."""
    if pdf["time"].dtype == object:
        return [tuple(map(bytes, x)) for x in zip(pdf["time"], pdf["pmt"], pdf["area"])]
    return [(pdf["time"].to_numpy("i8").tobytes(), pdf["pmt"].to_numpy("i8").tobytes(), pdf["area"].to_numpy("f8").tobytes())] if len(pdf) else []


class BucketClusters(StatefulProcessor):
    """Key (run, bucket): pulses wait as list state until the watermark passes the bucket, then leave as clusters and counts."""

    def __init__(self, rules: Rules, kinds: tuple[str, ...] = KINDS):
        self.rules, self.kinds = rules, kinds

    def init(self, handle) -> None:
        self.handle = handle
        self.pulses = handle.getListState("pulses", "time binary, pmt binary, area binary")

    def _rows(self, run: int, bucket: int, now: int, rows: list[dict]) -> pd.DataFrame:
        # Rows that leave an operator must not lie behind its watermark.
        same = {"run": run, "ts": pd.Timestamp(max(now, 0) + 1, unit="ms", tz="UTC"), "interval": bucket * self.rules.width // self.rules.interval}
        return pd.DataFrame({c: [same[c] if c in same else r.get(c) for r in rows] for c in PARTS_COLUMNS})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        run, bucket = int(key[0]), int(key[1])
        now, end = timerValues.getCurrentWatermarkInMs(), (bucket + 1) * self.rules.width // MS
        packets = [x for pdf in rows for x in _packets(pdf)]
        if end < now:
            late = sum(len(time) // 8 for time, _, _ in packets)
            if late:
                yield self._rows(run, bucket, now, [{"kind": "late", "n": late}])
        else:
            if packets:
                self.pulses.appendList(packets)
            self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run, bucket, r = int(key[0]), int(key[1]), self.rules
        held = [[np.frombuffer(x, t) for x, t in zip(row, ("i8", "i8", "f8"))] for row in self.pulses.get()]
        self.pulses.clear()
        if not held:
            return
        time, pmt, area = (np.concatenate(x) for x in zip(*held))
        now, c, pmts = timerValues.getCurrentWatermarkInMs(), *_clusters(time, pmt, area, r.separation)
        back, on = c["left"][0] < bucket * r.width - 1 + r.separation, c["right"][-1] > (bucket + 1) * r.width - r.separation
        rows = [{"kind": "bucket", "n": len(time), "whole": _bytes(c, _COLUMNS[:6]), "real": _bytes(c, _COLUMNS[6:]), "head": pmts[0].tobytes() if back else None, "tail": pmts[-1].tobytes() if on else None}]
        if "tally" in self.kinds:
            rows.append({"kind": "count", "n": len(time), "whole": np.stack(np.unique(pmt, return_counts=True)).tobytes()})
        yield self._rows(run, bucket, now, rows)


def _joined(c: pd.DataFrame, separation: int) -> pd.DataFrame:
    """Clusters in order of time with those that touch made one; means are from each one's own left."""
    left, right, size = (c[x].to_numpy() for x in ("left", "right", "size"))
    first = np.flatnonzero(np.concatenate([[True], left[1:] - right[:-1] >= separation]))
    parts = np.diff(np.append(first, len(c)))
    out, many = c.iloc[first].reset_index(drop=True), np.flatnonzero(parts > 1)
    if not len(many):
        return out
    n = np.add.reduceat(size, first)
    means = c["mean"].to_numpy() + (left - np.repeat(left[first], parts))
    mean = np.add.reduceat(means * size, first) / n
    m2 = np.add.reduceat(c["m2"].to_numpy() + size * (means - np.repeat(mean, parts)) ** 2, first)
    pmts = c["pmts"].to_numpy()
    sets = [np.unique(np.concatenate(pmts[first[i] : first[i] + parts[i]].tolist())) for i in many]
    sums = {"right": right[first + parts - 1][many], "size": n[many], "channels": [len(x) for x in sets], "pmt": [x[0] for x in sets], "other": [x[-1] for x in sets], "mean": mean[many], "m2": m2[many], "area": np.add.reduceat(c["area"].to_numpy(), first)[many]}
    for column, values in sums.items():
        out.loc[many, column] = values
    held = out["pmts"].to_numpy(copy=True)
    for i, x in zip(many, sets):
        held[i] = x
    return out.assign(pmts=held)


def _of_buckets(rows: pd.DataFrame) -> pd.DataFrame:
    """The clusters of rows of buckets, in order of time; pmts where a bucket gave them."""
    whole, real = [_numbers(x, columns=6) for x in rows["whole"]], [_numbers(x, float, 3) for x in rows["real"]]
    out = pd.DataFrame(dict(zip(_COLUMNS, [*np.concatenate(whole, axis=1), *np.concatenate(real, axis=1)])))
    pmts, stops = np.full(len(out), None, object), np.cumsum([x.shape[1] for x in whole])
    for head, tail, lo, hi in zip(rows["head"], rows["tail"], [0, *stops[:-1]], stops):
        for at, channels in ((lo, head), (hi - 1, tail)):
            pmts[at] = _numbers(channels)[0] if channels is not None else pmts[at]
    return out.assign(pmts=pmts).sort_values("left", kind="stable", ignore_index=True)


def _cells(interval, name: int, n, a=0, b=0) -> np.ndarray:
    """Counts by interval, number of the name and channels, as rows of whole numbers."""
    return np.column_stack(np.broadcast_arrays(interval, name, a, b, n)).astype(np.int64)


class EventStitcher(StatefulProcessor):
    """Key run: clusters of closed buckets become signals, events and tallies; what is open is state.

    Channels' counts of pulses need no stitching and may come under keys of their own, (run, interval).
    """

    def __init__(self, rules: Rules, kinds: tuple[str, ...] = KINDS):
        self.rules, self.kinds = rules, kinds

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"{_CLUSTER}, pmts array<long>")
        self.signals = handle.getListState("signals", "packed binary")
        self.counts = handle.getListState("counts", "packed binary")
        self.channels = handle.getListState("channels", "interval long, pmts binary, ns binary")
        self.edge = handle.getValueState("edge", "next_interval long, last_interval long, last_trigger long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._step(int(key[0]), rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(int(key[0]), None, timerValues.getCurrentWatermarkInMs())

    def _step(self, run: int, frames: Iterator[pd.DataFrame] | None, now: int) -> Iterator[pd.DataFrame]:
        r = self.rules
        frontier = (now * MS - 1) // r.width * r.width
        clusters, cells, channels = [], [], []
        for rows in frames or ():
            of = {kind: rows[rows["kind"] == kind] for kind in ("bucket", "count", "late")}
            if len(of["bucket"]):
                clusters.append(_of_buckets(of["bucket"]))
                cells.append(_cells(of["bucket"]["interval"], 0, of["bucket"]["n"]))
            channels += [(int(i), *_numbers(x, columns=2)) for i, x in zip(of["count"]["interval"], of["count"]["whole"])]
            if len(of["late"]) and "late" in self.kinds:
                yield self._frame(run, "late", interval=of["late"]["interval"].to_numpy(np.int64), n=of["late"]["n"].to_numpy(np.int64))
        if channels or frames is None:
            yield from self._channel_counts(run, channels, frontier)
        edge = tuple(self.edge.get()) if self.edge.exists() else None
        if edge is None and not clusters:
            return
        c = pd.concat(clusters, ignore_index=True).sort_values("left", kind="stable") if clusters else None
        next_interval, last_interval, last_trigger = edge or (int(c["left"].iloc[0]) // r.interval, 0, NO_TRIGGER)
        if self.open.exists():
            opened = pd.DataFrame([tuple(self.open.get())], columns=[*_COLUMNS, "pmts"])
            c = opened if c is None else pd.concat([opened, c], ignore_index=True)
        opened = None
        if c is not None:
            last_interval = max(last_interval, int(c["right"].iloc[-1]) // r.interval)
            c = _joined(c, r.separation)
            if int(c["right"].iloc[-1]) + r.separation > frontier:
                opened, c = c.iloc[-1], c.iloc[:-1]
            interval, lone, two = c["left"].to_numpy() // r.interval, (c["size"] == 1).to_numpy(), (c["channels"] == 2).to_numpy()
            pmt, other = c["pmt"].to_numpy(), c["other"].to_numpy()
            cells += [_cells(interval[lone], 1, 1, pmt[lone]), _cells(interval[two], 2, 1, pmt[two], other[two]), _cells(interval[~lone], 3, 1)]
            c = c[~lone]

        known = frontier if opened is None else min(frontier, int(opened["left"]))  # all signals before it are final
        pending, closed = [], None
        if "event" in self.kinds or "interval" in self.kinds:
            signals = np.concatenate([*(np.frombuffer(x[0], _PACKED) for x in self.signals.get()), r.judged(c) if c is not None else np.empty(0, _PACKED)])
            events = self._events(signals)
            over = (events["last"] + r.event_separation <= known) & (events["stop"] < known)
            pending = [tuple(map(int, e)) for e in events.loc[~over, ["start", "stop", "last"]].itertuples(index=False)]
            closed = events[over & (events["last"] > last_trigger)]
            if len(closed):
                last_trigger = int(closed["last"].iloc[-1])
                cells.append(_cells((closed["start"] + r.left_extension) // r.interval, 4, 1))
            # Triggers of closed events go, other signals stay while an event to come may hold them.
            keep_from = min([known - r.left_extension, *(p[0] for p in pending)])
            kept = signals[np.searchsorted(signals["left_time"], keep_from) :]
            self.signals.put([(kept[i : i + ROWS].tobytes(),) for i in range(0, len(kept), ROWS)]) if len(kept) else self.signals.clear()

        # An interval is closed when no cluster or event that starts in it is open. Intervals after the last pulse wait for one.
        final = min(min([known, *(p[0] + r.left_extension for p in pending)]) // r.interval, last_interval + 1)
        shown, first = None, next_interval
        cells = np.concatenate([np.empty((0, len(_CELL)), np.int64), *cells])
        if final > next_interval:
            cells = np.concatenate([*(np.frombuffer(x[0], np.int64).reshape(-1, len(_CELL)) for x in self.counts.get()), cells])
            shown, cells = cells[cells[:, 0] < final], cells[cells[:, 0] >= final]
            self.counts.clear()
            next_interval = final
        if len(cells) and ("tally" in self.kinds or "interval" in self.kinds):
            self.counts.appendList([(cells.tobytes(),)])

        self.edge.update((next_interval, last_interval, last_trigger))
        if opened is not None:
            self.open.update((*opened[_COLUMNS], np.asarray(opened["pmts"], np.int64).tolist()))
        else:
            self.open.clear()
        self._wake(now, opened, pending, next_interval, last_interval)
        if closed is not None and "event" in self.kinds:
            yield from self._event_frames(run, closed, signals)
        if shown is not None:
            yield from self._interval_frames(run, shown, first, final)

    def _channel_counts(self, run: int, new: list[tuple], frontier: int) -> Iterator[pd.DataFrame]:
        """Pulses by channel of intervals whose buckets are all closed; those of other intervals wait."""
        r = self.rules
        ready = lambda row: (row[0] + 1) * r.interval <= frontier
        now, wait = [x for x in new if ready(x)], [x for x in new if not ready(x)]
        packed = [(i, p.tobytes(), n.tobytes()) for i, p, n in wait]
        if (now or not new) and self.channels.exists():
            held = [tuple(x) for x in self.channels.get()]
            now += [(int(i), _numbers(p)[0], _numbers(n)[0]) for i, p, n in filter(ready, held)]
            packed = [x for x in held if not ready(x)] + packed
            self.channels.clear()
        if packed:
            self.channels.appendList(packed)
        for i in {x[0] for x in wait}:
            self.handle.registerTimer((i + 1) * r.interval // MS)
        by = defaultdict(list)
        for i, p, n in now:
            by[i].append((p, n))
        for i, found in sorted(by.items()):
            pmts, ns = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(pmts, kind="stable")
            pmts, ns = pmts[order], ns[order]
            first = np.flatnonzero(np.concatenate([[True], np.diff(pmts) != 0]))
            yield from self._frames(run, "tally", interval=np.full(len(first), i), name=np.full(len(first), NAMES[0], object), a=pmts[first], n=np.add.reduceat(ns, first))

    def _events(self, signals: np.ndarray) -> pd.DataFrame:
        """start, stop, n_triggers and last trigger of the groups of triggers."""
        r, t = self.rules, signals[signals["trigger"]]
        left = t["left_time"]
        first = np.flatnonzero(np.concatenate([[True], np.diff(left) >= r.event_separation])) if len(t) else np.empty(0, int)
        n = np.diff(np.append(first, len(t)))
        start = left[first] - r.left_extension
        stop = (np.maximum.reduceat(t["right_time"], first) if len(t) else left) + r.right_extension
        stop = stop if r.max_length is None else np.minimum(stop, start + r.max_length)
        return pd.DataFrame({"start": start, "stop": stop, "n_triggers": n, "last": left[first + n - 1]})

    def _wake(self, now: int, opened: pd.Series | None, pending: list[tuple], next_interval: int, last_interval: int) -> None:
        """A timer at the next bucket edge at which something open may close. Older timers that fire find nothing to close."""
        r = self.rules
        times = [int(opened["right"]) + r.separation] if opened is not None else []
        times += [max(last + r.event_separation, stop + 1) for _, stop, last in pending]
        times += [(next_interval + 1) * r.interval] if next_interval <= last_interval else []
        if times:
            at = -(-min(times) // r.width) * r.width // MS
            self.handle.registerTimer(max(at, now))

    def _frame(self, run: int, kind: str, **columns) -> pd.DataFrame:
        """Rows of one kind; nulls (not NaN) in the columns that it lacks."""
        n = len(next(iter(columns.values())))
        columns |= {"run": np.full(n, run), "kind": np.full(n, kind, object)}
        return pd.DataFrame({c: columns[c] if c in columns else np.full(n, None, object) for c in OUTPUT_COLUMNS})

    def _frames(self, run: int, kind: str, **columns) -> Iterator[pd.DataFrame]:
        for i in range(0, len(next(iter(columns.values()))), ROWS):
            yield self._frame(run, kind, **{c: x[i : i + ROWS] for c, x in columns.items()})

    def _event_frames(self, run: int, events: pd.DataFrame, signals: np.ndarray) -> Iterator[pd.DataFrame]:
        """Events with their signals, some ten thousand signals at a time."""
        lo, hi = np.searchsorted(signals["left_time"], events["start"]), np.searchsorted(signals["left_time"], events["stop"], "right")
        part = np.cumsum(hi - lo) // ROWS
        for k in np.unique(part):
            e, at = events[part == k], np.flatnonzero(part == k)
            held = np.empty(len(e), object)
            held[:] = [[dict(zip(_FIELDS, s)) for s in signals[lo[i] : hi[i]].tolist()] for i in at]
            yield self._frame(run, "event", start=e["start"].to_numpy(), stop=e["stop"].to_numpy(), n_triggers=e["n_triggers"].to_numpy(), signals=held)

    def _interval_frames(self, run: int, cells: np.ndarray, first: int, final: int) -> Iterator[pd.DataFrame]:
        """Tallies of lone and paired channels and all counts of the intervals from first to before final."""
        if "tally" in self.kinds:
            tally = pd.DataFrame(cells, columns=_CELL)
            tally = tally[tally["name"].isin([1, 2])].groupby(_CELL[:4], as_index=False)["n"].sum()
            for k in (1, 2):
                x = tally[tally["name"] == k]
                more = {"b": x["b"].to_numpy()} if k == 2 else {}
                yield from self._frames(run, "tally", interval=x["interval"].to_numpy(), name=np.full(len(x), NAMES[k], object), a=x["a"].to_numpy(), n=x["n"].to_numpy(), **more)
        if "interval" in self.kinds:
            cells, many = cells[np.argsort(cells[:, 0], kind="stable")], ROWS // len(NAMES)
            for lo in range(first, final, many):
                hi = min(lo + many, final)
                own = cells[np.searchsorted(cells[:, 0], lo) : np.searchsorted(cells[:, 0], hi)]
                n = np.zeros((hi - lo, len(NAMES)), np.int64)
                np.add.at(n, (own[:, 0] - lo, own[:, 1]), own[:, 4])
                yield self._frame(run, "interval", interval=np.repeat(np.arange(lo, hi), len(NAMES)), name=np.tile(np.array(NAMES, object), hi - lo), n=n.ravel())


def stream_events(pulses: DataFrame, rules: Rules = Rules(), delay: str = "0 seconds", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Rows of four kinds of a stream pulses(run, ts timestamp, time long ns since the epoch, pmt, area), ts being time's.

    event: start, stop, n_triggers, signals (those whose left_time is in [start, stop]). tally: interval, name (pulses, lone,
    pair), channel a (and b), n. interval: interval, name (pulses, lone, pair, signals, events), n, also for intervals
    without a pulse from the run's first to its last. late: interval, n of rows that came after their bucket was closed, in
    the batch they came in. delay is the watermark's; a stream that ends is flushed by a row of another run far ahead.
    Equal to the batch operators, whatever the micro-batches. kinds: those wanted; work for others is left out. Rows with a null in run, time or pmt are left out; a null
    area counts as 0.
    """
    whole = pulses.filter("run is not null and time is not null and pmt is not null")
    typed = whole.select(F.col("run").cast("long").alias("run"), F.col("ts").cast("timestamp").alias("ts"), *(F.col(c).cast("long").alias(c) for c in ("time", "pmt")), F.coalesce(F.col("area").cast("double"), F.lit(0.0)).alias("area"))
    marked = typed.mapInArrow(_packed(rules.width), _PACKET).withWatermark("ts", delay)
    # Without ts, which Spark's own filter for late rows goes by, so that late rows arrive and are counted.
    rows = marked.drop("ts")
    parts = rows.groupBy("run", "bucket").transformWithStateInPandas(BucketClusters(rules, kinds), PARTS, "Append", "EventTime", eventTimeColumnName="ts")
    parts = parts.withColumn("part", F.when(F.col("kind") == "count", F.col("interval")).otherwise(F.lit(STITCHED)))
    return parts.groupBy("run", "part").transformWithStateInPandas(EventStitcher(rules, kinds), OUTPUT, "Append", "EventTime")
