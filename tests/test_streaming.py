"""The event stream against plain rules and against the batch operators: several runs and buckets, restarts, late rows."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.operators import trigger
from pulsemill.streaming.event_stream import Rules, cluster_bucket, stream_events

RULES = Rules(300_000, 10_000_000, 1_000_000, 2_000_000, 100_000.0, 4, {1: {3: 1.0}, 2: {4: 0.5, 6: 1.0}}, None, 20_000_000, 1_000_000_000)
SCHEMA = "run long, time long, pmt long, area double"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.expr("timestamp_micros(time div 1000)")).coalesce(1)


def run_stream(spark, folder, schema, rules=RULES, delay="0 seconds", name="out", stops=1):
    """All rows the stream gives for the files of a folder, one file a batch; with stops > 1 it is restarted from its checkpoint."""
    out = folder / name
    for _ in range(stops):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
        q = stream_events(stream, rules, delay).writeStream.format("parquet").option("checkpointLocation", str(folder / f"{name}-ck")).trigger(availableNow=True).start(str(out))
        q.awaitTermination()
    return spark.read.parquet(str(out)).collect()


def pulses_of(rng, run, n, start=0):
    t = start + np.cumsum(rng.choice([50_000, 200_000, 299_999, 300_000, 3_000_000, 9_000_000, 200_000_000, 3_100_000_000], n, p=[0.4, 0.2, 0.1, 0.1, 0.12, 0.05, 0.025, 0.005]))
    t[n // 2 :] += 3_500_000_000  # intervals without a pulse
    return [(run, int(x), int(rng.integers(0, 4)), float(rng.integers(1, 9))) for x in t]


def expected(spark, rows):
    """Ranges and signals by the batch operators, tallies by counting."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", pulse_id long")
    signals = trigger.classify_signals(trigger.find_signals(df, RULES.separation), RULES.s1_max_rms, RULES.s2_min_pulses)
    signals = trigger.decide_triggers(signals, RULES.steps)
    ranges = trigger.event_ranges(signals.filter("trigger"), RULES.event_separation, RULES.left_extension, RULES.right_extension)
    held = trigger.signals_in_events(signals.select("left_time", "n_pulses", "type", "trigger"), ranges)
    events = collections.defaultdict(list)
    for r in held.collect():
        events[r["start"], r["stop"], r["n_triggers"]].append((r["left_time"], r["n_pulses"], r["type"], r["trigger"]))
    tally = collections.Counter()
    ordered = sorted((t, p) for _, t, p, _ in rows)
    cluster = []
    for t, p in [*ordered, (1 << 62, 0)]:
        if cluster and t - cluster[-1][0] >= RULES.separation:
            i, channels = cluster[0][0] // RULES.interval, sorted({c for _, c in cluster})
            if len(cluster) == 1:
                tally[i, "lone", channels[0], None] += 1
            elif len(channels) == 2:
                tally[i, "pair", *channels] += 1
            cluster = []
        cluster.append((t, p))
    for t, p in ordered:
        tally[t // RULES.interval, "pulses", p, None] += 1
    return {k: sorted(v) for k, v in events.items()}, tally


def got(out, run):
    events = {(r["start"], r["stop"], r["n_triggers"]): sorted((s["left_time"], s["n_pulses"], s["type"], s["trigger"]) for s in r["signals"]) for r in out if r["run"] == run and r["kind"] == "event"}
    tally = collections.Counter({(r["interval"], r["name"], r["a"], r["b"]): r["n"] for r in out if r["run"] == run and r["kind"] == "tally"})
    return events, tally


def test_stream_equals_batch_for_runs_buckets_and_restarts(spark, tmp_path):
    rng = np.random.default_rng(4)
    runs = {run: pulses_of(rng, run, 700, start) for run, start in ((1, 0), (2, 7_000_000_123), (3, 1_790_000_000_000_000_000))}
    early = sorted(runs[1] + runs[2], key=lambda r: r[1])
    files = [early[i : i + 250] for i in range(0, len(early), 250)] + [runs[3][i : i + 350] for i in (0, 350)]
    for rows in files:  # rows of a file come in no order
        frame(spark, [rows[i] for i in rng.permutation(len(rows))]).write.mode("append").parquet(str(tmp_path / "in"))
    run_stream(spark, tmp_path, frame(spark, files[0]).schema)
    frame(spark, [(9, 1_800_000_000_000_000_000, 0, 1.0)]).write.mode("append").parquet(str(tmp_path / "in"))
    out = run_stream(spark, tmp_path, frame(spark, files[0]).schema)  # goes on where it stopped
    for run, rows in runs.items():
        events, tally = got(out, run)
        want_events, want_tally = expected(spark, rows)
        assert events == want_events and len(events) > 5
        assert tally == want_tally
        totals = {(r["interval"], r["name"]): r["n"] for r in out if r["run"] == run and r["kind"] == "interval"}
        first, last = min(r[1] for r in rows) // RULES.interval, max(r[1] for r in rows) // RULES.interval
        assert sorted({i for i, _ in totals}) == list(range(first, last + 1))
        assert any(totals[i, "pulses"] == 0 for i in range(first, last + 1))
        assert sum(n for (_, name), n in totals.items() if name == "events") == len(events)
    assert not any(r["kind"] == "late" for r in out)


def test_late_rows_are_counted_even_when_nothing_closes(spark, tmp_path):
    late = [(1, 10_000_000, 0, 1.0), (1, 5_010_000_000, 1, 1.0), (2, 10_000_000, 0, 1.0)]
    for rows in ([(1, t, 0, 1.0) for t in (30_000_000, 30_100_000, 50_000_000_000)], [(1, 50_000_100_000, 0, 1.0)], late, late[:1]):
        frame(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
    out = run_stream(spark, tmp_path, frame(spark, late).schema)
    counted = collections.Counter()
    for r in out:
        if r["kind"] == "late":
            counted[r["run"], r["interval"]] += r["n"]
    assert counted == {(1, 0): 2, (1, 5): 1, (2, 0): 1}


def test_rows_within_the_delay_are_used(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = pulses_of(rng, 1, 300)
    jittered = sorted(rows, key=lambda r: r[1] + int(rng.integers(0, 900_000_000)))
    for i in range(0, 300, 60):
        frame(spark, jittered[i : i + 60]).write.mode("append").parquet(str(tmp_path / "in"))
    frame(spark, [(9, 10**15, 0, 1.0), (9, None, 0, 1.0), (None, 5, 0, 1.0)]).write.mode("append").parquet(str(tmp_path / "in"))
    out = run_stream(spark, tmp_path, frame(spark, rows).schema, delay="1 seconds")
    assert got(out, 1) == expected(spark, rows)


def test_clusters_of_a_bucket():
    import pandas as pd

    out = cluster_bucket(pd.DataFrame({"time": [10, 5, 400, 10], "pmt": [2, 1, 3, 2], "area": [1.0, 2.0, 4.0, 8.0]}), 300)
    assert out[["left", "right", "n", "area", "pmts"]].values.tolist() == [[5, 10, 3, 11.0, [1, 2]], [400, 400, 1, 4.0, [3]]]
    assert out["mean"][0] == pytest.approx(10 / 3) and out["m2"][0] == pytest.approx(np.var([0, 5, 5]) * 3)


def test_rules_are_checked():
    for wrong in ({"event_separation": 1}, {"width": 1_500_000, "interval": 1_500_000}, {"interval": 1_500_000_000}, {"separation": 2_000_000_000}):
        with pytest.raises(ValueError):
            Rules(**wrong)


class Handle:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.timers, self.cells = set(), {}

    def _state(self, name, *_):
        return self.cells.setdefault(name, Cell())

    getListState = getValueState = getMapState = _state

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def listTimers(self):
        return iter(sorted(self.timers))


class Cell:
    def __init__(self):
        self.clear()

    def clear(self):
        self.value, self.items, self.map = None, [], {}

    def exists(self):
        return self.value is not None or bool(self.items) or bool(self.map)

    def get(self):
        return self.value if self.value is not None else iter(self.items)

    def update(self, value):
        self.value = value

    def put(self, items):
        self.items = list(items)

    def appendList(self, items):
        self.items += items

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]

    def iterator(self):
        return iter(dict(self.map).items())


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def simulate(batches):
    """The two processors by hand over batches of one run's rows; the watermark follows the newest row of earlier batches."""
    import pandas as pd

    from pulsemill.streaming.event_stream import MS, BucketClusters, EventStitcher

    buckets, out, newest = {}, [], 0
    stitcher, held = EventStitcher(RULES), Handle()
    stitcher.init(held)
    for k, rows in enumerate([*batches, [], []]):
        now = Clock(newest)
        parts = []
        by = collections.defaultdict(list)
        for r in rows:
            by[r[1] // RULES.width].append(r)
        for b, rs in by.items():
            if b not in buckets:
                buckets[b] = BucketClusters(RULES), Handle()
                buckets[b][0].init(buckets[b][1])
            parts += buckets[b][0].handleInputRows((1, b), iter([pd.DataFrame(rs, columns=["run", "time", "pmt", "area"])]), now)
        for b, (processor, handle) in sorted(buckets.items(), reverse=True):
            for timer in [t for t in handle.timers if t < now.now]:
                handle.timers.remove(timer)
                parts += processor.handleExpiredTimer((1, b), now, timer)
        if parts:
            out += stitcher.handleInputRows((1,), iter(parts), now)
        for timer in [t for t in held.timers if t < now.now]:
            held.timers.discard(timer)
            out += stitcher.handleExpiredTimer((1,), now, timer)
        newest = max([newest, *(r[1] // MS for r in rows), 10**12 if k >= len(batches) else 0])
    return [type("R", (dict,), {})(r) for pdf in out for r in pdf.to_dict("records")]


@pytest.mark.parametrize("seed", range(12))
def test_processors_equal_batch_whatever_the_batches(spark, seed):
    rng = np.random.default_rng(seed)
    rows = pulses_of(rng, 1, 400, int(rng.integers(0, 10**10)))
    cuts = sorted(rng.integers(0, 400, rng.integers(0, 40)))
    out = simulate([rows[a:b] for a, b in zip([0, *cuts], [*cuts, 400])])
    assert got(out, 1) == expected(spark, rows)


class Counted(Cell):
    """A state variable that counts the calls and the rows sent, each of which costs Spark a message or a row of the store."""

    traffic = 0

    def __getattribute__(self, name):
        x = super().__getattribute__(name)
        if name in ("put", "appendList"):
            return lambda items: (setattr(Counted, "traffic", Counted.traffic + 1 + len(items)), x(items))[1]
        Counted.traffic += callable(x)
        return x


@pytest.fixture
def counted(monkeypatch):
    monkeypatch.setattr(Handle, "_state", lambda self, name, *_: self.cells.setdefault(name, Counted()))
    for kind in ("getListState", "getValueState", "getMapState"):
        monkeypatch.setattr(Handle, kind, Handle._state)
    Counted.traffic = 0


def test_state_is_not_asked_for_each_channel(counted):
    rows = [(1, b * RULES.width + c * 4_000, c - 1000, 1.0) for b in range(5) for c in range(4000)]
    rows += [(1, 3 * RULES.interval + 7, 2, 1.0), (1, 4 * RULES.interval, -1, 1.0)]
    out = simulate([rows])
    tally = got(out, 1)[1]
    assert {k[2:]: n for k, n in tally.items() if k[:2] == (0, "pulses")} == {(c - 1000, None): 5 for c in range(4000)}
    assert tally[3, "lone", 2, None] == tally[4, "lone", -1, None] == 1
    assert Counted.traffic < 200


def test_state_does_not_grow_with_the_signals_of_an_open_event(counted):
    starts = [k * 9_000_000 for k in range(3000)]  # triggers closer than the event separation: one event, open to the end
    rows = [(1, t + d, d // 20_000, 1.0) for t in starts for d in (0, 20_000, 40_000)]
    cuts = range(0, len(rows), 450)
    out = simulate([rows[i : i + 450] for i in cuts])
    [(event, signals)] = got(out, 1)[0].items()
    assert event == (-1_000_000, starts[-1] + 40_000 + 2_000_000, 3000)
    assert signals == [(t, 3, 1, True) for t in starts]
    assert sum(r["n"] for r in out if r["kind"] == "interval" and r["name"] == "signals") == 3000
    assert Counted.traffic < 12_000  # four calls a bucket, some ten a batch


def test_only_the_wanted_kind_is_built(spark, tmp_path):
    rows = pulses_of(np.random.default_rng(5), 1, 300)
    frame(spark, [*rows, (9, 10**15, 0, 1.0)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame(spark, rows).schema).parquet(str(tmp_path / "in"))
    q = stream_events(stream, RULES, kinds=("interval",)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    out = [r for r in spark.read.parquet(str(tmp_path / "out")).collect() if r["run"] == 1]
    events, tally = expected(spark, rows)
    assert {r["kind"] for r in out} == {"interval"}
    assert sum(r["n"] for r in out if r["name"] == "events") == len(events)
    for name in ("pulses", "lone", "pair"):
        assert {r["interval"]: r["n"] for r in out if r["name"] == name and r["n"]} == dict(sum((collections.Counter({k[0]: n}) for k, n in tally.items() if k[1] == name), collections.Counter()))
