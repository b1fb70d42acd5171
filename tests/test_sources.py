"""Time-range source and binary event files."""

import bz2

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.sources import binary_events as binary
from pulsemill.sources import pulse_ranges as ranges

PULSES = "run long, time long, pmt long, area double"


@pytest.fixture()
def folder(spark, tmp_path):
    ranges.register(spark)
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(1, 3)), int(t), int(rng.integers(0, 5)), float(i)) for i, t in enumerate(rng.integers(-2_000, 10_000, 400))]
    path = str(tmp_path / "pulses")
    ranges.write_pulses(spark.createDataFrame(rows, PULSES), path, 1_000)
    return path, rows


def show(rows):
    return sorted(map(tuple, rows))


def test_ranges_read_only_their_buckets(spark, folder):
    path, rows = folder
    read = lambda **o: spark.read.format("pulse_ranges").options(path=path, **o).load()
    assert show(read().collect()) == show(rows)
    found = read().filter("time >= 2500 and time < 4000 and run = 1")
    assert show(found.collect()) == show(r for r in rows if 2500 <= r[1] < 4000 and r[0] == 1)
    assert found.rdd.getNumPartitions() == 2  # buckets 2 and 3
    assert show(read(start="-1500", stop="500").collect()) == show(r for r in rows if -1500 <= r[1] < 500)
    assert show(read().filter("time = 77 or time > 9000").collect()) == show(r for r in rows if r[1] == 77 or r[1] > 9000)
    assert read().filter("time > 50000").count() == 0 and read().filter("time > 5 and time < 5").count() == 0
    with pytest.raises(Exception, match="bucket"):
        ranges.write_pulses(spark.createDataFrame([(1, None, 1, 1.0)], PULSES), path, 1_000)


def test_bounds_are_taken_from_filters():
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThanOrEqual

    reader = object.__new__(ranges.RangeReader)
    reader.lo, reader.hi, reader.runs = ranges.LOWEST, ranges.HIGHEST, None
    left = list(reader.pushFilters([GreaterThan(("time",), 5), LessThanOrEqual(("time",), 9), EqualTo(("run",), 3), IsNotNull(("time",)), EqualTo(("area",), 1.0)]))
    assert (reader.lo, reader.hi, reader.runs, len(left)) == (6, 10, (3,), 2)
    list(reader.pushFilters([EqualTo(("run",), 4)]))
    assert reader.runs == ()


def test_stream_stays_behind_and_loses_nothing_on_restart(spark, folder, tmp_path):
    path, rows = folder

    def run():
        stream = spark.readStream.format("pulse_ranges").options(path=path, margin=1_500, bucketsPerBatch=2).load()
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).start(str(tmp_path / "out"))
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return show(spark.read.parquet(str(tmp_path / "out")).collect())

    newest = max(r[1] for r in rows)
    until = (newest - 1_500) // 1_000 * 1_000
    assert run() == show(r for r in rows if r[1] < until)
    more = [(1, newest + k, 1, 0.5) for k in (1, 600, 2_400, 2_900, 7_000)]
    ranges.write_pulses(spark.createDataFrame(more, PULSES), path, 1_000)
    until = (newest + 7_000 - 1_500) // 1_000 * 1_000
    assert run() == show(r for r in rows + more if r[1] < until)
    ranges.end_of_run(path)
    assert run() == show(rows + more)
    assert run() == show(rows + more)


def random_events(seed, n=30, first=5):
    rng = np.random.default_rng(seed)
    events = []
    for number in range(first, first + n):
        length = 2 * int(rng.integers(20, 400))
        pulses = []
        for channel in sorted(rng.choice(np.arange(1, 71), rng.integers(0, 6), replace=False).tolist()):
            at = 2 * int(rng.integers(0, 5))
            while at + 2 <= length:
                size = min(2 * int(rng.integers(1, 20)), length - at)
                pulses.append({"channel": channel, "left": at, "data": rng.integers(-(1 << 15), 1 << 15, size).tolist()})
                at += size + 2 * int(rng.integers(0, 30))
        events.append({"dataset": "d", "event_number": number, "start_time": 1_500_000_000_123_456_000 + number, "length": length, "pulses": pulses})
    return events


def plain(events):
    return sorted((e["event_number"], e["start_time"] // 1000, e["length"], tuple((p["channel"], p["left"], tuple(p["data"])) for p in e["pulses"])) for e in events)


def test_binary_events_round_trip(spark, tmp_path):
    binary.register(spark)
    events = random_events(1) + random_events(2, 11, first=100)
    df = spark.createDataFrame([tuple(e[c] for c in ("dataset", "event_number", "start_time", "length", "pulses")) for e in events], binary.SCHEMA)
    path = str(tmp_path / "files")
    write = df.repartitionByRange(3, "event_number").sortWithinPartitions("event_number").write.format("binary_events")
    write.options(path=path, channels=70, eventsPerFile=7).mode("append").save()
    files = sorted(p.name for p in (tmp_path / "files").iterdir())
    assert len(files) >= 7 and not any(f.startswith("_") for f in files)
    read = lambda **o: spark.read.format("binary_events").options(path=path, eventsPerTask=3, **o).load()
    assert plain(r.asDict(True) for r in read().collect()) == plain(events)
    some = read().filter("event_number between 10 and 12 or event_number = 105")
    assert {r["event_number"] for r in some.collect()} == {10, 11, 12, 105}
    one = read().filter("event_number = 20")
    assert plain(r.asDict(True) for r in one.collect()) == plain(e for e in events if e["event_number"] == 20) and one.rdd.getNumPartitions() == 1
    assert read(sampleNs=10).count() == len(events)
    for wrong, message in (({"sampleNs": 20}, "samples of 10 ns"), ({"path": str(tmp_path)}, "no .xed file")):
        with pytest.raises(Exception, match=message):
            spark.read.format("binary_events").options(**{"path": path, **wrong}).load().collect()


def test_control_words_by_hand():
    words = np.array([3, binary.FOLLOWS + 2, 0x00020001, 0x00040003, 1, 2, binary.FOLLOWS + 1, 0xFFFF0005], "<u4")
    got = [(left, data.tolist()) for left, data in binary.decode_channel(words)]
    assert got == [(6, [1, 2, 3, 4]), (16, [5, -1])]
    assert binary.masked_channels(binary.channel_mask([1, 33, 70], 70)) == [1, 33, 70] and len(binary.channel_mask([], 70)) == 12
    for left, data, length in ((1, [1, 2], 8), (0, [1], 8), (0, [], 8), (6, [1, 2, 3, 4], 8)):
        with pytest.raises(ValueError):
            binary.encode_channel([(left, np.array(data))], length)
    with pytest.raises(ValueError):
        binary.encode_channel([(0, np.zeros(4)), (2, np.zeros(2))], 8)


def test_plain_and_raw_chunks_are_read(spark, tmp_path):
    """A file put together by hand: an uncompressed encoded event and one of plain samples of three channels."""
    body = binary.encode_channel([(2, np.array([7, -8]))], 6)
    mask = binary.channel_mask([2], 3)
    raw = np.arange(12, dtype="<i2").reshape(3, 4)
    chunks = [(b"zle0", mask + body, 6), (b"raw0", b"\0" * 4 + raw.tobytes(), 4)]
    events = []
    for number, (kind, data, samples) in enumerate(chunks):
        head = np.zeros(1, binary.EVENT_HEADER)
        for name, value in {"dataset": b"x", "seconds": 3, "microseconds": 5, "event_number": number, "chunks": 1, "type": kind, "size": 28 + len(data), "samples": samples, "frequency": 1e8, "channels": 3}.items():
            head[name] = value
        events.append(head.tobytes() + data)
    top = np.zeros(1, binary.FILE_HEADER)
    top["dataset"], top["n_events"], top["index_size"] = b"x", 2, 4  # room for more events than there are
    places = np.array([80 + 16, 80 + 16 + len(events[0]), 0, 0], "<u4")
    (tmp_path / "a.xed").write_bytes(top.tobytes() + places.tobytes() + b"".join(events))
    binary.register(spark)
    got = plain(r.asDict(True) for r in spark.read.format("binary_events").option("path", str(tmp_path)).load().collect())
    assert got == [(0, 3_000_005, 6, ((2, 2, (7, -8)),)), (1, 3_000_005, 4, ((1, 0, (0, 1, 2, 3)), (2, 0, (4, 5, 6, 7)), (3, 0, (8, 9, 10, 11))))]
    assert bz2.decompress(binary.encode_event({"dataset": "x", "event_number": 0, "start_time": 0, "length": 6, "pulses": [{"channel": 2, "left": 2, "data": [7, -8]}]}, 3, 10, 2.25, 14)[108 + 4 :]) == body
