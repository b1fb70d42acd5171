"""Binary event files: an index of events, each with a header, a mask of its channels and zero-length-encoded samples.

    register(spark)
    spark.read.format("binary_events").option("path", folder).load()
    df.write.format("binary_events").option("path", folder).mode("append").save()

A row is an event: dataset, event_number, start_time (ns), length (samples), pulses (channel, left, data). A file is read by
ranges of its index, one range a task. A channel's samples are control words with runs of sample pairs to skip and runs that
follow; they are walked by word, and samples are taken and laid down as whole arrays. Chunks of uncompressed or bzip2 data and
of plain samples (one pulse a channel) are read; zero-length-encoded bzip2 chunks are written.
"""

from __future__ import annotations

import bz2
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from .pulse_ranges import _store

SCHEMA = "dataset string, event_number long, start_time long, length int, pulses array<struct<channel: int, left: int, data: array<short>>>"
# Fixed values of the format: little-endian headers of 80 and 108 bytes, sizes of headers, chunk types, and the bit that marks samples.
FILE_HEADER = np.dtype([("dataset", "S64"), ("creation_time", "<u4"), ("first_event", "<u4"), ("n_events", "<u4"), ("index_size", "<u4")])
EVENT_HEADER = np.dtype([("dataset", "S64"), ("seconds", "<u4"), ("microseconds", "<u4"), ("event_number", "<u4"), ("chunks", "<u4"), ("type", "S4"), ("size", "<u4"), ("precision", "<i2"), ("flags", "<u2"), ("samples", "<u4"), ("volts", "<f4"), ("frequency", "<f4"), ("channels", "<u4")])
CHUNK_HEADER = 28
RAW, ENCODED = b"raw0", b"zle0"
FOLLOWS = 1 << 31
FIRST_CHANNEL = 1


def register(spark: SparkSession) -> None:
    """Make the source known to the session and let Python sources take filters."""
    spark.dataSource.register(BinaryEvents)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def channel_mask(channels: list[int], n_channels: int) -> bytes:
    """One bit for each channel from FIRST_CHANNEL on, in whole words of 32 bits, the last channel first."""
    bits = np.zeros(32 * -(-n_channels // 32), np.uint8)
    bits[[c - FIRST_CHANNEL for c in channels]] = 1
    return np.packbits(bits[::-1]).tobytes()


def masked_channels(mask: bytes) -> list[int]:
    return (np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8))[::-1]) + FIRST_CHANNEL).tolist()


def encode_channel(pulses: list[tuple[int, np.ndarray]], length: int) -> bytes:
    """Size word, then control words and samples of the pulses (left, samples) of one channel, in order of time."""
    out, at = [], 0
    for left, data in sorted(pulses, key=lambda p: p[0]):
        if left < at or left % 2 or len(data) % 2 or not len(data) or left + len(data) > length:
            raise ValueError("pulses of a channel must not overlap, lie in the event, start at even samples and have even lengths")
        if left > at:
            out.append(np.array([(left - at) // 2], "<u4").tobytes())
        out += [np.array([FOLLOWS + len(data) // 2], "<u4").tobytes(), np.asarray(data).astype("<i2").tobytes()]
        at = left + len(data)
    if at < length:
        out.append(np.array([(length - at) // 2], "<u4").tobytes())
    body = b"".join(out)
    return np.array([1 + len(body) // 4], "<u4").tobytes() + body


def decode_channel(words: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Pulses (left, samples) of one channel's words (32 bits each, without the size word)."""
    samples = words.view("<i2")
    out, i, at = [], 0, 0
    while i < len(words):
        word = int(words[i])
        if word < FOLLOWS:
            at += 2 * word
            i += 1
        else:
            n = word - FOLLOWS
            out.append((at, samples[2 * (i + 1) : 2 * (i + 1 + n)]))
            at += 2 * n
            i += 1 + n
    return out


def encode_event(event: dict, n_channels: int, sample_ns: int, volts: float, bits: int) -> bytes:
    by: dict[int, list] = {}
    for p in event["pulses"] or []:
        by.setdefault(int(p["channel"]), []).append((int(p["left"]), np.asarray(p["data"], "<i2")))
    if by and not (FIRST_CHANNEL <= min(by) and max(by) < FIRST_CHANNEL + n_channels):
        raise ValueError(f"channels must be from {FIRST_CHANNEL} to {n_channels}")
    length, mask = int(event["length"]), channel_mask(sorted(by), n_channels)
    if length % 2:
        raise ValueError("an event has an even number of samples")
    data = bz2.compress(b"".join(encode_channel(by[c], length) for c in sorted(by)))
    head = np.zeros(1, EVENT_HEADER)
    start = int(event["start_time"])
    values = (str(event["dataset"] or "").encode(), start // 10**9, start % 10**9 // 1000, event["event_number"], 1, ENCODED, CHUNK_HEADER + len(mask) + len(data), bits, 2, length, volts, 1e9 / sample_ns, n_channels)
    for name, value in zip(EVENT_HEADER.names, values):
        head[name] = value
    return head.tobytes() + mask + data


def decode_event(f, sample_ns: int | None = None) -> dict:
    """The event at the file's position."""
    head = np.frombuffer(f.read(EVENT_HEADER.itemsize), EVENT_HEADER)[0]
    if head["chunks"] != 1:
        raise ValueError(f"event {head['event_number']} has {head['chunks']} chunks; one is supported")
    if sample_ns is not None and round(1e9 / float(head["frequency"])) != sample_ns:
        raise ValueError(f"event {head['event_number']} has samples of {1e9 / float(head['frequency']):g} ns, not {sample_ns}")
    n_channels, n = int(head["channels"]), int(head["samples"])
    pulses = []
    if head["type"] == RAW:
        f.read(4)
        data = np.frombuffer(f.read(2 * n_channels * n), "<i2").reshape(n_channels, n)
        pulses = [(c + FIRST_CHANNEL, 0, w) for c, w in enumerate(data)]
    elif head["type"] == ENCODED:
        mask = f.read(4 * -(-n_channels // 32))
        data = f.read(int(head["size"]) - CHUNK_HEADER - len(mask))
        try:
            data = bz2.decompress(data)
        except OSError:  # chunks may be stored plain
            pass
        words, at = np.frombuffer(data, "<u4"), 0
        for channel in masked_channels(mask):
            size = int(words[at])
            pulses += [(channel, left, w) for left, w in decode_channel(words[at + 1 : at + size])]
            at += size
    else:
        raise ValueError(f"chunk type {head['type']!r} is not supported")
    start = int(head["seconds"]) * 10**9 + int(head["microseconds"]) * 1000
    return {"dataset": head["dataset"].decode(), "event_number": int(head["event_number"]), "start_time": start, "length": n, "pulses": [{"channel": c, "left": left, "data": w} for c, left, w in pulses]}


_TYPES = pa.schema([("dataset", pa.string()), ("event_number", pa.int64()), ("start_time", pa.int64()), ("length", pa.int32()), ("pulses", pa.list_(pa.struct([("channel", pa.int32()), ("left", pa.int32()), ("data", pa.list_(pa.int16()))])))])


def _index(f) -> tuple[np.void, np.ndarray]:
    """File header and places of the events. The last file of a run may have room for more events than it holds."""
    head = np.frombuffer(f.read(FILE_HEADER.itemsize), FILE_HEADER)[0]
    places = np.frombuffer(f.read(4 * int(head["index_size"])), "<u4")
    return head, places[: int(head["n_events"])]


class Slice(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class BinaryReader(DataSourceReader):
    """Options: path (a file or a folder of .xed files), eventsPerTask (256), sampleNs (checked if given)."""

    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("binary_events needs the option path")
        self.path, self.each = options["path"], int(options.get("eventspertask", 256))
        self.sample_ns = int(options["samplens"]) if "samplens" in options else None
        self.lo, self.hi = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds on event_number choose files and places in their index."""
        for f in filters:
            if f.attribute != ("event_number",):
                yield f
            elif isinstance(f, EqualTo):
                self.lo, self.hi = max(self.lo, f.value), min(self.hi, f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.lo = max(self.lo, f.value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.hi = min(self.hi, f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        if store.get_file_info(root).type == fs.FileType.File:
            files = [root]
        else:
            files = sorted(x.path for x in store.get_file_info(fs.FileSelector(root)) if x.base_name.endswith(".xed") and x.base_name[0] not in "._")
        if not files:
            raise ValueError(f"no .xed file in {self.path}")
        out = []
        for path in files:
            with store.open_input_stream(path) as f:
                head = np.frombuffer(f.read(FILE_HEADER.itemsize), FILE_HEADER)[0]
            first, n = int(head["first_event"]), int(head["n_events"])  # a file's numbers follow each other
            lo, hi = max(0, self.lo - first), min(n, self.hi - first + 1)
            out += [Slice(path, a, min(a + self.each, hi)) for a in range(lo, hi, self.each)]
        return out or [Slice("", 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        if part.first >= part.last:
            return
        store, _ = _store(self.path)
        with store.open_input_file(part.path) as f:
            _, places = _index(f)
            for i in range(part.first, part.last):
                f.seek(int(places[i]))
                yield pa.RecordBatch.from_pylist([decode_event(f, self.sample_ns)], schema=_TYPES)
                if i + 1 < len(places) and f.tell() != int(places[i + 1]):
                    raise ValueError(f"{part.path}: event {i} ends at {f.tell()}, the next begins at {int(places[i + 1])}")


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class BinaryWriter(DataSourceArrowWriter):
    """Options: path, eventsPerFile (1000), channels (254), sampleNs (10), volts (2.25), bits (14). Files get their names when all tasks are done."""

    def __init__(self, options: dict):
        self.path, self.each = options["path"], int(options.get("eventsperfile", 1000))
        self.layout = int(options.get("channels", 254)), int(options.get("samplens", 10)), float(options.get("volts", 2.25)), int(options.get("bits", 14))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, str]] = []
        held: list[bytes] = []
        first, dataset = 0, ""

        def roll():
            if not held:
                return
            head = np.zeros(1, FILE_HEADER)
            for name, value in zip(FILE_HEADER.names, (dataset.encode(), int(time.time()), first, len(held), len(held))):
                head[name] = value
            places = FILE_HEADER.itemsize + 4 * len(held) + np.concatenate([[0], np.cumsum([len(e) for e in held])[:-1]])
            temporary = f"{root}/_{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                out.write(head.tobytes() + places.astype("<u4").tobytes() + b"".join(held))
            done.append((temporary, f"{root}/{first:09d}-{first + len(held) - 1:09d}-{uuid.uuid4().hex[:8]}.xed"))
            held.clear()

        for batch in iterator:
            for event in batch.to_pylist():
                number = int(event["event_number"])
                if held and (len(held) >= self.each or number != first + len(held)):
                    roll()
                if not held:
                    first, dataset = number, str(event["dataset"] or "")
                held.append(encode_event(event, *self.layout))
        roll()
        return Written(done)

    def commit(self, messages: list[Written]) -> None:
        store, _ = _store(self.path)
        for m in messages:
            for temporary, final in m.files if m else []:
                store.move(temporary, final)

    def abort(self, messages: list[Written]) -> None:
        store, _ = _store(self.path)
        for m in messages:
            for temporary, _ in m.files if m else []:
                store.delete_file(temporary)


class BinaryEvents(DataSource):
    """See the module. Write rows sorted by event_number within partitions: a file holds numbers that follow each other."""

    @classmethod
    def name(cls) -> str:
        return "binary_events"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BinaryReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BinaryWriter(self.options)
