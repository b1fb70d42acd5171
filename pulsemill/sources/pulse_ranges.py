"""Pulses by time: a folder of Parquet files in buckets of time, read by range or as a stream that stays behind the newest pulse.

    register(spark)
    spark.read.format("pulse_ranges").option("path", p).load().filter("time >= 10 and time < 20")
    spark.readStream.format("pulse_ranges").option("path", p).option("margin", 60 * 10**9).load()

A task reads one bucket. Bounds on time and equalities on run, in filters or as options, select buckets and rows inside the
source. The stream's offset is a time: rows before it are read. It
moves bucket by bucket, never into the last `margin` ns before the newest pulse, where writers may still add some; when the
folder holds a file _ENDED, it goes to the end. A restarted stream goes on at its checkpoint's offset.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.islands import bucket_of

SCHEMA = "run long, time long, pmt long, area double"
_ARROW = pa.schema([("run", pa.int64()), ("time", pa.int64()), ("pmt", pa.int64()), ("area", pa.float64())])
LAYOUT, ENDED = "_LAYOUT", "_ENDED"
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def register(spark: SparkSession) -> None:
    """Make the source known to the session and let Python sources take filters; Spark refuses readers that would otherwise."""
    spark.dataSource.register(PulseRanges)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pulses(pulses: DataFrame, path: str, width: int, mode: str = "append") -> None:
    """Write pulses(run, time, pmt, area) in buckets of `width` ns. Rows without a time have no bucket and are refused."""
    columns = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    named = pulses.select(*(F.col(c).cast(t).alias(c) for c, t in (x.split(" ") for x in SCHEMA.split(", "))))
    bucket = F.when(F.col("time").isNull(), F.raise_error(F.lit("a pulse without a time has no bucket"))).otherwise(bucket_of("time", width))
    # One file a bucket and task at most: rows of a bucket are dealt to one task unless AQE splits it for its size.
    named.select(*columns, bucket.alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "time").write.mode(mode).partitionBy("bucket").parquet(path)
    store, root = _store(path)
    with store.open_output_stream(f"{root}/{LAYOUT}") as out:
        out.write(json.dumps({"width": width}).encode())


def end_of_run(path: str) -> None:
    """Mark that no more pulses come, so that streams read to the end."""
    store, root = _store(path)
    with store.open_output_stream(f"{root}/{ENDED}") as out:
        out.write(b"")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store, root.rstrip("/")


class Bucket(InputPartition):
    def __init__(self, number: int, files: list[str], lo: int, hi: int, runs: tuple[int, ...] | None):
        self.number, self.files, self.lo, self.hi, self.runs = number, files, lo, hi, runs


class _Folder:
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("pulse_ranges needs the option path")
        self.path = options["path"]
        self.lo, self.hi = int(options.get("start", LOWEST)), int(options.get("stop", HIGHEST))
        self.runs: tuple[int, ...] | None = None
        self.store, self.root = _store(self.path)
        self.width = self._width()

    def _width(self) -> int:
        with self.store.open_input_stream(f"{self.root}/{LAYOUT}") as f:
            return int(json.loads(f.read())["width"])

    def buckets(self) -> list[int]:
        found = self.store.get_file_info(fs.FileSelector(self.root))
        return sorted(int(x.base_name.removeprefix("bucket=")) for x in found if x.type == fs.FileType.Directory and x.base_name.startswith("bucket="))

    def files(self, bucket: int) -> list[str]:
        found = self.store.get_file_info(fs.FileSelector(f"{self.root}/bucket={bucket}"))
        return sorted(x.path for x in found if x.base_name.endswith(".parquet") and x.base_name[0] not in "._")

    def overlapping(self, lo: int, hi: int) -> list[Bucket]:
        """The buckets with times in [lo, hi)."""
        return [Bucket(b, self.files(b), lo, hi, self.runs) for b in self.buckets() if b * self.width < hi and (b + 1) * self.width > lo]

    def newest(self) -> int | None:
        """The last time in the folder, by the statistics of the last bucket's files."""
        for b in reversed(self.buckets()):
            tops = []
            for path in self.files(b):
                meta = pq.ParquetFile(path, filesystem=self.store).metadata
                at = meta.schema.names.index("time")
                tops += [meta.row_group(g).column(at).statistics.max for g in range(meta.num_row_groups) if meta.row_group(g).num_rows]
            if tops:
                return max(tops)
        return None

    def read(self, part: Bucket) -> Iterator[pa.RecordBatch]:
        for path in part.files:
            for batch in pq.ParquetFile(path, filesystem=self.store).iter_batches(columns=_ARROW.names):
                keep = pc.and_(pc.greater_equal(batch["time"], part.lo), pc.less(batch["time"], part.hi))
                if part.runs is not None:
                    keep = pc.and_(keep, pc.is_in(batch["run"], pa.array(part.runs, pa.int64())))
                rows = batch.filter(keep)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([rows[c].cast(_ARROW.field(c).type) for c in _ARROW.names], schema=_ARROW)


class RangeReader(_Folder, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take bounds on time and one run; what is left is Spark's to check."""
        for f in filters:
            if f.attribute == ("time",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.lo = max(self.lo, f.value + isinstance(f, GreaterThan))
            elif f.attribute == ("time",) and isinstance(f, (LessThan, LessThanOrEqual)):
                self.hi = min(self.hi, f.value + isinstance(f, LessThanOrEqual))
            elif f.attribute == ("time",) and isinstance(f, EqualTo):
                self.lo, self.hi = max(self.lo, f.value), min(self.hi, f.value + 1)
            elif f.attribute == ("run",) and isinstance(f, EqualTo):
                self.runs = (f.value,) if self.runs in (None, (f.value,)) else ()
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return self.overlapping(self.lo, self.hi) or [Bucket(0, [], 0, 0, None)]


class RangeStream(_Folder, DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options.get("path")
        super().__init__(options)
        self.margin = int(options.get("margin", 0))
        self.most = int(options.get("bucketsperbatch", 0))
        self.reached: int | None = None

    def initialOffset(self) -> dict:
        first = self.buckets()
        return {"time": max(self.lo, first[0] * self.width) if first else self.lo}

    def latestOffset(self) -> dict:
        newest = self.newest()
        done = self.reached if self.reached is not None else self.initialOffset()["time"]
        if newest is None:
            return {"time": done}
        ended = self.store.get_file_info(f"{self.root}/{ENDED}").type == fs.FileType.File
        until = newest + 1 if ended else (newest - self.margin) // self.width * self.width
        if self.most and self.reached is not None:  # the first call of a (re)start doesn't know what was read
            until = min(until, (done // self.width + self.most) * self.width)
        self.reached = max(done, min(until, self.hi))
        return {"time": self.reached}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.reached = max(self.reached or end["time"], end["time"])
        return self.overlapping(start["time"], end["time"]) or [Bucket(0, [], 0, 0, None)]

    def commit(self, end: dict) -> None:
        self.reached = max(self.reached or end["time"], end["time"])


class PulseRanges(DataSource):
    """See the module. Options: path, start and stop (a range of time), margin and bucketsPerBatch (of a stream)."""

    @classmethod
    def name(cls) -> str:
        return "pulse_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RangeReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RangeStream(self.options)
