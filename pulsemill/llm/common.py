"""Helpers shared by the corpus operators: words, 64-bit hashes, lineage cuts and size checks."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words, for use in SQL patterns and translate().
SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit. One to one."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def words(text: str | None, lower: bool) -> list[bytes]:
    """Words of a text as UTF-8. bytes.lower() changes A-Z only; bytes.split() splits on the six characters of SPACE."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[*SPACE.encode()]] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Characters of text whose words are worked on at once, so arrays over words stay small.
CHARS = 1_000_000
#: Words longer than this are hashed one by one.
LONG_WORD = 64


def flat(texts) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of texts (an Arrow array or an iterable) end to end, and the offsets between them. A null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        return data, offsets - offsets[0]
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of all words of texts that lie end to end, and the number of words of each text."""
    space = _IS_SPACE[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts, stops = np.nonzero(before & ~space)[0], np.nonzero(after & ~space)[0] + 1
    return starts, stops, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word: its bytes are mixed in eight at a time, so words of up to eight bytes of one length never meet.

    The few words over LONG_WORD bytes are hashed by BLAKE2.
    """
    size = stops - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", buffer=padded, strides=(1,))
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    out = mix(size.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1)))
    at = np.nonzero(size <= LONG_WORD)[0]
    for done in range(0, LONG_WORD, 8):
        if done:
            at = at[size[at] > done]
        if not len(at):
            break
        out[at] = mix(out[at] ^ (eight[starts[at] + done] & masks[np.minimum(size[at] - done, 8)]))
    for i in np.nonzero(size > LONG_WORD)[0]:
        word = hashlib.blake2b(data[starts[i] : stops[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(word.digest(), "little")
    return out


def token_hashes(texts, lower: bool, seed: int = 0) -> list[np.ndarray]:
    """The word hashes of each text, by array operations. A null text has none. Seeds give independent hashes."""
    data, offsets = flat(texts)
    if len(offsets) < 2:
        return []
    data = _LOWER[data] if lower else data
    starts, stops, counts = word_bounds(data, offsets)
    return np.split(word_hashes(data, starts, stops, seed), np.cumsum(counts)[:-1])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + mix(b + np.uint64(0x51ED270B2E0DF6A1)))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes: runs are put together of two of half the length (overlapping where n is no power of two)."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    size = 1
    while 2 * size <= n:
        h, size = _pair(h[:-size], h[size:]), 2 * size
    if size < n:
        h = _pair(h[:count], h[n - size :])
    return mix(h + np.uint64(n))


def _edges(lengths: np.ndarray, chars: int) -> np.ndarray:
    size = np.cumsum(lengths) // chars
    return np.concatenate([[0], np.nonzero(np.diff(size))[0] + 1, [len(lengths)]])


def slices(pdf, chars: int = CHARS):
    """A batch with a column text, in slices of about so many characters, so arrays over words stay small."""
    edges = _edges(pdf["text"].str.len().fillna(0).to_numpy(np.int64), chars)
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > lo:
            yield pdf.iloc[lo:hi]


def arrow_slices(batches, chars: int = CHARS):
    """Arrow batches with a column text, in slices of about so many bytes; nothing is copied."""
    for batch in batches:
        if not len(batch):
            continue
        edges = _edges(np.diff(flat(batch.column("text"))[1]), chars)
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def cut(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and go on from the files, so lost executors cost no recomputation.

    Read back, a table has the size of its files; checkpoint() would carry the planner's estimate along, which multiplies in
    loops of joins until the number itself fills the driver. narrow: its rows are a few numbers (ids, labels, counts) and
    come out of a shuffle, so a sixteenth of the tasks that texts need will do; the stage before the shuffle keeps all its
    tasks. Without a shared folder only a local master is served, from a temporary folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if narrow:
        df = df.coalesce(max(6, shuffle_parts(spark) // 16))
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    path = f"{sc.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_parts(texts: DataFrame, bytes_each: int, least: int) -> int:
    """Parts of about bytes_each bytes of the column text, counted; `least` at least."""
    return max(least, (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bytes_each)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit_mb: int = 48, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if its counted rows fit the limit; otherwise unchanged, for a shuffled join."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= limit_mb << 20 else df


def skew_join(left: DataFrame, right: DataFrame, on: list[str], rows: str) -> DataFrame:
    """Left join with right, which has one row a key and the number of left's rows with it in the column `rows`.

    A key with more rows than a quarter of a partition's share goes by broadcast: there are fewer than four times as many
    such keys as partitions, so their rows of a few numbers are bounded. The other keys are shuffled.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    room = total // (4 * shuffle_parts(left.sparkSession)) + 1
    hot = F.broadcast(right.filter(F.col(rows) > room))
    return left.join(hot, on).unionByName(left.join(hot.select(*on), on, "left_anti").join(right.filter(F.col(rows) <= room), on, "left"))


def let(value, body):
    """Bind a column once and use it many times in body, without evaluating it again for each use."""
    return F.transform(F.array(value), body)[0]
