"""Periodic runs of words: stretches that repeat themselves three times or more, found by block matching.

Words of a document are numbered. At each scale the document is cut into aligned blocks of a power of two of words; the
blocks are keys (sequences of integers) of a pyahocorasick automaton that reads the whole document. A run of smallest period
q and length 3 q or more holds an aligned block of at most q words that is found again q words later, so a scale looks at
occurrences at distances from its block's length up to the next scale's. Each such pair is a seed that is extended exactly,
to the left and to the right, as long as words at that distance agree.

A run's words are found three times or more in the document, so a block with a rarer word can't lie in a run and is no key.
"""

from __future__ import annotations

import functools
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_slices, words

#: Words of a run at least, and repetitions at least.
LEAST, TIMES = 24, 3
SPACES = r"[\x20\x09-\x0D]+"


def _stretches(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Bounds of the stretches of true values of `least` or more."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [(a, b) for a, b in edge.reshape(-1, 2).tolist() if b - a >= least]


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """The number of leading places at which x and y are equal, looking at no more than twice as many (and 64)."""
    done, size = 0, 64
    while done < len(x):
        differs = x[done : done + size] != y[done : done + size]
        if differs.any():
            return done + int(differs.argmax())
        done, size = done + size, 2 * size
    return len(x)


def extend(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Bounds of the stretch around ids[at : at + period + 1] that no neighbour extends with this period; ids[at] = ids[at + period]."""
    right = _agree(ids[at:-period], ids[at + period :])
    left = _agree(ids[:at][::-1], ids[period : at + period][::-1])
    return at - left, at + right + period


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _seeds(ids: np.ndarray, common: list[tuple[int, int]], size: int, lo: int, hi: int):
    """(block start, distance) for aligned blocks of `size` words in the stretches `common` that recur at a distance in [lo, hi)."""
    of: dict[tuple, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    content = np.full(len(ids) // size + 1, -1)  # of each aligned block
    for a, b in common:
        for start in range(-(-a // size) * size, b - size + 1, size):
            key = tuple(ids[start : start + size].tolist())
            number = of.setdefault(key, len(of))
            if number == len(of) - 1:
                automaton.add_word(key, number)
            content[start // size] = number
    if not of:
        return
    automaton.make_automaton()
    found = [(a + end, number) for a, b in common for end, number in automaton.iter(tuple(ids[a:b].tolist()))]
    starts, numbers = np.array([e for e, _ in found]) - size + 1, np.array([n for _, n in found])
    # Aligned blocks before an occurrence whose distances are in the range.
    for back in range((hi - 1) // size + 1):
        block = starts // size - back
        distance = starts - block * size
        hit = (block >= 0) & (distance >= lo) & (distance < hi)
        hit[hit] = content[block[hit]] == numbers[hit]
        order = np.lexsort((block[hit], distance[hit]))
        yield from zip((block[hit][order] * size).tolist(), distance[hit][order].tolist())


def find_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all stretches with smallest period q and length >= max(least, times * q) that no neighbour extends, by start, then period."""
    if times < 3 or least < 3:
        raise ValueError("block matching needs three repetitions and three words at least")
    counts = np.bincount(ids)
    often = counts[ids] >= times
    runs: set[tuple[int, int, int]] = set()
    # A run holds `length - q` >= 2/3 * least starts of blocks that recur, so an aligned block of this many words is among them.
    size = 1 << (((2 * least // 3 + 1) // 2).bit_length() - 1)
    lo = 1
    while lo * times <= len(ids):
        common = _stretches(often, max(least, times * lo))
        if not common:
            break
        # For each end of a run that reaches furthest: a seed within a run whose period divides its distance finds nothing new.
        ordered = sorted((a, a + n, q) for a, n, q in runs)
        begins = np.array([a for a, _, _ in ordered])
        furthest = np.maximum.accumulate([b for _, b, _ in ordered]) if ordered else begins
        at_furthest = {b: (a, q) for a, b, q in reversed(ordered)}
        seen: dict[int, int] = {}
        for at, d in _seeds(ids, common, size, lo, 2 * size):
            if seen.get(d, -1) >= at + size + d:
                continue
            i = int(np.searchsorted(begins, at, "right")) - 1 if ordered else -1
            if i >= 0:
                begin, q = at_furthest[int(furthest[i])]
                if furthest[i] >= at + size + d and d % q == 0 and begin <= at:
                    continue
            start, stop = extend(ids, at, d)
            seen[d] = max(seen.get(d, -1), stop)
            if stop - start >= max(least, times * d) and not any(np.array_equal(ids[start : stop - d // p], ids[start + d // p : stop]) for p in _primes(d)):
                runs.add((start, stop - start, d))
        lo, size = 2 * size, 2 * size
    return sorted(runs, key=lambda r: (r[0], r[2]))


def text_runs(text: str | None, least: int = LEAST, times: int = TIMES) -> tuple[int, list[tuple[int, int, int]], str]:
    """Number of words, runs, and the text with the first period of each run kept, words joined by one space."""
    cut = words(text, lower=False)
    if len(cut) < least or max(Counter(cut).values()) < times:
        return len(cut), [], b" ".join(cut).decode("utf-8", "surrogatepass")
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in cut])
    runs = find_runs(ids, least, times)
    drop = np.zeros(len(cut) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist() if runs else range(len(cut))
    return len(cut), runs, b" ".join([cut[i] for i in kept]).decode("utf-8", "surrogatepass")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _read(batches, least: int, times: int):
    for part in arrow_slices(batches):
        found = [text_runs(t, least, times) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for _, runs, _ in found], _RUNS),
                pa.array([c for _, _, c in found], pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed for every row of docs(doc_id, text).

    collapsed is the text without the words that a run holds after its first period, words joined by one space. Words are
    compared whole and case-sensitively. A null text is an empty one: no words, no runs, an empty collapsed text. Repeated
    rows and null doc_ids are rows like any other. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(functools.partial(_read, least=least, times=times), _SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) with a repetition of chosen start and period in the words of one doc_id in ten (the query's fold; a null id has none)."""
    docs = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    n, a = "size(x.w)", "cast(x.g % size(x.w) as int)"
    p = f"cast(1 + ({n} - {a}) div (3 + x.g % 8) as int)"
    repeated = f"array_join(concat(slice(x.w, 1, {a}), transform(sequence({a}, {n} - 1), i -> x.w[{a} + (i - {a}) % ({p})])), ' ')"
    # One struct in an array binds the words, so they are cut once.
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    docs = docs.withColumn("_x", F.when((F.col("_h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.array(F.struct(words.alias("w"), F.expr("_h div 10").alias("g")))))
    return docs.withColumn("text", F.coalesce(F.expr(f"transform(_x, x -> {repeated})[0]"), F.col("text").cast("string"))).drop("_h", "_x")


def run_digests(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the run of greatest length / period (null without runs), runs_sha256, collapsed_sha256."""
    found = periodic_runs(docs, least, times)
    better = "(best is null or r.length * best.period > best.length * r.period or (r.length * best.period = best.length * r.period and (r.start < best.start or (r.start = best.start and r.period < best.period))))"
    best = F.expr(f"aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, r) -> case when {better} then r else best end)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
