"""SimHash near-duplicate groups: fingerprints of 64 bits, linked at a Hamming distance of 2 or less.

A fingerprint is embedded as the bit counts of 32 segments of two bits. The Manhattan distance of two embeddings is at most
the Hamming distance of the fingerprints, so links lie within Manhattan distance 2; then the counts of the first or of the
last 16 segments lie within distance 1. Each half is a grid whose cells are its counts: a fingerprint meets those of its
cell and of the cells one step up, pairs are held to distance 2 over all segments, and the rest is verified by the bits.

Counts are kept in a unary code (0: 00, 1: 01, 2: 11), so that Manhattan distances are differing bits of the codes.

A cell with many fingerprints would pair them all. Those, and the fingerprints of the cells beside it, are linked through
the 64-bit values at one bit from them instead: two fingerprints lie within distance 2 if and only if they share such a
value (or are one themselves), and at most 65 fingerprints share one.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_slices, broadcast_if_small, cut, skew_join
from .near_dedup import components

BITS = 64
SEED = 42
#: The lower bit of each segment of two.
LOWER = 0x5555555555555555
#: Fingerprints of a cell that meet each other as pairs.
CELL = 512
#: Shingles whose bits are unpacked at once.
SHINGLES = 1 << 18


def fingerprint(text: str | None, shingle: int, seed: int = SEED) -> int:
    """Bits that are set in over half of the XXH64 hashes of a text's word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    bounds = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in bounds), np.uint64, len(words) - n + 1)
    counts = sum(np.unpackbits(hashes[i : i + SHINGLES].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), SHINGLES))
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _prints(batches, shingle: int):
    for part in arrow_slices(batches):
        prints = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])


def embedding(bits: Column) -> Column:
    """The bit counts of 32 segments of two bits, each in unary in its own two bits."""
    lower, upper = bits.bitwiseAND(F.lit(LOWER)), F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(LOWER))
    return lower.bitwiseOR(upper).bitwiseOR(F.shiftleft(lower.bitwiseAND(upper), 1))


def grid_cells(prints: DataFrame) -> DataFrame:
    """print, code, half, cell of prints(print): a row for each half of the embedding."""
    code = embedding(F.col("print"))
    halves = F.array(F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("code", 32).alias("cell")), F.struct(F.lit(1).alias("half"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("cell")))
    return prints.select("print", code.alias("code")).select("print", "code", F.inline(halves))


def _steps(up: bool) -> Column:
    """The cells one step up (or down) from the column cell: one of its 16 counts is greater (less) by one."""
    count = "((cell >> (2 * i)) & 3)"
    step = f"case {count} when 0 then cell + (1L << (2 * i)) when 1 then cell + (2L << (2 * i)) end" if up else f"case {count} when 1 then cell - (1L << (2 * i)) when 3 then cell - (2L << (2 * i)) end"
    return F.expr(f"filter(transform(sequence(0, 15), i -> {step}), x -> x is not null)")


def close_pairs(prints: DataFrame, radius: int = 2, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of prints(print) whose components are those of all pairs within two bits.

    All edges are pairs within two bits; of crowded cells (more than `cell` fingerprints) only a star for each shared value.
    """
    if radius != 2:
        raise ValueError("halves of the grid meet within one step, which holds for a radius of 2")
    cells = cut(grid_cells(prints))
    crowded = cut(cells.groupBy("half", "cell").count().filter(F.col("count") > cell).select("half", "cell"), narrow=True)
    n_crowded = crowded.count()
    # Crowded cells are at most 2 / cell of the fingerprints; the table is broadcast while it is small.
    crowd = broadcast_if_small(crowded, 40, rows=n_crowded)
    beside = crowded.select("half", F.explode(F.concat(F.array("cell"), _steps(True), _steps(False))).alias("cell")).distinct()
    quiet = cells.join(crowd, ["half", "cell"], "left_anti") if n_crowded else cells
    near = F.expr("bit_count(code_a ^ code_b) <= 2 and bit_count(a ^ b) <= 2")
    a = quiet.select(F.col("print").alias("a"), F.col("code").alias("code_a"), "half", F.explode(F.concat(F.array("cell"), _steps(True))).alias("cell"), F.col("cell").alias("own"))
    b = quiet.select(F.col("print").alias("b"), F.col("code").alias("code_b"), "half", "cell")
    met = a.join(b, (a["half"] == b["half"]) & (a["cell"] == b["cell"]) & near & ((F.col("own") != b["cell"]) | (F.col("a") < F.col("b"))))
    edges = met.select("a", "b")
    if n_crowded:
        shared = F.concat(F.array("print"), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("print").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
        around = cells.join(broadcast_if_small(beside, 40), ["half", "cell"], "left_semi").select("print").distinct()
        met = around.select("print", F.explode(shared).alias("value")).groupBy("value").agg(F.collect_list("print").alias("prints"))  # at most 65
        star = met.filter(F.size("prints") > 1).select(F.array_min("prints").alias("a"), F.explode("prints").alias("b")).filter("a <> b")
        edges = edges.union(star)
    return edges.distinct()


def simhash_groups(docs: DataFrame, shingle: int = 5, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable, itself included) for every row of docs(doc_id, text).

    A text without words, and a null text, has the fingerprint zero and is linked like any other. Rows that share a doc_id
    are linked by their own fingerprints. A null doc_id is no smallest one: a component of null ids alone has a null
    component_id. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = cut(docs.mapInArrow(functools.partial(_prints, shingle=shingle), "doc_id long, print long"))
    # Rows of one fingerprint are a class, so copies make no pairs.
    classes = cut(prints.groupBy("print").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")))
    labels = components(close_pairs(classes.select("print"), cell=cell)).withColumnRenamed("node", "print")
    grouped = cut(classes.join(labels, "print", "left").withColumn("label", F.coalesce("label", "print")))
    smallest = cut(grouped.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("classes")))
    named = cut(skew_join(grouped, smallest, ["label"], "classes").select("print", "component_id", "rows"))
    found = skew_join(prints, named, ["print"], "rows")
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
