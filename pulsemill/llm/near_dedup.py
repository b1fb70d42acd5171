"""Near-duplicate groups by one-permutation MinHash.

Each document becomes the set of its word shingles. One permutation of the 64-bit hash space is cut into equal bins; the
smallest hash of each bin is the sketch, and an empty bin borrows from the bin that its own sequence of random probes
meets first (optimal densification). Bands of consecutive bins give bucket keys. Within a bucket the candidate edges
form stars: every member against one centre. Candidates are confirmed on the full shingle sets.

A star can miss a link between two members that are both unlike its centre. So documents in a bucket whose members still
lie in more than one component are joined exactly, by prefix filtering: with shingles ordered from rare to frequent, two
sets of n and m shingles can only reach the threshold t if they share one among the first n - ceil(t n) + 1 and
m - ceil(t m) + 1. Near copies that differ by edits of their own have rare shingles first and meet nothing; shingles found
in one component only are left out. This finds the rest of the links without pairing a bucket's members.

Texts are compared by two independent 64-bit hashes of their words, whose collisions would have to meet in both.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_slices, broadcast_if_small, cut, gram_hashes, mix, shuffle_parts, skew_join, slices, token_hashes

BINS = 256
#: 64-bit words of the parity bitmap that screens pairs before their texts are read.
BITMAP_WORDS = 16


def bands_for(threshold_pct: int) -> tuple[int, int]:
    """(bands, rows of a band), so that a pair at the threshold misses every band with a probability under 1e-4."""
    return (32, 8) if threshold_pct >= 85 else (42, 6)


def shingle_sets(texts, n: int, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-word shingles; a shorter text is one shingle, a text without words none."""
    return [np.unique(gram_hashes(h, min(n, len(h)))) if len(h) else h for h in token_hashes(texts, lower=True, seed=seed)]


@functools.cache
def _probes() -> np.ndarray:
    return np.random.default_rng(20_170_601).integers(0, BINS, (BINS, 4096), dtype=np.int16)


def one_permutation(hashes: np.ndarray) -> np.ndarray:
    """Densified sketch of a non-empty sorted set of hashes."""
    owner = (hashes >> np.uint64(56)).astype(np.int64)
    full, first = np.unique(owner, return_index=True)
    filled = np.zeros(BINS, bool)
    filled[full] = True
    sketch = np.zeros(BINS, np.uint64)
    sketch[full] = hashes[first]
    empty = np.nonzero(~filled)[0]
    for start, stop in ((0, 64), (64, 4096)):
        if not len(empty):
            break
        tried = _probes()[empty, start:stop]
        hit = filled[tried]
        found = hit.any(axis=1)
        at = hit.argmax(axis=1)
        sketch[empty[found]] = sketch[tried[found, at[found]]]
        empty = empty[~found]
    for i in empty:
        sketch[i] = sketch[full[i % len(full)]]
    return sketch


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sketch[: bands * rows].reshape(bands, rows).T:
        key = mix(key ^ column)
    return key.view(np.int64)


def parity_bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes that fall on each bit.

    Two sets' bitmaps differ in at most as many bits as the sets differ in elements, so too many differing bits prove that
    a pair misses the threshold; a pair that reaches it is never screened out.
    """
    bits = np.bincount(((hashes >> np.uint64(20)) & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * BITMAP_WORDS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _digest(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sign(batches, shingle: int, bands: int, rows: int):
    """Set size, two digests of the set from independent hashes, band keys and bitmap of each text."""
    for part in arrow_slices(batches):
        text = part.column("text")
        sets, others = shingle_sets(text, shingle), shingle_sets(text, shingle, seed=1)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in others], pa.int64()),
                pa.array([band_keys(one_permutation(s), bands, rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([parity_bitmap(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "set_a", "set_b", "bands", "bitmap"],
        )


def _sides(bitmaps: DataFrame):
    """bitmaps(doc_id, size, bitmap) as (a, size_a, a0..) and (b, size_b, b0..)."""
    return tuple(bitmaps.select(F.col("doc_id").alias(x), F.col("size").alias(f"size_{x}"), *(F.col("bitmap")[i].alias(f"{x}{i}") for i in range(BITMAP_WORDS))) for x in "ab")


def _may_reach(threshold_pct: int):
    """Over columns of both sides: whether sizes and bitmaps allow the threshold, J = (n + m - d) / (n + m + d) for d differing elements."""
    differing = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0")))
    for i in range(1, BITMAP_WORDS):
        differing = differing + F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")))
    return (100 + threshold_pct) * differing <= (100 - threshold_pct) * (F.col("size_a") + F.col("size_b"))


def _similar(pdf: pd.DataFrame, shingle: int, threshold_pct: int, seed: int) -> np.ndarray:
    centres = pdf.drop_duplicates("a")  # a star's pairs come together, so its centre is cut into shingles once
    of = dict(zip(centres["a"], shingle_sets(centres["text_a"], shingle, seed)))
    keep = []
    for a, y in zip(pdf["a"], shingle_sets(pdf["text_b"], shingle, seed)):
        x = of[a]
        union = len(np.union1d(x, y))
        keep.append(100 * (len(x) + len(y) - union) >= threshold_pct * union)
    return np.array(keep, bool)


def _confirm(batches, shingle: int, threshold_pct: int):
    """The pairs whose full sets reach the threshold, by two independent hashes of the shingles."""
    for batch in batches:
        for pdf in slices(batch.rename(columns={"text_b": "text"})):
            pdf = pdf.rename(columns={"text": "text_b"})
            for seed in (0, 1):
                pdf = pdf[_similar(pdf, shingle, threshold_pct, seed)] if len(pdf) else pdf
            yield pdf[["a", "b"]]


def _shingles(batches, shingle: int):
    for part in arrow_slices(batches):
        sets = shingle_sets(part.column("text"), shingle)
        sizes = np.array([len(s) for s in sets], np.int64)
        doc_id = part.column("doc_id").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(doc_id, sizes)), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))], ["doc_id", "size", "token"])


def prefix_pairs(texts: DataFrame, labels: DataFrame, bitmaps: DataFrame, shingle: int, threshold_pct: int) -> DataFrame:
    """Pairs (a, b) of texts(doc_id, text) under different labels(doc_id, label) that share a shingle in their prefixes and may reach the threshold.

    Shingles that only documents of one label have meet nothing, so a family of near copies that already is one component
    drops out before the join. The join's key is the shingle and a class of sizes: sets that may reach the threshold have
    the same class, or the larger one the next.
    """
    tokens = cut(texts.mapInArrow(functools.partial(_shingles, shingle=shingle), "doc_id long, size long, token long").join(labels, "doc_id"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("token", "df")
    held = tokens.join(shared, "token")
    order = Window.partitionBy("doc_id").orderBy("df", "token")
    held = held.withColumn("rank", F.row_number().over(order)).withColumn("n_shared", F.count("*").over(Window.partitionBy("doc_id")))
    place = F.col("rank") + F.col("size") - F.col("n_shared")  # those of one label come first
    least = F.ceil(F.col("size") * threshold_pct / 100)
    prefix = held.filter(place <= F.col("size") - least + 1).select("token", "doc_id", "label")
    left, right = _sides(bitmaps)
    step = math.log(100 / threshold_pct) * 1.0001  # a little more than the ratio, so rounding can't move a size two classes on
    size_class = lambda c: F.floor(F.log(c.cast("double")) / step)
    x = prefix.select("token", F.col("doc_id").alias("a"), F.col("label").alias("label_a")).join(left, "a")
    x = x.withColumn("size_class", F.explode(F.array(size_class(F.col("size_a")), size_class(F.col("size_a")) + 1)))
    y = prefix.select("token", F.col("doc_id").alias("b"), F.col("label").alias("label_b")).join(right, "b").withColumn("size_class", size_class(F.col("size_b")))
    smaller = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    may = (F.col("label_a") != F.col("label_b")) & smaller & _may_reach(threshold_pct)
    met = x.join(y, (x["token"] == y["token"]) & (x["size_class"] == y["size_class"]) & may)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges(a, b); label is the smallest node reachable. Min-label propagation with shortcuts."""
    both = cut(narrow=True, df=edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut(narrow=True, df=both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        nxt = cut(narrow=True, df=step.join(hop, "label").select("node", "old", F.least("label", "jump").alias("label")))
        labels = nxt.select("node", "label")
        if nxt.filter("old <> label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold_pct: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row of docs(doc_id, text, ...).

    Two documents are linked if 100 * |A and B| >= threshold_pct * |A or B| for their shingle sets. Texts without words
    and null texts have no shingles and are linked with nothing. Rows that share a doc_id are one node of the graph. A
    null doc_id gives a null component_id and kept = true. Other columns are ignored.
    """
    spark = docs.sparkSession
    bands, rows = bands_for(threshold_pct)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bitmap array<long>"
    signed = cut(docs.mapInArrow(functools.partial(_sign, shingle=shingle, bands=bands, rows=rows), schema))

    # Documents with equal sets form a class; only its smallest id goes on, so exact copies make no pairs at all.
    key = ["n_shingles", "set_a", "set_b"]
    classes = cut(signed.filter("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")))
    members = cut(skew_join(signed.select("doc_id", *key), classes, key, "rows").select("doc_id", "n_shingles", "rep"))
    reps = members.filter("doc_id = rep").select("doc_id").distinct()
    live = signed.filter("n_shingles > 0").join(reps, "doc_id").dropDuplicates(["doc_id"])
    bitmaps = live.select("doc_id", F.col("n_shingles").alias("size"), "bitmap")
    spread = live.select(F.explode("bands").alias("bucket"), "doc_id")
    crowded = spread.groupBy("bucket").agg(F.min("doc_id").alias("centre"), F.count("*").alias("size")).filter("size > 1")
    buckets = cut(spread.join(crowded.select("bucket", "centre"), "bucket"))

    ids = cut(buckets.select("doc_id").distinct(), narrow=True)
    n_ids = ids.count()
    texts = cut(docs.join(broadcast_if_small(ids, 40, rows=n_ids), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    bitmaps = cut(bitmaps.join(broadcast_if_small(ids, 40, rows=n_ids), "doc_id", "left_semi"))
    left, right = _sides(bitmaps)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The linked ones of pairs(a, b). A centre of many pairs is dealt to several tasks, each with a copy of its text."""
        pairs = cut(pairs)
        room = pairs.count() // (4 * shuffle_parts(spark)) + 1
        # At most 4 * partitions centres have more pairs than that, so this broadcast is bounded.
        busy = F.broadcast(pairs.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > room).select("a", F.ceil(F.col("n") / room).alias("copies")))
        copies = F.coalesce("copies", F.lit(1).cast("long"))
        dealt = pairs.join(busy, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), copies).alias("copy"))
        centres = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).join(busy, "a", "left")
        centres = centres.select("a", "text_a", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))
        read = dealt.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        read = read.join(centres, ["a", "copy"]).select("a", "b", "text_a", "text_b")
        return cut(read.mapInPandas(functools.partial(_confirm, shingle=shingle, threshold_pct=threshold_pct), "a long, b long"))

    stars = buckets.filter("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = stars.join(left, "a").join(right, "b").filter(_may_reach(threshold_pct)).select("a", "b")
    links = confirmed(stars)
    labels = components(links)

    tagged = buckets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    split = tagged.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("bucket")
    open_docs = cut(tagged.join(split, "bucket").select("doc_id", "label").distinct(), narrow=True)
    open_texts = texts.join(broadcast_if_small(open_docs.select("doc_id"), 40), "doc_id", "left_semi")
    more = confirmed(prefix_pairs(open_texts, open_docs, bitmaps, shingle, threshold_pct))
    if not more.isEmpty():
        labels = components(links.union(more))

    found = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return found.select(
        "doc_id",
        "n_shingles",
        F.coalesce("label", "rep", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("label", "rep", "doc_id"), F.lit(True)).alias("kept"),
    )
