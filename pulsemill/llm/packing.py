"""Packing token sequences into padded batches with optimal length buckets.

Documents longer than max_len are split into pieces. The histogram of piece lengths over the whole table has at most
max_len + 1 rows, whatever the table's size; dynamic programming over it chooses the bucket boundaries with the least
padding. Inside a bucket, batches hold as many sequences as a token budget allows at the bucket's padded length.
Sequences are numbered by shards of bounded size with running offsets, so no bucket is sorted in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, cut

MAX_LEN = 2048
BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Sequences that one shard of the numbering holds on average.
SHARD_ROWS = 20_000


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets over sorted distinct lengths that minimise the padded tokens.

    best[k][j] is the least padded size of the first j lengths in k buckets; the last bucket pads all its sequences to its
    largest length. Of equal choices the earliest split wins, so the result is unique.
    """
    n = len(lengths)
    if not n:
        return []
    seen = np.concatenate([[0], np.cumsum(counts)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    froms = []
    for _ in range(min(buckets, n)):
        nxt, back = np.full(n + 1, np.inf), np.zeros(n + 1, int)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (seen[j] - seen[:j])
            back[j] = int(cost.argmin())
            nxt[j] = cost[back[j]]
        froms.append(back)
        best = nxt
    bounds, j = [], n
    for back in reversed(froms):
        bounds.append(int(lengths[j - 1]))
        j = back[j]
    return bounds[::-1]


def sequences(docs: DataFrame, max_len: int) -> DataFrame:
    """doc_id, piece, length: one row for each run of at most max_len words; a text without words is one row of length 0."""
    n = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD_PATTERN))
    counted = docs.select("doc_id", n.cast("long").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_len) - 1, F.lit(0))
    pieces = counted.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"))
    return pieces.select("doc_id", "piece", F.least(F.lit(max_len), F.col("n") - F.col("piece") * max_len).alias("length"))


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """doc_id, piece, length, bucket_len, batch_id and slot for every sequence of docs(doc_id, text, ...).

    A batch belongs to one bucket and holds token_budget // bucket_len sequences (one at least); all batches of a bucket
    but its last are full. Null and empty texts are sequences of length 0 in the shortest bucket. Repeated rows are
    sequences of their own. An empty table gives no rows. Other columns are ignored.
    """
    seqs = cut(sequences(docs, max_len))
    histogram = {int(r["length"]): int(r["n"]) for r in seqs.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most max_len + 1 rows
    lengths = sorted(histogram)
    bounds = optimal_bounds(np.array(lengths, np.int64), np.array([histogram[x] for x in lengths], np.int64), buckets)
    n_shards = sum(histogram.values()) // SHARD_ROWS + 1
    table = F.array(*(F.lit(b).cast("long") for b in bounds)) if bounds else F.array().cast("array<long>")
    bucket = F.filter(table, lambda b: b >= F.col("length"))[0]
    dealt = seqs.withColumn("bucket_len", bucket).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_shards)))

    sizes = dealt.groupBy("bucket_len", "shard").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("bucket_len").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket_len", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket_len", "shard").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("n", F.row_number().over(inside)).join(offsets, ["bucket_len", "shard"])
    place = F.col("offset") + F.col("n") - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    batch = F.concat(F.col("bucket_len").cast("string"), F.lit("-"), F.floor(place / room).cast("string"))
    return numbered.select("doc_id", "piece", "length", "bucket_len", batch.alias("batch_id"), (place % room).alias("slot"))
