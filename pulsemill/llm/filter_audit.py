"""What each corpus filter removes alone, together with the others and in every order, as one relational plan.

Words are exploded and counted by (row, word), then by row, which gives the totals and the distinct words; the other flags
are outer-joined. A row's five flags are a number from 0 to 31, and 32 conditional counts for each part say how many rows
fail exactly that set of filters. What a filter removes at any step of any order follows from these counts alone: the rows
that fail it and none of the filters before it.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, skew_join

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
#: Limits of the filters: words, distinct words in 100 words, capitals in 100 characters, and the symbols of D.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 200, 50, 2, "[#$%&*|]"
SPACES = r"[\x20\x09-\x0D]+"
#: Added once to the words of each row; it holds a separator, so it is no word.
MARK = "\n"
#: What is counted: all rows, rows labelled good, rows labelled toxic.
KINDS = ("all", "good", "toxic")


def word_totals(rows: DataFrame) -> DataFrame:
    """key_a, key_b, n_words and n_distinct (of one row) for each key of rows(key_a, key_b, text). Rows of one key have one text.

    A text is dealt by its key once. Both groupings keep that partitioning, so no row of words is shuffled.
    """
    words = F.explode(F.array_append(F.split("text", SPACES), F.lit(MARK)))
    counted = rows.repartition("key_a", "key_b").select("key_a", "key_b", words.alias("word")).groupBy("key_a", "key_b", "word").agg(F.count("*").alias("n"))
    is_word = ~F.col("word").isin("", MARK)
    totals = counted.groupBy("key_a", "key_b").agg(
        F.sum(F.when(is_word, F.col("n")).otherwise(0)).alias("n"), F.count_if(is_word).alias("n_distinct"), F.max(F.when(F.col("word") == MARK, F.col("n"))).alias("rows")
    )
    return totals.select("key_a", "key_b", F.expr("n div rows").alias("n_words"), "n_distinct")


def failure_flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, n_words, n_distinct, mask for every row of docs(doc_id, text, source); bit i of mask: the row fails filter i of FILTERS.

    A null text is an empty one, a null source the part ''. Rows that share a doc_id are judged one by one. E needs a
    smaller doc_id with the same text (compared by SHA-256), so of rows with one id and text none fails for the other, and a
    null doc_id neither fails E nor makes others fail. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    # The key of a row are two hashes of its id and text; hashes skip nulls, so a null id has a seed of its own.
    known = F.col("doc_id").isNull().cast("int")
    keys = [F.xxhash64("doc_id", "text", known).alias("key_a"), F.xxhash64(known, "text", "doc_id").alias("key_b")]
    capitals = F.char_length("text") - F.char_length(F.regexp_replace("text", "[A-Z]", ""))
    other = rows.select(
        "doc_id",
        "part",
        *keys,
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("same"),
        (100 * capitals.cast("long") > MAX_CAPITALS * F.char_length("text").cast("long")).alias("capitals"),
        F.col("text").rlike(SYMBOLS).alias("symbols"),
    )
    counted = cut(other.join(word_totals(rows.select(*keys, "text")), ["key_a", "key_b"], "left").drop("key_a", "key_b"))
    texts = cut(counted.groupBy("same").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")).filter("rows > 1"))
    found = skew_join(counted, texts, ["same"], "rows")
    fails = [
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"),
        F.col("capitals"),
        F.col("symbols"),
        F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)),
    ]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return found.select("doc_id", "part", "n_words", "n_distinct", mask.cast("int").alias("mask"))


def interaction_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part and three arrays of 32 counts (all, good, toxic: rows by their mask) of flags(doc_id, part, mask) and labels(doc_id, quality, toxic).

    A row counts as good (toxic) if any label of its doc_id has quality (toxic) 1; rows without a label or an id as neither.
    """
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = cut(marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")), narrow=True)
    flags = cut(flags.select("doc_id", "part", "mask"))
    nameless = flags.filter("doc_id is null").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    rows = flags.filter("doc_id is not null").join(broadcast_if_small(marks, 40), "doc_id", "left").unionByName(nameless)
    # Some files of a cut table hold one part only, so groups are formed over (part, kind) with sums on the map side.
    kinds = F.array(F.lit(0), F.when(F.col("good"), 1), F.when(F.col("toxic"), 2))
    counted = rows.select("part", "mask", F.explode(kinds).alias("kind")).filter("kind is not null").groupBy("part", "kind").agg(*(F.count_if(F.col("mask") == m).alias(f"m{m}") for m in range(MASKS)))
    counts = counted.select("part", "kind", F.array(*(f"m{m}" for m in range(MASKS))).alias("counts"))
    none = F.array_repeat(F.lit(0).cast("long"), MASKS)
    return counts.groupBy("part").agg(*(F.coalesce(F.max(F.when(F.col("kind") == i, F.col("counts"))), none).alias(name) for i, name in enumerate(KINDS)))


def _sum_where(counts: str, condition: str) -> Column:
    """Sum of the counts of the masks m that meet the condition."""
    return F.expr(f"aggregate(filter(sequence(0, {MASKS - 1}), m -> {condition}), 0L, (s, m) -> s + {counts}[m])")


def removal_orders(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of that step (see the query) from the 32 counts of each part, for all 120 orders.

    shapley needs no sum over orders: of the filters that a row fails, each comes first in the same share of all orders.
    """
    steps = counts.select("part", *KINDS, F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {{}}, 1)) - 1)"
    before = f"aggregate(filter(sequence(1, {len(FILTERS)}), k -> k < step), 0, (s, k) -> s + {bit.format('k')})"
    steps = steps.select("*", F.expr(bit.format("step")).alias("here"), F.expr(before).alias("before"))
    removed = "(m & here) <> 0 and (m & before) = 0"
    return steps.select(
        "part",
        "filter_order",
        "step",
        _sum_where("all", "(m & (here | before)) = 0").alias("kept"),
        _sum_where("all", removed).alias("removed"),
        _sum_where("all", "(m & here) <> 0 and (m & before) <> 0").alias("redundant"),
        _sum_where("all", "m = here").alias("unique_fails"),
        _sum_where("good", removed).alias("good_lost"),
        _sum_where("toxic", removed).alias("toxic_lost"),
        F.expr(f"aggregate(filter(sequence(0, {MASKS - 1}), m -> (m & here) <> 0), 0L, (s, m) -> s + all[m] * ({len(ORDERS)} div bit_count(m)))").alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    See failure_flags and interaction_counts for nulls, repeated rows and other columns; without documents there are no rows.
    """
    return removal_orders(interaction_counts(failure_flags(docs), labels))


AUDIT_SQL = rf"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from d),
f as (select doc_id, part,
        (len(words) < {MIN_WORDS})::int
        + 2 * (100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words))::int
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_CAPITALS} * length(t))::int
        + 8 * regexp_matches(t, '{SYMBOLS}')::int
        + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask
      from w),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
n as (select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic from f left join l using (doc_id) group by part, mask),
letter as (select substr('{FILTERS}', i::int, 1) as x, (1 << (i - 1))::int as b from range(1, 6) r(i)),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
           from letter a, letter b, letter c, letter d, letter e where len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
steps as (select filter_order, s::int as step, bits[s] as here, coalesce(list_sum(bits[:s - 1]), 0)::int as before from orders, range(1, 6) r(s)),
r as (select part, filter_order, step,
        sum(case when mask & (here | before) = 0 then n else 0 end)::bigint as kept,
        sum(case when mask & here <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
        sum(case when mask & here <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
        sum(case when mask = here then n else 0 end)::bigint as unique_fails,
        sum(case when mask & here <> 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
        sum(case when mask & here <> 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
      from n, steps group by part, filter_order, step)
select r.*, sum(removed) over (partition by part, substr(filter_order, step, 1))::bigint as shapley from r
"""
