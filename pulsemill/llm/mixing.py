"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Token counts are summed by cell (source, language, topic). The cells' weights are raked to the target share of each
source, each language and each topic in turn, sweep after sweep. A document is then sampled with a probability that is
proportional to the factor by which its cell's weight changed; the largest factor has probability 1.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, broadcast_if_small, cut

DIMS = ("source", "lang", "topic")
#: Topics by marks in the text, first match wins; the patterns are parameters.
TOPICS = (("licence", "(?i)licen[cs]e|copyright"), ("contact", r"@[A-Za-z0-9-]+\."), ("listing", r" \| "), ("links", "https?://"))
OTHER = "prose"
#: Default targets: a share to this power, so that large sources give way to small ones.
TEMPERATURE = 0.9
SWEEPS = 8
#: Sweeps that go into one plan.
PLANNED = 8


def topic_of(text: Column, topics=TOPICS) -> Column:
    chosen = F.lit(OTHER)
    for name, pattern in reversed(topics):
        chosen = F.when(text.rlike(pattern), F.lit(name)).otherwise(chosen)
    return chosen


def uniform(name: Column) -> Column:
    """A number in [0, 1) that depends on the name alone."""
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def default_targets(cells: DataFrame, dim: str, temperature: float) -> DataFrame:
    """dim, target: the tempered token shares of a dimension."""
    mass = cells.groupBy(dim).agg(F.pow(F.sum("base"), F.lit(temperature)).alias("t"))
    total = mass.agg(F.sum("t").alias("all"))
    return mass.join(F.broadcast(total)).select(dim, (F.col("t") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """cells(source, lang, topic, base) with the columns weight, whose shares meet the targets of each dimension, and residual.

    residual is the largest difference between a share and its target that the sweeps leave. Each cell carries a factor for
    each dimension; a step sets one of them from the sum of the other factors' products over the cells of its value, which is
    a window over the table of cells. So PLANNED sweeps are one plan, without joins or files between them.
    """
    for dim in DIMS:
        target = cut(targets[dim].select(dim, F.col("target").alias(f"target_{dim}")), narrow=True)
        cells = cells.join(broadcast_if_small(target, 100), dim)
    cells = cut(cells.withColumns({f"factor_{dim}": F.lit(1.0) for dim in DIMS}), narrow=True)
    product = lambda dims: functools.reduce(lambda x, y: x * y, (F.col(f"factor_{d}") for d in dims), F.col("base"))
    out = cells
    for sweep in range(sweeps):
        if sweep and sweep % PLANNED == 0:
            out = cut(out, narrow=True)
        for dim in DIMS:
            mass = F.sum(product([d for d in DIMS if d != dim])).over(Window.partitionBy(dim))
            out = out.withColumn(f"factor_{dim}", F.col(f"target_{dim}") / mass)
    out = cut(out.withColumn("weight", product(DIMS)), narrow=True)
    total = F.broadcast(out.agg(F.sum("weight").alias("total")))  # one row
    misses = [out.groupBy(dim).agg(F.sum("weight").alias("mass"), F.first(f"target_{dim}").alias("target")) for dim in DIMS]
    misses = [m.join(total).select(F.abs(F.col("mass") / F.col("total") - F.col("target")).alias("miss")) for m in misses]
    worst = misses[0].union(misses[1]).union(misses[2]).agg(F.max("miss").alias("residual"))  # one row
    return out.select(*DIMS, "base", "weight").join(F.broadcast(worst))


def mix_sources(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temperature: float = TEMPERATURE, sweeps: int = SWEEPS, topics=TOPICS, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability (9 digits), sampled and residual (6 digits: how far the shares of all cells are from their targets at most) for every row of docs(doc_id, text, lang, source).

    A null source or language is the value '(none)'. A null or empty text has no tokens: it belongs to no cell, so its
    probability is 0 and it is not sampled. Rows that share a doc_id share their random number; a null doc_id has one by its
    text. Targets are tables (dim, target); values of a dimension that a given target lacks get no weight. Columns named in
    `carried` go along; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(c) for c in ("source", "lang")]
    drawn = uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text)))
    counted = docs.select("doc_id", *carried, drawn.alias("drawn"), *named, topic_of(text, topics).alias("topic"), F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("n_tokens"))
    counted = cut(counted)
    cells = cut(narrow=True, df=counted.filter("n_tokens > 0").groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("base")))
    targets = targets or {dim: default_targets(cells, dim, temperature) for dim in DIMS}
    raked = cut(rake(cells, targets, sweeps).withColumn("factor", F.col("weight") / F.col("base")), narrow=True)
    top = raked.agg(F.max("factor").alias("top"), F.max("residual").alias("residual"))
    odds = raked.join(F.broadcast(top.select("top"))).select(*(F.col(d).alias(f"cell_{d}") for d in DIMS), F.round(F.col("factor") / F.col("top"), 9).alias("p"))
    same = [F.col(d) == F.col(f"cell_{d}") for d in DIMS]
    found = counted.join(broadcast_if_small(cut(odds, narrow=True), 200), same[0] & same[1] & same[2], "left")
    p = F.when(F.col("n_tokens") > 0, F.coalesce("p", F.lit(0.0))).otherwise(F.lit(0.0))
    found = found.join(F.broadcast(top.select(F.round("residual", 6).alias("residual"))))  # one row
    return found.select("doc_id", *carried, *DIMS, "n_tokens", p.alias("probability"), (F.col("drawn") < p).alias("sampled"), "residual")


def mixing_sql(temperature: float = TEMPERATURE, sweeps: int = SWEEPS) -> str:
    """The same rows in DuckDB SQL: one CTE for each step of each sweep."""
    topic = "case " + " ".join(f"when regexp_matches(t, '{p}') then '{n}'" for n, p in TOPICS) + f" else '{OTHER}' end"
    steps = [
        rf"d as (select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang, coalesce(text, '') as t from documents)",
        rf"c as (select doc_id, source, lang, {topic} as topic, cast(len(regexp_extract_all(t, '{WORD_PATTERN}')) as bigint) as n_tokens from d)",
        "w0 as (select source, lang, topic, cast(sum(n_tokens) as double) as base, cast(sum(n_tokens) as double) as w from c where n_tokens > 0 group by all)",
    ]
    steps += [f"t_{d} as (select {d}, pow(sum(base), {temperature}) / sum(pow(sum(base), {temperature})) over () as target from w0 group by {d})" for d in DIMS]
    n, now = 0, {d: None for d in DIMS}
    for _ in range(sweeps):
        for d in DIMS:
            others = [x for x in DIMS if x != d and now[x]]
            joins = " ".join(f"join {now[x]} on w0.{x} = {now[x]}.{x}" for x in others)
            weight = " * ".join(["base", *(f"{now[x]}.factor" for x in others)])
            steps.append(f"s{n} as materialized (select w0.{d}, any_value(target) / sum({weight}) as factor from w0 {joins} join t_{d} on w0.{d} = t_{d}.{d} group by w0.{d})")
            now[d], n = f"s{n}", n + 1
    joins = " ".join(f"join {now[x]} on w0.{x} = {now[x]}.{x}" for x in DIMS)
    product = " * ".join(f"{now[x]}.factor" for x in DIMS)
    steps.append(f"f as (select w0.source, w0.lang, w0.topic, {product} as factor, base * {product} as weight from w0 {joins})")
    misses = " union all ".join(f"select max(abs(mass / (select sum(weight) from f) - target)) as miss from (select {d}, sum(weight) as mass from f group by {d}) x join t_{d} on x.{d} = t_{d}.{d}" for d in DIMS)
    steps.append(f"r as (select round(max(miss), 6) as residual from ({misses}))")
    steps.append("o as (select source, lang, topic, round(factor / (select max(factor) from f), 9) as p from f)")
    u = "cast(('0x' || substr(md5(cast(c.doc_id as varchar)), 1, 8)) as bigint) / 4294967296.0"
    p = "case when n_tokens > 0 then coalesce(p, 0.0) else 0.0 end"
    return f"with {', '.join(steps)} select c.doc_id, c.source, c.lang, c.topic, n_tokens, {p} as probability, {u} < {p} as sampled, (select residual from r) as residual from c left join o on c.source = o.source and c.lang = o.lang and c.topic = o.topic"
