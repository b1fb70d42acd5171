"""Quality rules with host verdicts, in DataFrame functions only.

Per document: counts over the whole text, by array functions inside one row (nothing is exploded or shuffled). Per host and
rule: the rate of failing documents, shrunk towards the corpus by a beta prior. The prior's mean m is the corpus rate; its
strength s comes from the spread of the hosts' rates beyond what sampling explains (beta-binomial moments): with n_j
documents and k_j failures at host j of H, N documents and K failures in all,

    S = sum k_j^2 / n_j - K^2 / N,    rho = (S / (m (1 - m)) - (H - 1)) / (N - sum n_j^2 / N - (H - 1)),    s = 1 / rho - 1

A host is rejected if, for some rule, the lower end of its rate (posterior mean less MARGIN posterior standard deviations)
lies more than LIFT of the way from m up to 1. So a host is judged against the corpus, and small hosts need more evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, cut, let

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PCT = 50
#: Further rules, which count at the host only: percent of word characters that are symbols, percent of lines repeated.
SYMBOL_PCT = 20
DUP_LINE_PCT = 50
RULES = ("short", "repeats", "symbols", "dup_lines")
#: Posterior standard deviations that a rate is taken lower by, and the share of the way from the corpus rate to 1.
MARGIN, LIFT = 2.0, 0.5
#: Bounds of the prior's strength in documents: hosts that differ entirely, and hosts that differ no more than by chance.
WEAKEST, STRONGEST = 0.01, 10_000.0


def words_of(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    bare = F.coalesce(F.btrim(text, F.lit(SPACE)), F.lit(""))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that are found twice or more. Windows are compared by 64-bit hashes within one text."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(*(F.try_element_at(words, i + k) for k in range(3))))

    def covered(h: Column) -> Column:
        def from_sorted(s: Column) -> Column:
            same = lambda x, i, step: F.coalesce(F.get(s, i + step)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, from_sorted))

    return F.when(n < 4, F.lit(0)).otherwise(let(hashes, covered))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host and the counts of the base rules."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id"), F.col("source").alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    by_words = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    found = docs.select(
        "doc_id",
        "host",
        by_words.alias("w"),
        F.char_length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        by_lines.cast("long").alias("n_dup_lines"),
        F.size(F.split("text", "\n", -1)).alias("n_lines"),
    )
    return found.select("doc_id", "host", F.col("w.n_words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"), "n_lines")


def host_verdicts(judged: DataFrame) -> DataFrame:
    """host, host_docs, worst_rule, host_rate (shrunk) and host_low of that rule, and host_rejected from judged(host, a boolean for each of RULES)."""
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES))
    rates = hosts.select("host", "n", F.explode(F.array(*(F.struct(F.lit(i).alias("rule"), F.col(r).alias("k")) for i, r in enumerate(RULES)))).alias("x")).select("host", "n", "x.rule", "x.k")
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    prior = rates.groupBy("rule").agg(F.count("*").alias("h"), F.sum(n).alias("all_n"), F.sum(k).alias("all_k"), F.sum(n * n).alias("n2"), F.sum(k * k / n).alias("k2n"))
    prior = prior.withColumn("m", F.col("all_k") / F.col("all_n")).withColumn("odds", F.col("m") * (1 - F.col("m")))
    spread = (F.col("k2n") - F.col("all_k") * F.col("all_k") / F.col("all_n")) / F.col("odds") - (F.col("h") - 1)
    room = F.col("all_n") - F.col("n2") / F.col("all_n") - (F.col("h") - 1)
    rho = F.when((F.col("odds") > 0) & (room > 0), spread / room).otherwise(0.0)
    strength = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(WEAKEST)), F.lit(STRONGEST))).otherwise(F.lit(STRONGEST))
    prior = prior.select("rule", "m", strength.alias("s"))
    # One row for each rule, so this join is a broadcast of a few numbers.
    shrunk = rates.join(F.broadcast(prior), "rule")
    mean = (F.col("k") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    shrunk = shrunk.withColumn("rate", mean)
    shrunk = shrunk.withColumn("low", F.col("rate") - MARGIN * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("s") + 1)))
    shrunk = shrunk.withColumn("over", F.col("low") - F.col("m") - LIFT * (1 - F.col("m")))
    worst = shrunk.groupBy("host").agg(F.first("n").alias("host_docs"), F.max_by(F.struct("rule", "rate", "low", "over"), F.struct(F.round("over", 9), -F.col("rule"))).alias("w"))
    name = F.get(F.array(*(F.lit(r) for r in RULES)), F.col("w.rule"))
    return worst.select("host", "host_docs", name.alias("worst_rule"), F.col("w.rate").alias("host_rate"), F.col("w.low").alias("host_low"), (F.col("w.over") > 0).alias("host_rejected"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each row of docs(doc_id, text, source, ...): the counts, base_failed, kept and the host's figures.

    A null text counts as empty (no words, so it fails the base rules); a null source is a host of its own; repeated rows
    are judged and counted one by one. Of rules equally far over, the first of RULES is named. An empty table gives an empty
    result. Other columns are ignored.
    """
    counts = text_counts(docs)
    rules = {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PCT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PCT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > DUP_LINE_PCT * F.col("n_lines"),
    }
    judged = cut(counts.withColumns(rules).drop("n_lines"))
    hosts = cut(host_verdicts(judged), narrow=True).withColumnRenamed("host", "host_key")
    joined = judged.join(broadcast_if_small(hosts, 100), F.col("host").eqNullSafe(F.col("host_key")))
    failed = F.col("short") | F.col("repeats")
    figures = [F.round(c, 6).alias(c) for c in ("host_rate", "host_low")]
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~F.col("host_rejected")).alias("kept"), "host_docs", "worst_rule", *figures)


QUALITY_SQL = rf"""
with w as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), g as (
  select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) >= 3
), h as (
  select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as c from g
), r as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from h where c > 1) group by doc_id
), l as (
  select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls, len(string_split(text, chr(10))) as n_lines from w
), c as (
  select w.doc_id, w.source, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words, n_lines
  from w join l on w.doc_id = l.doc_id left join r on r.doc_id = w.doc_id
), j as (
  select *, n_words < {MIN_WORDS} as short, 100 * n_repeat_words > {REPEAT_PCT} * n_words as repeats,
    100 * n_symbols > {SYMBOL_PCT} * word_chars as symbols, 100 * n_dup_lines > {DUP_LINE_PCT} * n_lines as dup_lines from c
), s as (
  {" union all ".join(f"select source, {i} as rule, '{r}' as name, cast(count(*) as double) as n, cast(sum(cast({r} as int)) as double) as k from j group by source" for i, r in enumerate(RULES))}
), p as (
  select rule, count(*) as h, sum(n) as all_n, sum(k) as all_k, sum(n * n) as n2, sum(k * k / n) as k2n from s group by rule
), q as (
  select rule, h, all_n, all_k, k2n, all_k / all_n as m, all_n - n2 / all_n - (h - 1) as room from p
), e as (
  select rule, m, case when m * (1 - m) > 0 and room > 0 then ((k2n - all_k * all_k / all_n) / (m * (1 - m)) - (h - 1)) / room else 0.0 end as rho from q
), k as (
  select rule, m, case when rho > 0 then least(greatest(1 / rho - 1, {WEAKEST}), {STRONGEST}) else {STRONGEST} end as s from e
), f as (
  select source, s.rule, name, n, m, k.s, (s.k + m * k.s) / (n + k.s) as rate from s join k on s.rule = k.rule
), g2 as (
  select *, rate - {MARGIN} * sqrt(rate * (1 - rate) / (n + s + 1)) as low from f
), v as (
  select *, low - m - {LIFT} * (1 - m) as over, row_number() over (partition by source order by round(low - m - {LIFT} * (1 - m), 9) desc, rule) as place from g2
)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeats as base_failed,
  not (short or repeats) and not (over > 0) as kept, cast(n as bigint) as host_docs, name as worst_rule, round(rate, 6) as host_rate, round(low, 6) as host_low
from j join v on j.source is not distinct from v.source and place = 1
"""
