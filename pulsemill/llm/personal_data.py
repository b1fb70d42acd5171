r"""Personal data by patterns and information-theoretic sanitisation, in DataFrame functions only.

Base spans come from regular expressions inside each row. Every distinct identifier found in enough documents is then a
protected entity c, and all words t of the documents that mention it are weighed by what they reveal of it over the whole
corpus, with p() the share of documents:

    PMI(c; t) = log2 p(c, t) / (p(c) p(t)),    IC(c) = -log2 p(c)

A word whose PMI reaches DISCLOSURE * IC(c) nearly names the entity; its occurrences in every text are added as spans of kind
"term". sanitise() replaces all spans: identifiers by their kind, terms by a general mark.

Patterns are written so that Java's matcher neither recurses nor reads a run of characters twice: possessive loops, and
look-behinds that let a match start only where a run starts (or, for e-mail, where the last match ended).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, cut, let

#: The kinds in the order that breaks ties between spans.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this can't hold the kind, so its pattern isn't run.
MARKS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TERM = "term"

#: Documents in which an entity, and an entity with a word, must be found before they are weighed.
SUPPORT = 3
DISCLOSURE = 0.9
#: A word that may reveal an entity.
TERM_PATTERN = r"[\p{L}\p{M}\p{N}]+"

SPAN = "struct<start: int, kind: int, stop: int, value: string>"


#: Matches whose positions are summed up together; the sums of the blocks are summed in turn, so that long texts take no quadratic time.
STEP = 64


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, value>>: the matches with their positions in code points (stop exclusive).

    Positions are running sums of the lengths of the matches and of the gaps that split() leaves between them, first inside
    blocks of STEP matches, then over the blocks.
    """
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    span = "struct<start: int, stop: int, value: string>"

    def walk(x: Column) -> Column:
        n = F.size(x["m"])

        def block(b: Column) -> Column:
            zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

            def step(acc: Column, i: Column) -> Column:
                value = F.get(x["m"], i)
                start = acc["at"] + F.char_length(F.get(x["g"], i))
                stop = start + F.char_length(value)
                return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"), value.alias("value")))).alias("out"))

            return F.aggregate(F.sequence(b * STEP, F.least(n, (b + 1) * STEP) - 1), zero, step)

        def moved(blocks: Column) -> Column:
            firsts = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["at"])))
            by = lambda b, first: F.transform(b["out"], lambda s: F.struct((s["start"] + first).alias("start"), (s["stop"] + first).alias("stop"), s["value"].alias("value")))
            return let(firsts, lambda f: F.flatten(F.transform(blocks, lambda b, i: by(b, F.get(f, i)))))

        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STEP).cast("int")), block)
        return F.when(n == 0, F.array().cast(f"array<{span}>")).otherwise(let(blocks, moved))

    return let(found, walk)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a string of digits is right."""
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        bare = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\.", -1), lambda p: (F.char_length(bare(p)) <= 3) & (F.substring(bare(p), 1, 3).cast("int") <= 255))
    digits = _digits(value)
    size = F.char_length(digits)
    if kind == "card":
        return let(digits, lambda d: (F.char_length(d) >= 12) & (F.char_length(d) <= 19) & F.when(F.char_length(d) <= 19, luhn(d)).otherwise(False))
    return (size >= 9) & (size <= 15)


def base_spans(text: Column) -> Column:
    """Sorted array of SPAN over the four kinds; kind is the index in KINDS."""
    none = F.array().cast(f"array<{SPAN}>")
    each = []
    for k, kind in enumerate(KINDS):
        spans = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))  # noqa: B023
        spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value")))  # noqa: B023
        each.append(F.when(text.rlike(MARKS[kind]), spans).otherwise(none))
    return F.array_sort(F.concat(*each))


def entity_of(kind: Column, value: Column) -> Column:
    """The same identifier written in other ways: lower case, and digits alone for cards and phones."""
    return F.concat(kind.cast("string"), F.lit(":"), F.when(kind >= KINDS.index("card"), _digits(value)).otherwise(F.lower(value)))


def _words() -> Column:
    """The distinct words of the column text in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM_PATTERN), F.lit(0)), F.lower))


def _places(text: Column, terms: Column) -> Column:
    """Array of SPAN: the occurrences of some words. As located(), but only what is kept is added to the array."""
    found = F.struct(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)).alias("m"), F.split(text, TERM_PATTERN, -1).alias("g"))

    def walk(x: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            value = F.get(x["m"], i)
            start = acc["at"] + F.char_length(F.get(x["g"], i))
            stop = start + F.char_length(value)
            span = F.struct(start.alias("start"), F.lit(len(KINDS)).alias("kind"), stop.alias("stop"), F.lit("").alias("value"))
            return F.struct(stop.alias("at"), F.when(F.array_contains(terms, F.lower(value)), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.when(F.size(x["m"]) == 0, zero["out"]).otherwise(F.aggregate(F.sequence(F.lit(0), F.size(x["m"]) - 1), zero, step, lambda a: a["out"]))

    return let(found, walk)


def disclosing_terms(rows: DataFrame, support: int, disclosure: float) -> DataFrame:
    """row, term: the words of each text that reveal an entity mentioned in any text. rows: row, text, base, ... of all documents."""
    mentions = F.array_distinct(F.transform("base", lambda s: entity_of(s["kind"], s["value"])))
    held = rows.filter(F.size("base") > 0)
    mentioned = held.select("row", F.explode(mentions).alias("entity"))
    # Documents of each entity. Counted before the join, so a frequent entity is one row.
    entities = cut(mentioned.groupBy("entity").agg(F.count("*").alias("n_c")).filter(F.col("n_c") >= support), narrow=True)
    entities = broadcast_if_small(entities, 120)
    # Both sides of a pair are in one row, so no join has an entity's or a word's documents for its key.
    known = mentioned.join(entities.select("entity"), "entity", "left_semi").groupBy("row").agg(F.collect_list("entity").alias("entities"))
    words = cut(held.select("row", _words().alias("words")).join(known, "row"))
    pairs = words.select(F.explode("entities").alias("entity"), "words").select("entity", F.explode("words").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_ct")).filter(F.col("n_ct") >= support)
    total = rows.count()
    n = F.lit(float(total))
    # PMI >= disclosure * IC holds if n_t <= n_ct * (n / n_c) ** (1 - disclosure). A word in more texts with entities than that
    # is out before it is counted over the corpus: so the frequent words never are.
    among = words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("m_t")).filter(F.col("m_t") >= support)
    most = F.col("n_ct") * F.pow(n / F.col("n_c"), F.lit(1 - disclosure)) * 1.0001
    pairs = cut(pairs.join(entities, "entity").join(among, "term").filter(F.col("m_t") <= most).drop("m_t"), narrow=True)
    asked = broadcast_if_small(cut(pairs.select("term").distinct(), narrow=True), 60)
    places = cut(rows.select("row", F.explode(_words()).alias("term")).join(asked, "term", "left_semi").select("row", "term"))
    spread = places.groupBy("term").agg(F.count("*").alias("n_t"))
    pmi = F.log2(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t")))
    content = -F.log2(F.col("n_c") / n)
    telling = cut(pairs.join(spread, "term").filter((content > 0) & (pmi >= disclosure * content)).select("term").distinct(), narrow=True)
    return places.join(broadcast_if_small(telling, 60), "term", "left_semi").select("row", "term")


def _row_spans(rows: DataFrame, support: int, disclosure: float) -> DataFrame:
    """row, the other columns but text, base, spans of rows(row, text, base, ...), a written table with one row for each `row`."""
    terms = cut(disclosing_terms(rows, support, disclosure))
    marked = broadcast_if_small(terms.groupBy("row").agg(F.collect_list("term").alias("terms")), 60, rows=terms.count())
    spans = rows.join(marked, "row").select("row", "base", _places(F.col("text"), F.col("terms")).alias("spans"))
    apart = F.filter("spans", lambda t: ~F.exists("base", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    spans = cut(spans.select("row", apart.alias("spans")))
    none = F.array().cast(f"array<{SPAN}>")
    joined = rows.drop("text").join(spans, "row", "left")
    return joined.select(*(c for c in rows.columns if c != "text"), F.array_sort(F.concat("base", F.coalesce("spans", none))).alias("spans"))


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, base (array of spans) and spans (the same with the disclosing terms) for every row of docs(doc_id, text, ...).

    A null text counts as empty. Each row is a document of its own, also if its doc_id is null or repeated. Terms inside
    identifiers are left out. Entities found in fewer than support documents are not weighed: what reveals only them stays.
    An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = cut(texts.withColumn("row", F.monotonically_increasing_id()).withColumn("base", base_spans(F.col("text"))))
    return _row_spans(rows, support, disclosure).select("doc_id", "base", "spans")


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, the base kinds' counts, base_sha256 and spans of personal_data()."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return personal_data(docs).select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, general: str = "[WORD]", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """docs with every identifier in the column text replaced by its kind in brackets, and every disclosing term by a general mark.

    Spans go with their own row, not with a doc_id: rows with a null doc_id are sanitised, and rows that share one each by
    their own text. Null and empty texts stay as they are; repeated rows stay repeated; an empty table gives no rows; other
    columns, of whatever name, are kept.
    """
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS), F.lit(general))
    held = cut(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")))
    rows = cut(held.select("row", F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text"))))
    found = _row_spans(rows, support, disclosure).filter(F.size("spans") > 0).select("row", "spans")

    def replace(x: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            text = F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.get(marks, s["kind"]))
            return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(s["stop"].alias("at"), text.alias("out")))

        return F.aggregate(x, zero, step, lambda a: F.concat(a["out"], F.substr(F.col("text"), a["at"] + 1, F.char_length("text"))))

    joined = held.join(found, "row", "left").withColumn("text", F.col("doc.text").cast("string"))
    text = F.when(F.size("spans") > 0, replace(F.col("spans"))).otherwise(F.col("text"))
    return joined.select(*(text.alias("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns))
