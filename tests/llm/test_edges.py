"""Nulls in any column, empty and very long texts, repeated rows, empty tables and clashing names, for all operators and stages."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsemill.llm import filter_audit, lm_scoring, mixing, near_dedup, packing, periodic_runs, personal_data, quality_rules, queries, secret_scan, simhash, substring_dedup, toxicity, webp_columns

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
OPERATORS = {
    "near_dedup": lambda d, l: near_dedup.near_duplicates(d, 3, 85),
    "mixing": lambda d, l: mixing.mix_sources(d, sweeps=2),
    "toxicity": toxicity.score_toxicity,
    "personal": lambda d, l: personal_data.personal_digests(d),
    "secrets": lambda d, l: secret_scan.secret_digests(d),
    "webp": lambda d, l: webp_columns.read_media(webp_columns.to_media(d), keep_pixels=False),
    "quality": lambda d, l: quality_rules.quality_rules(d),
    "substring": lambda d, l: substring_dedup.remove_repeats(d),
    "packing": lambda d, l: packing.pack(d),
    "lm": lambda d, l: lm_scoring.score_texts(d),
    "simhash": lambda d, l: simhash.simhash_groups(d),
    "periodic": lambda d, l: periodic_runs.run_digests(periodic_runs.planted(d)),
    "audit_flags": lambda d, l: filter_audit.failure_flags(d),
}
CLASHING = ["label", "spans", "score", "kept", "rank", "row", "a", "b", "p", "text_a", "rep", "bucket", "places", "host", "n_tokens", "base", "media", "topic", "shard", "piece", "length", "toxic", "mask", "good", "part", "word", "same", "print", "rows", "runs", "collapsed", "quality"]


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None, None, None, None), (None, "a text without an id but with words", "x", "s", 1), (2, "", "x", None, 0), (3, "one", None, "s", 3), (3, "one", None, "s", 3), (4, long, "y", "t", 1), (5, long, "y", "t", 1), (6, " \t\n", "y", "t", 3), (7, "Zé ß 😀 two three four five", "y", "t", None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def few_labels(spark):
    return spark.createDataFrame([(3, 1), (3, None), (None, 1), (4, 0)], "doc_id long, toxic int")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, few_labels, name):
    out = OPERATORS[name](odd, few_labels)
    rows = out.collect()
    ids = sorted((r["doc_id"] for r in rows), key=str)
    want = sorted((r["doc_id"] for r in odd.collect()), key=str)
    assert set(ids) == set(want) and (name == "packing" or ids == want)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd, few_labels, name):
    assert OPERATORS[name](odd.limit(0), few_labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(odd, few_labels, name):
    plain = OPERATORS[name](odd, few_labels)
    more = OPERATORS[name](odd.withColumns({c: F.lit("x") for c in CLASHING}), few_labels.withColumn("text", F.lit("y")))
    assert more.columns == plain.columns
    assert sorted(map(str, more.collect())) == sorted(map(str, plain.collect()))


def test_audit_of_odd_and_empty_tables(odd, few_labels):
    labels = few_labels.withColumn("quality", F.lit(1))
    plain = filter_audit.audit_filters(odd, labels)
    more = filter_audit.audit_filters(odd.withColumns({c: F.lit("x") for c in CLASHING}), labels.withColumns({"text": F.lit("y"), "mask": F.lit(1), "part": F.lit("z"), "good": F.lit(9)}))
    assert sorted(map(str, more.collect())) == sorted(map(str, plain.collect())) and plain.count() == 3 * 600 and more.columns == plain.columns
    assert filter_audit.audit_filters(odd.limit(0), labels).count() == 0
    assert {(r["good_lost"], r["toxic_lost"]) for r in filter_audit.audit_filters(odd, labels.limit(0)).collect()} == {(0, 0)}


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_and_empty_tables(spark, odd, few_labels, tmp_path, stage):
    few_labels.write.parquet(str(tmp_path / "labels.parquet"))
    name, function = corpus_pipeline.STAGES[stage]
    for docs in (odd, odd.limit(0), odd.withColumns({c: F.lit("x") for c in CLASHING})):
        out = function(spark, docs, str(tmp_path))
        out.count()
        if stage < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns


@pytest.fixture(scope="module")
def clashing_ids(spark):
    """Rows with null and repeated ids, each with a text of its own."""
    prose = lambda tag, n=60: " ".join(f"{tag}{i * i % 89}" for i in range(n))
    rows = [(1, prose("a"), "x", "s", 1), (7, prose("a"), "x", "s", 2), (7, prose("b"), "x", "s", 3), (None, prose("a"), "x", "s", 4), (None, prose("c"), "x", "s", 5), (None, prose("c") + " more", "x", "s", 6), (3, prose("c"), "x", "s", 7)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_duplicates_go_by_rows_not_by_ids(spark, clashing_ids):
    kept = corpus_pipeline.STAGES[1][1](spark, clashing_ids, "")
    assert sorted(r["n_chars"] for r in kept.collect()) == [1, 3, 7] and kept.columns == clashing_ids.columns
    nameless = corpus_pipeline.STAGES[1][1](spark, clashing_ids.filter("doc_id is null"), "")
    assert {r["n_chars"] for r in nameless.collect()} in ({4, 5}, {4, 6})


def test_mixture_samples_rows_with_null_and_repeated_ids(spark):
    rows = [(None if i % 2 else i // 4, f"some plain words {i}", "x", "s", i) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)  # one cell, so every probability is 1
    kept = corpus_pipeline.STAGES[3][1](spark, docs, "")
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[4]) == rows


def test_sanitised_rows_keep_no_identifier_of_their_own(spark):
    rows = [(None, "write to a.b@host.example today", "x", "s", 1), (1, "call me at +1 202-555-0100 now", "x", "s", 2), (1, "some quiet words here", "x", "s", 3), (1, None, "x", "s", 4), (1, "", "x", "s", 5), (None, "or to c@d.example", "x", "s", 6)]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"spans": F.lit("u"), "row": F.lit("v"), "doc": F.lit("w"), "base": F.lit("z")})
    out = personal_data.sanitise(docs)
    assert out.columns == docs.columns
    want = {1: "write to [EMAIL] today", 2: "call me at [PHONE] now", 3: "some quiet words here", 4: None, 5: "", 6: "or to [EMAIL]"}
    got = out.collect()
    assert sorted(r["n_chars"] for r in got) == [1, 1, 2, 2, 3, 4, 5, 6] and all(r["text"] == want[r["n_chars"]] and (r["spans"], r["row"], r["doc"], r["base"]) == tuple("uvwz") for r in got)


def test_pipeline_keeps_one_of_each_group_and_no_secret(spark, docs, labels, corpus, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "length", "bucket_len", "batch_id", "slot"]
    kept, rows = {i: t for i, t, *_ in corpus}, docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        rows = function(spark, rows, str(tmp_path))
    left = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert set(left) == {r["doc_id"] for r in out.collect()} and 0 < len(left) < len(kept)
    assert not any("hunter" in t or "nasty" in t for t in left.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"create view {table} as select * from '{path}/{table}.parquet'")
    want = con.sql(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, path).toPandas()[list(want.columns)]
    show = lambda df: sorted(map(str, df.itertuples(index=False)))
    assert show(got) == show(want)
