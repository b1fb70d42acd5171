import collections
import itertools
import math
import zlib

import numpy as np
import pandas as pd
import pytest

from pulsemill.llm import lm_scoring, mixing, packing, quality_rules, toxicity


def test_margins_meet_their_targets(docs):
    out = mixing.mix_sources(docs, sweeps=16).toPandas()
    assert out["probability"].max() == 1 and (out["probability"] > 0).all()
    out["mass"] = out["probability"] * out["n_tokens"]
    for dim in mixing.DIMS:
        have = out.groupby(dim)["mass"].sum() / out["mass"].sum()
        want = out.groupby(dim)["n_tokens"].sum() ** mixing.TEMPERATURE
        assert np.allclose(have, want / want.sum(), atol=1e-5)


def test_given_targets_are_met(spark, docs):
    t = lambda rows, dim: spark.createDataFrame(rows, f"{dim} string, target double")
    own = mixing.mix_sources(docs).toPandas()
    targets = {"source": t([(s, 0.25) for s in own["source"].unique()], "source"), "lang": t([("a", 0.7), ("b", 0.3)], "lang"), "topic": t([(x, 1.0 / own["topic"].nunique()) for x in own["topic"].unique()], "topic")}
    out = mixing.mix_sources(docs, targets, sweeps=25).toPandas()
    out["mass"] = out["probability"] * out["n_tokens"]
    assert abs((out.groupby("lang")["mass"].sum() / out["mass"].sum())["a"] - 0.7) < 1e-3


def test_bounds_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 40), 8, replace=False))
        counts = rng.integers(1, 9, 8)
        for k in (1, 2, 3, 8, 12):
            bounds = packing.optimal_bounds(lengths, counts, k)
            cost = lambda b: sum(c * min(x for x in b if x >= n) for n, c in zip(lengths, counts))
            best = min(cost((*some, lengths[-1])) for some in itertools.combinations(lengths[:-1], min(k, 8) - 1))
            assert cost(bounds) == best and len(bounds) <= k


def test_batches_are_full_and_whole(docs, corpus, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 10)
    out = packing.pack(docs, max_len=50, buckets=4, token_budget=300).toPandas()
    want = collections.Counter({i: len(t.split()) for i, t, *_ in corpus})
    assert out.groupby("doc_id")["length"].sum().to_dict() == want and (out["length"] <= out["bucket_len"]).all()
    assert not out.duplicated(["batch_id", "slot"]).any()
    for bucket, rows in out.groupby("bucket_len"):
        sizes = rows.groupby("batch_id").size().sort_values(ascending=False)
        room = 300 // bucket
        assert (sizes.iloc[:-1] == room).all() and sizes.iloc[-1] <= room


def brute_unigrams(corpus):
    c, tokens = collections.Counter(), {}
    for i, t, *_ in corpus:
        tokens[i] = t.encode().lower().split() + [None]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(tokens[i])
    return c, tokens


@pytest.mark.parametrize("frequent", [1_000_000, 30])
def test_base_scores(docs, corpus, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    c, tokens = brute_unigrams(corpus)
    n, v = sum(c.values()), len(c)
    for r in lm_scoring.score_texts(docs).collect():
        w = tokens[r["doc_id"]]
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(c[x] > 0 for x in w) and r["train_tokens"] == n
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_model_is_better_than_its_base_on_structured_text(spark):
    rng = np.random.default_rng(0)
    follows = {i: rng.integers(0, 40, 3) for i in range(40)}

    def text():
        w = [0]
        for _ in range(120):
            w.append(int(rng.choice(follows[w[-1]])))
        return " ".join(f"t{x}" for x in w)

    out = lm_scoring.score_texts(spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")).toPandas()
    held = out[out["held_out"]]
    assert len(held) > 20 and (held["score"] > held["base_score"] + 50).mean() > 0.95


@pytest.mark.parametrize("frequent, max_bits", [(1_000_000, 1 << 28), (1_000_000, 0), (1_000_000, 2000), (30, 1 << 28), (30, 0), (0, 0)])
def test_every_bigram_counts(docs, corpus, monkeypatch, frequent, max_bits):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    monkeypatch.setattr(lm_scoring, "MAX_BITS", max_bits)
    c, tokens = brute_unigrams(corpus)
    n, v = sum(c.values()), len(c)
    pairs = collections.Counter(p for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for p in itertools.pairwise(w))
    # Each text's first word follows an end token, too.
    pairs.update((None, w[0]) for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2)
    level = lambda k: float(lm_scoring.count_of(lm_scoring.quantised(np.array([k])))[0])
    mass = collections.Counter()
    for (a, _), k in pairs.items():
        mass[a] += level(k) - lm_scoring.D
    mix, p = lm_scoring.MIX, lambda w: (c[w] + 1) / (n + v + 1)

    def after(a, b):
        k, norm = pairs[a, b], max(c[a], mass[a], 1)
        seen = level(k) - lm_scoring.D if k else 0
        return mix * seen / norm + (mix * (1 - mass[a] / norm) + 1 - mix) * p(b)

    for a in list(c)[::50]:  # over the vocabulary and one word for all unknown ones
        assert math.isclose(sum(after(a, b) for b in c) + after(a, "unknown"), 1, rel_tol=1e-9)
    out = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs).collect()}
    want = {i: sum(math.log10(after(a, b)) for a, b in itertools.pairwise([None, *w])) for i, w in tokens.items()}
    equal = np.array([math.isclose(out[i], want[i], rel_tol=1e-9) for i in want])
    assert equal.mean() > 0.8 if max_bits else equal.all()  # the filter may take some bigrams for others
    assert np.allclose([out[i] for i in want], list(want.values()), rtol=0.05)


def test_no_bigram_is_a_row_of_its_own(spark, monkeypatch):
    """Rare bigrams used to be joined as rows: executors ran out of memory over half a gigabyte of text."""
    monkeypatch.setattr(lm_scoring, "FREQUENT", 30)
    docs = spark.createDataFrame([(i if i else None, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(60)] + [(2**60 + 1, "w2x1 new")], "doc_id long, text string")
    out = lm_scoring.score_texts(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == 61 and rows[2**60 + 1]["n_known"] == 2 and rows[None]["n_known"] == 1
    assert rows[2]["n_known"] == rows[2]["n_tokens"] == 41


def test_the_driver_collects_numbers_only(docs, monkeypatch):
    """The words and the filter come a partition at a time, so the JVM never holds them as one result."""
    kind, collected = type(docs), []
    monkeypatch.setattr(kind, "collect", lambda self, f=kind.collect: collected.append(rows := f(self)) or rows)
    lm_scoring.score_texts(docs)
    assert collected and not any(isinstance(x, (bytes, bytearray)) for rows in collected for r in rows for x in r)


@pytest.mark.parametrize("spare", [True, False])
def test_pieces_are_put_together_once_and_go(spare):
    words = lm_scoring.Frequent(np.arange(100, dtype=np.uint64), np.arange(1, 101))
    sizes, rng = (128, 64), np.random.default_rng(3)
    parts = {s: rng.bytes(sizes[s // 64] // 8) for s in (0, 7, 63, 64, 100, 127)}
    mass = rng.random(128)
    parts |= {-1 - s: mass[2 * s : 2 * s + 2].tobytes() for s in range(50)}
    pieces = lm_scoring.Pieces(dict(parts), sizes, spare, 21, 3, 4, False)
    model = pieces.model(words)
    assert not pieces.built and pieces.model(words) is model
    assert (model.mass == mass[:100]).all() and model.cutoff == 4 and model.others is False
    assert model.filter.tobytes() == b"".join(parts.get(s, bytes(16)) for s in range(64))
    assert model.spare.tobytes() == b"".join(parts.get(s, bytes(8)) for s in range(64, 128)) if spare else model.spare is None


def test_texts_learnt_from_do_not_ask_for_bigrams_found_once():
    """Every bigram that the filter left out used to be asked for, so the shuffle grew faster than the table once the filter was full."""
    texts = pd.DataFrame({"row": [0, 1, 2], "doc_id": ["5", "6", None], "text": ["a b", "b a", "a a"], "held_out": [False, True, False]})
    table = lm_scoring.Frequent(np.unique(lm_scoring._tokens(texts["text"])[0]), np.array([9, 7, 5]))
    empty = np.zeros(1 << 13, np.uint8)
    model = lambda spare: lm_scoring.Model(table, empty, spare, np.full(3, 1.0), 21, 3, 4, False)
    (asked, keys), *_, (_, own) = lm_scoring._scored(texts, model(empty))
    assert asked.tolist() == [1] * 3 + [2] * 3 and len(keys) == 6
    (everyone, all_keys), *_, (_, plain) = lm_scoring._scored(texts, model(None))
    assert everyone.tolist() == [0] * 3 + [1] * 3 + [2] * 3
    score, bare = own[:, 7].copy().view(float), plain[:, 7].copy().view(float)
    once = model(None).bonus(all_keys[:3], np.ones(3, int)).sum()
    assert math.isclose(score[0], bare[0] + once) and (score[1:] == bare[1:]).all()


@pytest.mark.parametrize("cutoff, spare_each", [(2, 4), (3, 4), (4, 0), (4, 10_000_000)])
def test_what_is_not_asked_for_scores_as_lookups_do(spark, docs, corpus, monkeypatch, cutoff, spare_each):
    monkeypatch.setattr(lm_scoring, "SPARE_EACH", spare_each)
    pairs = collections.Counter()
    for i, w in brute_unigrams(corpus)[1].items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            pairs.update(itertools.pairwise([None, *w]))
    q = np.maximum(lm_scoring.quantised(np.array(list(pairs.values()))) - cutoff + 1, 0)  # counts to 4 are levels of their own
    assert (q == 0).any() and (q > 0).any()
    scores = {}
    for max_bits in (0, int(q.sum()) * lm_scoring.BITS_EACH):
        monkeypatch.setattr(lm_scoring, "MAX_BITS", max_bits)
        scores[max_bits] = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs).collect()}
    looked_up, filtered = ([s[i] for i in sorted(s)] for s in scores.values())
    assert np.isclose(looked_up, filtered, rtol=1e-9).mean() > 0.8 and np.allclose(looked_up, filtered, rtol=0.05)


@pytest.mark.parametrize("values", [[], [7], [2**64 - 1], [0, 2**64 - 1], [5, 3, 9], [3, 3, 2**40]])
def test_packed_numbers_are_opened(values):
    keys = np.array(values, np.uint64)
    assert lm_scoring._opened(lm_scoring._packed(keys), np.uint64).tolist() == values
    signed = keys.view(np.int64)
    assert (lm_scoring._opened(lm_scoring._packed(signed)) == signed).all()
    rows = np.stack([signed, signed[::-1]], axis=1)
    assert (lm_scoring._opened(lm_scoring._packed(rows), width=2) == rows).all()


def test_sorted_bigrams_take_few_bytes():
    table = lm_scoring.Frequent(np.arange(1_000_000, dtype=np.uint64), np.ones(1_000_000))
    index = np.random.default_rng(0).integers(0, 1_000_000, 30_001)
    keys = np.sort(table.pair_keys(index, table.pairs(index)))
    assert len(lm_scoring._packed(keys)) < 4.1 * len(keys)  # was 7 bytes each
    assert (lm_scoring._opened(lm_scoring._packed(keys), np.uint64) == keys).all()


def test_filter_reads_counts_back():
    keys = np.arange(1, 2001, dtype=np.uint64) * np.uint64(977)
    counts = np.random.default_rng(0).integers(1, 5000, 2000)
    q = lm_scoring.quantised(counts)
    n_bits = 1 << 19
    bits = np.zeros(n_bits, np.uint8)
    for level in range(1, int(q.max()) + 1):
        for p in lm_scoring.bits_of(keys[q >= level], level, n_bits):
            bits[p.astype(np.int64)] = 1
    data = np.packbits(bits, bitorder="little")
    got = lm_scoring.probe(data, keys)
    assert (got >= q).all() and (got == q).mean() > 0.98
    assert (lm_scoring.probe(data, keys + np.uint64(1)) == 0).mean() > 0.98
    assert np.allclose(np.log(lm_scoring.count_of(q) / counts), 0, atol=np.log(lm_scoring.BASE))
    assert lm_scoring.count_of(lm_scoring.quantised(np.arange(4))).tolist() == [0, 1, 2, 3]
    assert 1 <= lm_scoring.quantised(np.array([2**62]))[0] <= lm_scoring.LEVELS


def test_neighbours_are_exact():
    rng = np.random.default_rng(0)
    terms = [f"t{i}" for i in range(60)]
    examples = [(i, int(i % 7 == 0), *zip(*[(terms[j], int(rng.integers(1, 5))) for j in rng.choice(60, rng.integers(1, 9), replace=False)])) for i in range(700)]
    index = toxicity.Index(terms, rng.random(60) + 0.5, examples)
    dense = np.zeros((len(index.ids), 60))
    by_id = {e[0]: e for e in examples}
    for row, i in enumerate(index.ids):
        t, v = index.vector(dict(zip(by_id[i][2], by_id[i][3])))
        dense[row, t] = v
    for i in range(0, 700, 13):
        t, v = index.vector(dict(zip(by_id[i][2], by_id[i][3])))
        at, cosines = index.nearest(t, v, 15)
        q = np.zeros(60)
        q[t] = v
        want = np.sort(dense @ q)[::-1][:15]
        assert np.allclose(cosines, want[: len(cosines)]) and np.allclose(dense[at] @ q, cosines)


def test_toxic_words_are_learnt(docs, labels, corpus):
    toxic = {i: "nasty" in t for i, t, *_ in corpus}
    out = toxicity.score_toxicity(docs, labels).toPandas()
    held = out[out["held_out"]]
    assert ((held["predicted"] == 1) == held["doc_id"].map(toxic)).mean() > 0.9
    assert out["score"].between(0, 1).all()
    kept = {r["doc_id"] for r in toxicity.reject_toxic(docs, labels).collect()}
    assert len(kept & {i for i, t in toxic.items() if not t}) > 0.95 * sum(not t for t in toxic.values())


def judged_table(spark, rows):
    return spark.createDataFrame([(h, f, False, False, False) for h, f in rows], "host string, short boolean, repeats boolean, symbols boolean, dup_lines boolean")


def test_host_rates_are_shrunk(spark):
    rows = [("a", i < 50) for i in range(100)] + [("b", i < 5) for i in range(100)] + [("c", True)] + [(f"h{j}", i < 10) for j in range(20) for i in range(100)]
    got = {r["host"]: r for r in quality_rules.host_verdicts(judged_table(spark, rows)).collect()}
    m = sum(f for _, f in rows) / len(rows)
    assert m < got["a"]["host_rate"] < 0.5
    assert got["a"]["worst_rule"] == "short" and not any(r["host_rejected"] for r in got.values())


def test_many_small_hosts_shrink_by_what_sampling_leaves(spark):
    rng = np.random.default_rng(5)
    same = [(f"h{j}", bool(rng.random() < 0.3)) for j in range(4000) for _ in range(1 + j % 3)]
    rates = [r["host_rate"] for r in quality_rules.host_verdicts(judged_table(spark, same)).collect() if r["worst_rule"] == "short"]
    assert len(rates) > 500 and np.std(rates) < 0.05  # hosts of one to three documents that differ by chance alone are all near the corpus rate
    p = {j: rng.beta(0.6, 1.4) for j in range(4000)}
    unlike = [(f"h{j}", bool(rng.random() < p[j])) for j in p for _ in range(1 + j % 3)]
    m = np.mean([f for _, f in unlike])
    by_host = collections.defaultdict(list)
    for h, f in unlike:
        by_host[h].append(f)
    for r in quality_rules.host_verdicts(judged_table(spark, unlike)).collect():
        k, n = sum(by_host[r["host"]]), len(by_host[r["host"]])
        assert r["worst_rule"] != "short" or abs(r["host_rate"] - (k + 2 * m) / (n + 2)) < 0.05  # strength 0.6 + 1.4


def test_a_bad_host_loses_its_good_documents(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "bad") for i in range(100)] + [(1000 + i, good, "fine") for i in range(100)]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    assert not out[out["doc_id"] < 1000]["kept"].any() and out[out["doc_id"] >= 1000]["kept"].all()


def test_counts_of_one_text(spark):
    text = "a b c d\na b c e\n\na b c d\n" + "#x *y " + " ".join(f"w{i}" for i in range(60))
    r = quality_rules.text_counts(spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")).first()
    assert (r["n_words"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (74, 2, 1, 11)
    assert r["word_chars"] == sum(map(len, text.split()))


@pytest.mark.parametrize("examples", [12_000, 40])
def test_toxicity_scores_equal_brute_force(docs, labels, corpus, examples, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_CHI2", 3.0)
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    index = toxicity.fit_index(docs.filter("crc32(string(doc_id)) % 4 <> 2").select("doc_id", "text"), labels, examples=examples)
    text = {i: t for i, t, *_ in corpus}
    marked = [i for i in text if i % 5 and zlib.crc32(str(i).encode()) % 4 != 2]
    chosen = set(marked) if examples > len(marked) else set(index.ids.tolist())
    assert len(chosen) >= len(index.ids) and chosen <= set(marked)
    count = {i: toxicity.terms_of(text[i], index.number) for i in chosen}
    idf = {t: index.idf[k] for t, k in index.number.items()}

    def unit(c):
        w = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()} if norm else {}

    vectors = {i: unit(c) for i, c in count.items()}
    for i, t in text.items():
        own = unit(toxicity.terms_of(t, index.number))
        cosine = sorted(((sum(x * v.get(term, 0) for term, x in own.items()), j) for j, v in vectors.items()), reverse=True)
        at, got = index.nearest(*index.vector_of(t), toxicity.K)
        want = [c for c, _ in cosine[: toxicity.K] if c > 0]
        assert np.allclose(got, want)
        by_id = {j: c for c, j in cosine}
        assert np.allclose([by_id[j] for j in index.ids[at].tolist()], got) and len(set(at.tolist())) == len(at)
        assert all(x > y or (x == y and a < b) for x, y, a, b in zip(got, got[1:], at, at[1:]))  # ties by place


def test_terms_are_kept_by_their_test_alone(spark):
    rows = [(i, f"plain words {'bad' if i % 2 else 'good'}{'abcdefghij'[i // 2 % 10]} {'vile' if i % 2 else 'kind'}", i % 2) for i in range(2000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    index = toxicity.fit_index(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert {"bada", "goodj", "vile", "kind"} <= set(index.number) and "plain" not in index.number


def test_the_bound_on_examples_is_taken_from_documents_that_are_there(spark):
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'kind'} words{i % 7}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, toxic int")
    index = toxicity.fit_index(docs, labels, examples=50)
    assert len(index.ids) == 50 and set(index.ids.tolist()) <= set(range(60))
