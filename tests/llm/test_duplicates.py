import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from pulsemill.llm import common, near_dedup, substring_dedup


def words(text, lower=True):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def brute_components(corpus, n, pct):
    sets = {i: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()) for i, w in ((i, words(t)) for i, t, *_ in corpus)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("n, pct", [(3, 85), (5, 80)])
def test_components_equal_brute_force(docs, corpus, n, pct):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, n, pct).collect()}
    assert got == brute_components(corpus, n, pct)
    assert len({c for _, c in got.values()}) < len(got)


def test_a_chain_is_one_component_and_its_ends_are_not_linked(spark):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):  # each differs from the one before by four words, so neighbours are linked and the ends are not
        rows.append((100 - i, " ".join(base)))
        base = base[:]
        base[i * 12 : i * 12 + 4] = [f"x{i}{k}" for k in range(4)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    want = brute_components(rows, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_prefix_pairs_find_links_that_a_star_misses(spark):
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 30):
        w = list(base)
        for k in rng.choice(120, 7, replace=False):
            w[k] = f"e{i // 2}-{k}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.selectExpr("doc_id", "doc_id as label")
    sets = near_dedup.shingle_sets([t for _, t in rows], 3)
    bitmaps = spark.createDataFrame([(i, len(x), near_dedup.parity_bitmap(x).tolist()) for i, x in enumerate(sets)], "doc_id long, size long, bitmap array<long>")
    pairs = {(r["a"], r["b"]) for r in near_dedup.prefix_pairs(df, labels, bitmaps, 3, 85).collect()}
    for a in range(30):
        for b in range(a + 1, 30):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in pairs


def test_densification_keeps_the_collision_rate():
    rng = np.random.default_rng(0)
    for size in (3, 20, 400):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(size * 0.9)], rng.integers(0, 1 << 63, size - int(size * 0.9)).astype(np.uint64)]))
        share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = (near_dedup.one_permutation(a) == near_dedup.one_permutation(b)).mean()
        assert abs(same - share) < 0.2


def test_word_hashes_do_not_depend_on_neighbours():
    texts = ["Aa bb\tcc", None, "", "  cc  aa\n", "x" * 3_000_000 + " aa"]
    h = common.token_hashes(texts, lower=True)
    assert [len(x) for x in h] == [3, 0, 0, 2, 2]
    assert h[0][0] == h[3][1] == h[4][1] and h[0][2] == h[3][0]
    assert common.token_hashes(["Aa"], lower=False)[0][0] != h[0][0]


def brute_removed(corpus, window):
    seen = collections.Counter()
    cut = {i: words(t, False) for i, t, *_ in corpus}
    for w in cut.values():
        seen.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    out = {}
    for i, w in cut.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def test_removed_passages_equal_brute_force(docs, corpus):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == brute_removed(corpus, 35)
    assert sum(n for _, n, _ in got.values())


def test_overlapping_and_periodic_windows(spark):
    rows = [(1, " ".join(["a", "b"] * 40)), (2, " ".join(f"u{i}" for i in range(35))), (3, "z " + " ".join(f"u{i}" for i in range(36))), (4, " ".join(f"u{i}" for i in range(34)))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_removed(rows, 35)


def thue_morse(steps):
    text = "a"
    for _ in range(steps):
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("steps", [3, 6, 10, 11, 12])
def test_words_and_runs_that_fool_polynomials_differ(steps):
    x = thue_morse(steps)
    y = x.translate(str.maketrans("ab", "ba"))
    for seed in (0, 1):
        a, b = common.token_hashes([x, y], lower=False, seed=seed)
        assert a[0] != b[0]
        a, b = common.token_hashes([" ".join(x), " ".join(y)], lower=False, seed=seed)
        assert common.gram_hashes(a, len(x))[0] != common.gram_hashes(b, len(x))[0]


def test_arrow_and_plain_texts_hash_alike():
    texts = ["skipped", "Aa bb\tcc", None, "", " é " + "x" * 70, "ab"]
    for lower in (True, False):
        plain = common.token_hashes(texts[1:], lower)
        arrow = common.token_hashes(pa.array(texts).slice(1), lower)
        assert all((a == b).all() for a, b in zip(plain, arrow)) and [len(a) for a in arrow] == [3, 0, 0, 2, 1]
    assert common.token_hashes(["ab"], True)[0] != common.token_hashes(["ab"], True, seed=1)[0]


def test_hot_keys_join_like_others(spark):
    left = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(300)] + [(1000, None)], "id long, k long")
    right = left.filter("k is not null").groupBy("k").count()
    got = common.skew_join(left, right, ["k"], "count").collect()
    assert len(got) == 301 and all(r["count"] == (200 if r["k"] == 7 else None if r["k"] is None else 1) for r in got)
