"""Filter audit, SimHash groups and periodic runs against plain rules."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsemill.llm import filter_audit, periodic_runs, simhash
from pulsemill.llm.common import words

SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def mixed(spark):
    """Texts that fail every combination of filters, copies, null and repeated ids."""
    rng = random.Random(5)
    rows = []
    for i in range(160):
        w = [f"w{rng.randrange(400 if i % 3 else 40)}" for _ in range(rng.choice([0, 3, 150, 210, 260]))]
        if i % 4 == 1:
            w += ["LOUD"] * (4 + len(w) // 8)
        if i % 5 == 2:
            w += ["#tag"]
        text = (" " if i % 2 else "\n ").join(w)
        rows.append((rng.choice([i, i, i, i % 7, None]), rng.choice([text, text, rows[-1][1] if rows else "", None if i % 9 == 0 else text]), rng.choice(["a", "b", None, ""])))
    rows += rows[:20]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def brute_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts[s or ""].append((i, {f for f, bad in fails.items() if bad}))
    out = set()
    for part, docs in parts.items():
        gone, lines = collections.Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left, removed = list(docs), []
            for k, f in enumerate(order):
                here = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in removed)
                left = [d for d in left if f not in d[1]]
                removed += here
                gone[f] += len(here)
                lines.append((order, k + 1, f, len(left), len(here), redundant, sum(d[1] == {f} for d in docs), sum(d[0] in good for d in here), sum(d[0] in toxic for d in here)))
        out |= {(part, o, k, *rest, gone[f]) for o, k, f, *rest in lines}
    return out


def test_audit_equals_applying_the_filters(spark, mixed):
    rows, labels = mixed
    out = filter_audit.audit_filters(spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = [tuple(r) for r in out.collect()]
    want = brute_audit(rows, labels)
    assert len(got) == len(want) and set(got) == want
    assert any(r[7] for r in got) and any(r[5] for r in got)


def test_audit_flags_keep_rows_apart(spark):
    text = "x " * 300
    rows = [(1, text, "a"), (1, text, "a"), (1, "other", "b"), (None, text, "a"), (None, None, None), (2, text, "a"), (3, "", "c")]
    flags = filter_audit.failure_flags(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "part", "n_words", "n_distinct", "mask").collect()
    assert sorted(map(str, map(tuple, flags))) == sorted(map(str, [(1, "a", 300, 1, 2), (1, "a", 300, 1, 2), (1, "b", 1, 1, 1), (None, "a", 300, 1, 2), (None, "", 0, 0, 1), (2, "a", 300, 1, 18), (3, "c", 0, 0, 1)]))


def brute_print(text, n):
    w = words(text, lower=True)
    if not w:
        return 0
    grams = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    bits = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def brute_components(prints):
    """Smallest id of each row's component; prints: (id, fingerprint) rows."""
    label = {p: p for _, p in prints}
    values = sorted(label)

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for x, y in itertools.combinations(values, 2):
        if (x ^ y).bit_count() <= 2:
            label[top(x)] = top(y)
    least = {}
    for i, p in prints:
        if i is not None:
            least[top(p)] = min(i, least.get(top(p), i))
    return [least.get(top(p)) for _, p in prints]


def test_fingerprints_equal_plain_counts():
    rng = random.Random(1)
    texts = [None, "", " \n", "one", "Two WORDS", "é ß 😀", "a b c a b c a b c", " ".join(rng.choices("abcdefgh", k=500)), "\tx  y\nz\x0bq\x0c r\r"]
    for text in texts:
        for n in (1, 3, 5):
            assert simhash.fingerprint(text, n) == brute_print(text, n)


def test_spark_hashes_alike(spark):
    grams = ["one two three", "é ß 😀", "a" * 7, "b" * 100]
    got = spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g")).collect()
    assert [r[0] % 2**64 for r in got] == [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]


@pytest.mark.parametrize("cell", [512, 3, 1])
def test_links_equal_brute_force(spark, cell):
    """Chains, clusters and lone values; with small cells most go through shared values."""
    rng = random.Random(cell)
    values = {0, 1, 3, (1 << 64) - 1, (1 << 64) - 2}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            values.add(x)
            for _ in range(rng.choice([1, 2, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
    values |= {rng.getrandbits(64) for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.close_pairs(spark.createDataFrame([(v,) for v in signed], "print long"), cell=cell).collect()]
    assert all(0 < (a ^ b).bit_count() <= 2 for a, b in pairs)
    label = {v: v for v in values}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        label[top(a)] = top(b)
    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            assert top(a) == top(b)
    if cell == 512:
        assert {frozenset(p) for p in pairs} == {frozenset(p) for p in itertools.combinations(values, 2) if (p[0] ^ p[1]).bit_count() <= 2}


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(3)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "x long, y long")
    for r in df.select("x", "y", simhash.embedding(F.col("x")).alias("u"), simhash.embedding(F.col("y")).alias("v")).collect():
        counts = lambda b: [(b >> 2 * i & 3).bit_count() for i in range(32)]
        assert counts(r["u"] % 2**64) == counts(r["x"])
        manhattan = sum(abs(a - b) for a, b in zip(counts(r["x"]), counts(r["y"])))
        assert manhattan == ((r["u"] ^ r["v"]) % 2**64).bit_count() <= (r["x"] ^ r["y"]).bit_count()


def test_groups_equal_brute_force(spark, corpus):
    rows = [(i, t) for i, t, *_ in corpus] + [(None, corpus[0][1]), (500, None), (501, ""), (3, corpus[10][1]), (None, "alone here")]
    rows += [(600 + k, " ".join(corpus[20][1].split()[:-1] + [f"v{k}"])) for k in range(20)]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=3).collect()
    prints = [(i, brute_print(t, 3)) for i, t in rows]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert len({c for _, _, c in want}) < len(rows) - 10


def brute_runs(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                run = w[i : j + q]
                if all(any(run[k] != run[k + p] for k in range(len(run) - p)) for p in range(1, q)):
                    found[i, q] = (i, j + q - i, q)
            i = j + 1
    return [found[k] for k in sorted(found)]


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for trial in range(300):
        alphabet = rng.choice([1, 2, 3, 8, 40])
        w = []
        while len(w) < rng.choice([10, 60, 200, 400]):
            block = [rng.randrange(alphabet) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33]))]
            repeated = block * rng.choice([1, 1, 2, 3, 4, 9])
            w += repeated[: len(repeated) - rng.randrange(len(block))]
        _, ids = np.unique(w, return_inverse=True)
        assert periodic_runs.find_runs(ids) == brute_runs(w), trial
        assert periodic_runs.find_runs(ids, 6, 3) == brute_runs(w, 6, 3), trial
        assert periodic_runs.find_runs(ids, 10, 4) == brute_runs(w, 10, 4), trial


def test_long_runs_take_little_time():
    for w in ([0] * 60_000, [0, 1] * 30_000, list(range(9_000)) * 6, [int(b) for i in range(20_000) for b in f"{i & -i:b}"][:60_000]):
        runs = periodic_runs.find_runs(np.array(w))
        assert all(n >= max(24, 3 * q) for _, n, q in runs)
    assert periodic_runs.find_runs(np.array([0] * 60_000)) == [(0, 60_000, 1)]
    assert periodic_runs.find_runs(np.array(list(range(9_000)) * 6)) == [(0, 54_000, 9_000)]


def brute_digest(doc_id, text):
    w = words(text, lower=False)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] * 10**12 // r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()


def test_run_digests_equal_brute_force(spark, corpus):
    rows = [(i, t) for i, t, *_ in corpus] + [(i, f"start {i} " + "again and again " * (i % 30)) for i in range(200, 320)]
    rows += [(None, "x " * 40), (None, None), (7, ""), (8, " \n"), (9, "y " * 30 + "z"), (9, "y " * 30 + "z")]
    out = periodic_runs.run_digests(periodic_runs.planted(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(str(tuple(r)) for r in out.collect())
    assert got == sorted(str(brute_digest(i, t)) for i, t in rows)
    assert sum(brute_digest(i, t)[1] > 0 for i, t in rows[:120]) > 3
