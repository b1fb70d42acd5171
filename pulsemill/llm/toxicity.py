"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are the letters-only words of a text and their beginnings of four and five letters. The vocabulary is every term that
tells the labels apart by a chi-square test over the labelled examples' documents, however many these are. The examples' weights are kept in an
inverted index whose postings are cut into blocks of examples; each block holds its largest weight for each term. For a
text, the sums of its weights and those maxima bound the cosines inside each block, so blocks are visited by falling bound
until none can hold a nearer example than the K found: the neighbours are exact.

Neighbours vote with weights that fall with their distance; a logistic curve, fitted on votes that leave each example out,
turns votes into probabilities. Neighbours are kept as evidence. The index and the curve are fitted on EXAMPLES labelled
rows at most, the first by a hash of their ids; every document is scored in full.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHARS, broadcast_if_small, cut, slices

#: Bound on the labelled rows that the index and the curve are fitted on.
EXAMPLES = 12_000
#: Labelled documents a term must be in, and the chi-square it must reach.
LEAST_DOCS = 4
LEAST_CHI2 = 12.0
K = 15
BLOCK = 64
#: Blocks that are read first, for a bound on the others.
HEAD = 2
THRESHOLD = 0.3
#: Votes of no neighbour: strength of the share of toxic examples among those without any term of the vocabulary.
PRIOR = 0.5

#: Words whose terms a task remembers.
WORDS_KEPT = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def _terms(word: str) -> list[str]:
    """A word and its first four and five letters, marked by a dash."""
    return [word, *(f"{word[:n]}-" for n in (4, 5) if len(word) > n)]


def terms_of(text: str | None, among=None) -> dict[str, int]:
    """Counts of the words and their beginnings; only those in `among` if it is given."""
    out: dict[str, int] = {}
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for term in _terms(word):
            if among is None or term in among:
                out[term] = out.get(term, 0) + n
    return out


def _labelled_terms(batches):
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        rows = [(y, t) for y, text in zip(pdf["toxic"], pdf["text"]) for t in terms_of(text)]
        yield pd.DataFrame(rows, columns=["toxic", "term"])


def _labelled_counts(batches, vocabulary: frozenset):
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        rows = []
        for doc_id, y, text in zip(pdf["doc_id"], pdf["toxic"], pdf["text"]):
            found = terms_of(text, vocabulary)
            rows.append((doc_id, y, list(found), list(found.values())))
        yield pd.DataFrame(rows, columns=["doc_id", "toxic", "terms", "counts"])


class Index:
    """Block-max inverted index of the labelled examples."""

    def __init__(self, terms: list[str], idf: np.ndarray, examples: list[tuple[int, int, list[str], list[int]]]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.by_word: dict[str, tuple[int, ...]] = {}
        self.idf = idf
        vectors = [self.vector(dict(zip(t, c))) for _, _, t, c in examples]
        # Examples with the same strongest term stand together, so their blocks' maxima are tight.
        order = sorted((i for i, (t, _) in enumerate(vectors) if len(t)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), examples[i][0]))
        bare = [examples[i][1] for i, (t, _) in enumerate(vectors) if not len(t)]
        share = sum(y for *_, y in [e[:2] for e in examples]) / max(1, len(examples))
        self.bare_rate = (sum(bare) + share) / (len(bare) + 1)
        self.ids = np.array([examples[i][0] for i in order], np.int64)
        self.toxic = np.array([examples[i][1] for i in order], np.float64)
        self.blocks = -(-len(order) // BLOCK)
        term = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, np.int64)])
        weight = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by = np.lexsort((place, term))
        self.weight, self.place = weight[by], place[by].astype(np.int64)
        self.block = self.place // BLOCK
        cell = term[by] * max(1, self.blocks) + self.block
        self.edges = np.searchsorted(cell, np.arange(len(terms) * max(1, self.blocks) + 1))
        self.maxima = np.zeros(len(terms) * max(1, self.blocks))
        np.maximum.at(self.maxima, cell, self.weight)
        self.maxima = self.maxima.reshape(len(terms), max(1, self.blocks))
        self.slope, self.shift = 1.0, 0.0

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit-length TF-IDF weights."""
        at = np.array(sorted(self.number[t] for t in counts if t in self.number), np.int64)
        if not len(at):
            return at, np.zeros(0)
        by_number = {self.number[t]: n for t, n in counts.items() if t in self.number}
        w = (1 + np.log([by_number[i] for i in at])) * self.idf[at]
        return at, w / np.sqrt((w * w).sum())

    def vector_of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """vector() of a text's terms; which terms a word has is remembered."""
        found: dict[int, int] = {}
        if len(self.by_word) > WORDS_KEPT:
            self.by_word.clear()
        for word, n in Counter(_WORD.findall((text or "").lower())).items():
            own = self.by_word.get(word)
            if own is None:
                own = self.by_word[word] = tuple(self.number[t] for t in _terms(word) if t in self.number)
            for i in own:
                found[i] = found.get(i, 0) + n
        at = np.array(sorted(found), np.int64)
        if not len(at):
            return at, np.zeros(0)
        w = (1 + np.log([found[i] for i in at.tolist()])) * self.idf[at]
        return at, w / np.sqrt((w * w).sum())

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples; equal cosines by place. but: a place to leave out.

        The blocks with the largest bounds give a k-th best cosine first; then all blocks whose bounds reach it are added up
        in one pass over the terms' postings.
        """
        if not self.blocks or not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.maxima[terms]
        first = np.argsort(-bounds, kind="stable")[:HEAD]
        cosines = self._summed(terms, weights, first)
        if but >= 0:
            cosines[but] = 0
        best = np.sort(cosines[(first[:, None] * BLOCK + np.arange(BLOCK)).ravel()])[::-1]
        least = best[k - 1] if len(best) >= k else 0.0
        rest = (bounds > 0) & (bounds >= least - 1e-12)
        rest[first] = False
        if rest.any():
            few = 2 * np.count_nonzero(rest) < self.blocks  # beyond that, whole postings are read faster than pieces of them
            cosines = cosines + self._summed(terms, weights, np.nonzero(rest)[0]) if few else self._whole(terms, weights)
            if but >= 0:
                cosines[but] = 0
        at = np.nonzero(cosines)[0]
        if len(at) > k:
            kth = np.partition(cosines[at], len(at) - k)[len(at) - k]
            at = at[cosines[at] >= kth]
        at = at[np.lexsort((at, -cosines[at]))][:k]
        return at, cosines[at]

    def _summed(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines of all examples from the postings of some blocks: the ranges of the terms in the blocks are laid end to end."""
        cells = (terms[:, None] * self.blocks + blocks).ravel()
        starts, sizes = self.edges[cells], self.edges[cells + 1] - self.edges[cells]
        ends = np.cumsum(sizes)
        posting = np.arange(ends[-1]) + np.repeat(starts + sizes - ends, sizes)
        by_term = np.add.reduceat(sizes, np.arange(0, len(cells), len(blocks)))
        return np.bincount(self.place[posting], weights=np.repeat(weights, by_term) * self.weight[posting], minlength=self.blocks * BLOCK)

    def _whole(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines of all examples from the terms' whole postings."""
        ranges = list(zip(weights.tolist(), self.edges[terms * self.blocks].tolist(), self.edges[(terms + 1) * self.blocks].tolist()))
        return np.bincount(np.concatenate([self.place[i:j] for _, i, j in ranges]), weights=np.concatenate([w * self.weight[i:j] for w, i, j in ranges]), minlength=self.blocks * BLOCK)

    def votes(self, at: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic votes; a neighbour's vote falls with its distance, and a constant vote stands for the bare rate."""
        w = cosines / (1.05 - np.minimum(cosines, 1.0))
        return float((w @ self.toxic[at] + PRIOR * self.bare_rate) / (w.sum() + PRIOR))

    def score(self, vote: float) -> float:
        v = min(max(vote, 1e-4), 1 - 1e-4)
        return 1 / (1 + math.exp(-(self.slope * math.log(v / (1 - v)) + self.shift)))

    def fit(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve over the votes' log odds by Newton steps, with a weak pull to the identity."""
        v = np.clip(votes, 1e-4, 1 - 1e-4)
        x = np.stack([np.log(v / (1 - v)), np.ones(len(v))], axis=1)
        beta, pull = np.array([1.0, 0.0]), 1.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-(x @ beta)))
            gradient = x.T @ (labels - p) - pull * (beta - [1.0, 0.0])
            hessian = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2)
            beta = beta + np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        self.slope, self.shift = max(float(beta[0]), 0.1), float(beta[1])


def _score(batches, index, k: int, threshold: float):
    ix = index.value
    bare = ix.score(ix.bare_rate)
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        rows = []
        for text in pdf["text"]:
            terms, weights = ix.vector_of(text)
            if not len(terms):
                rows.append((bare, int(bare >= threshold), [], []))
                continue
            at, cosines = ix.nearest(terms, weights, k)
            score = ix.score(ix.votes(at, cosines))
            rows.append((score, int(score >= threshold), ix.ids[at], np.round(cosines, 6)))
        done = pd.DataFrame(rows, columns=["score", "predicted", "nearest", "cosines"])
        yield pd.concat([pdf.drop(columns="text").reset_index(drop=True), done], axis=1).astype({"doc_id": "Int64"})


def _leave_one_out(batches, index, k: int):
    ix = index.value
    place = {int(d): i for i, d in enumerate(ix.ids)}
    for pdf in batches:
        votes = []
        for doc_id, terms, counts in zip(pdf["doc_id"], pdf["terms"], pdf["counts"]):
            at, cosines = ix.nearest(*ix.vector(dict(zip(terms, counts))), k, place.get(int(doc_id), -1))
            votes.append(ix.votes(at, cosines))
        yield pd.DataFrame({"toxic": pdf["toxic"], "vote": votes})


def fit_index(docs: DataFrame, labels: DataFrame, k: int = K, examples: int = EXAMPLES) -> Index:
    """Index over the labelled rows of docs(doc_id, text); labels(doc_id, toxic).

    Null labels are left out; of repeated labels the largest counts, and of the texts of a repeated id the first by order.
    """
    spark = docs.sparkSession
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # Of the labelled documents that are there, those with the smallest hashes of their ids: the documented bound.
    there = docs.select("doc_id").join(broadcast_if_small(marked, 40), "doc_id").dropDuplicates(["doc_id"])
    chosen = cut(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples))
    held = cut(docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")))
    totals = {int(r["toxic"]): int(r["n"]) for r in held.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    n = float(max(1, pos + neg))
    counts = held.mapInPandas(_labelled_terms, "toxic int, term string").groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("df"))
    a, df = F.col("a"), F.col("df")
    spread = df * (n - df) * float(max(1, pos)) * float(max(1, neg))
    chi2 = n * F.pow(a * neg - (df - a) * pos, F.lit(2.0)) / F.when(spread > 0, spread)
    top = counts.withColumn("chi2", chi2).filter((df >= LEAST_DOCS) & (F.col("chi2") >= LEAST_CHI2)).orderBy(F.desc("chi2"), "term").collect()  # terms of EXAMPLES texts
    terms = [r["term"] for r in top]
    idf = np.array([math.log((n + 1) / (r["df"] + 1)) + 1 for r in top])
    kept = cut(held.mapInPandas(functools.partial(_labelled_counts, vocabulary=frozenset(terms)), "doc_id long, toxic int, terms array<string>, counts array<int>"))
    rows = [(int(r["doc_id"]), int(r["toxic"]), r["terms"], r["counts"]) for r in kept.collect()]  # EXAMPLES rows at most
    index = Index(terms, idf, sorted(rows))
    shared = spark.sparkContext.broadcast(index)
    own = kept.filter(F.size("terms") > 0).mapInPandas(functools.partial(_leave_one_out, index=shared, k=k), "toxic int, vote double").toPandas()
    if len(own):
        index.fit(own["vote"].to_numpy(), own["toxic"].to_numpy(np.float64))
    return index


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, nearest (ids of the neighbours; equal cosines by the index's order) and cosines for every row of docs(doc_id, text, ...).

    Labels are learnt from rows whose crc32(doc_id as text) mod folds is not held_fold; folds = 0 learns from all. A null or
    empty text, like any without a term of the vocabulary, gets the rate of such examples. Without labels every score is
    that of the empty rate. A null doc_id is scored and not held out. Repeated rows are scored one by one; an empty table
    gives no rows; other columns are ignored.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(False)) if folds else F.lit(False)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    index = fit_index(texts.filter(~F.col("held_out")).select("doc_id", "text"), labels, k)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = "doc_id long, held_out boolean, score double, predicted int, nearest array<long>, cosines array<double>"
    return texts.mapInPandas(functools.partial(_score, index=shared, k=k, threshold=threshold), schema)


def _reject(batches, index, k: int, threshold: float):
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        scored = pd.concat(list(_score([pdf[["doc_id", "text"]]], index, k, threshold)))
        yield pdf[(scored["predicted"] == 0).to_numpy()]


def reject_toxic(docs: DataFrame, labels: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is under the threshold, with all their columns; learns from all labels."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit_index(source, labels, k))
    return docs.mapInPandas(functools.partial(_reject, index=shared, k=k, threshold=threshold), docs.schema)
