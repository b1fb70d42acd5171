"""Removal of repeated passages by level-wise doubling.

A window of `window` consecutive words is removed if its word sequence starts anywhere else too. Lengths are doubled:
windows of START words first; those that repeat are extended to twice the length, and so on up to `window` (the last
doubling is cut to it: two overlapping halves). A window can only repeat if the shorter windows inside it do, so each
level reads only what survived the level before.

At the levels below `window`, not every short window is counted, but the one with the smallest hash among those inside
each full window (its minimiser). Equal full windows have equal minimisers, so nothing is lost, and about one short
window in fourteen is counted.

Counting: each batch of documents sends each of its distinct hashes once, with one place, to the task that owns the
hash's range. Places of a hash that a batch holds twice or more are known to repeat and go straight to their documents, so
a window that a third of all documents share reaches its owner once for each batch. Short windows are compared by 64-bit
hashes of the words and of their sequence, which may only let too much go on; full windows by two such hashes with
independent seeds, 128 bits in all.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, gram_hashes, mix, shuffle_parts, slices, text_parts, token_hashes, words

WINDOW = 35
START = 9
#: Bytes of text for which there is a range of the hash space, and for which there is a part of the documents: so no group grows with the table.
RANGE_BYTES, DOC_BYTES = 8 << 20, 32 << 20
#: Ranges of the hash space for each shuffle partition at least, and shuffle partitions for a part of the documents at most.
RANGES, DOC_SHARE = 4, 4
#: Characters of text whose windows are gathered before they are sent.
CHARS = 4_000_000

_BLOCK = "part int, docs binary, places binary, hashes binary"
_FOUND = "doc_id long, places binary"


def levels(window: int, start: int = START) -> list[int]:
    """Lengths that double from start and end with window."""
    out = [min(start, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def minimisers(h: np.ndarray, short: int, window: int) -> np.ndarray:
    """Starts of the short windows that have the smallest hash (the first such) inside some full window of the word hashes h."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    inside = window - short + 1
    grams = gram_hashes(h, short)
    return np.unique(sliding_window_view(grams, inside).argmin(axis=1) + np.arange(len(grams) - inside + 1))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the runs of equal values (or rows) in a sorted array."""
    if not len(keys):
        return np.zeros(0, int), np.zeros(0, int)
    new = keys[1:] != keys[:-1]
    edges = np.concatenate([[True], new if new.ndim == 1 else new.any(axis=1), [True]]).nonzero()[0]
    return edges[:-1], edges[1:]


def _sorted_by(hashed: np.ndarray) -> np.ndarray:
    return np.lexsort(hashed.T[::-1])


def _rows(part: np.ndarray, doc: np.ndarray, place: np.ndarray, hashed: np.ndarray) -> list[tuple]:
    order = np.argsort(part, kind="stable")
    part, doc, place, hashed = part[order], doc[order], place[order], hashed[order]
    return [(int(part[a]), doc[a:b].tobytes(), place[a:b].tobytes(), hashed[a:b].tobytes()) for a, b in zip(*_runs(part))]


def _dealt(ids: list, places: list, hashes: list, parts: int) -> pd.DataFrame:
    """A batch's rows: its distinct hashes (rows of one or two columns) by range, and under negative parts the places that repeat within the batch."""
    rows = []
    if ids:
        doc, place, hashed = np.repeat(np.array(ids, np.int64), [len(p) for p in places]), np.concatenate(places).astype(np.int32), np.concatenate(hashes)
        order = _sorted_by(hashed)
        doc, place, hashed = doc[order], place[order], hashed[order]
        first, last = _runs(hashed)
        part = ((hashed[first, 0] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        rows = _rows(part, doc[first], place[first], hashed[first])
        twice = np.repeat(last - first > 1, last - first)
        own = doc[twice]
        rows += [(*row[:3], b"") for row in _rows(-1 - own % parts, own, place[twice], hashed[twice])]
    return pd.DataFrame(rows, columns=["part", "docs", "places", "hashes"])


def _first_level(batches, short: int, window: int, parts: int):
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        ids, places, out = [], [], []
        for doc_id, h in zip(pdf["doc_id"], token_hashes(pdf["text"], lower=False)):
            at = minimisers(h, short, window)
            if len(at):
                ids.append(doc_id)
                places.append(at)
                out.append(gram_hashes(h, short)[at, None])
        yield _dealt(ids, places, out, parts)


def _next_level(batches, short: int, length: int, window: int, parts: int):
    """Extend what repeated to `length`.

    Below `window`, a repeated minimiser is extended to both sides: a full window around it holds at least one of the two
    extensions. The place is the minimiser's start, doubled, plus 1 for the extension to the left. At `window` itself the
    windows are hashed whose minimiser survived.
    """
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        ids, places, out = [], [], []
        others = token_hashes(pdf["text"], lower=False, seed=1) if length == window else [None] * len(pdf)
        for doc_id, h, other, kept in zip(pdf["doc_id"], token_hashes(pdf["text"], lower=False), others, pdf["places"]):
            if len(h) < window:  # another row of a repeated doc_id
                continue
            at = np.frombuffer(kept, np.int32).astype(np.int64)
            if length < window:
                grams = gram_hashes(h, length)
                right, left = at[at < len(grams)], at[(at >= length - short) & (at - (length - short) < len(grams))]
                place = np.concatenate([2 * right, 2 * left + 1])
                hashed = np.concatenate([grams[right], mix(grams[left - (length - short)])])[:, None]
            else:
                place = np.nonzero(_both(h, at, short, window))[0]
                hashed = np.stack([gram_hashes(h, window)[place], gram_hashes(other, window)[place]], axis=1)
            if len(place):
                ids.append(doc_id)
                places.append(place)
                out.append(hashed)
        yield _dealt(ids, places, out, parts)


def _both(h: np.ndarray, at: np.ndarray, short: int, window: int) -> np.ndarray:
    """Full windows whose minimiser's extension inside them repeated; `at` has the places of _next_level's middle level."""
    inside = window - short + 1
    grams = gram_hashes(h, short)
    starts = np.arange(len(h) - window + 1)
    own = sliding_window_view(grams, inside).argmin(axis=1) + starts
    right, left = np.zeros(len(grams), bool), np.zeros(len(grams), bool)
    at = at[at // 2 < len(grams)]  # places of another row of a repeated doc_id may lie beyond
    right[at[at % 2 == 0] // 2] = True
    left[at[at % 2 == 1] // 2] = True
    fits = own + 2 * short <= starts + window
    return np.where(fits, right[own], left[own])


def _repeated(pdf: pd.DataFrame, doc_parts: int, columns: int) -> pd.DataFrame:
    """Of one part: the documents and places whose hash more than one batch sent; of a negative part, all places. Sent on by the documents' part."""
    doc = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["docs"]])
    place = np.concatenate([np.frombuffer(b, np.int32) for b in pdf["places"]])
    if pdf["part"].iloc[0] >= 0:
        hashed = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["hashes"]]).reshape(-1, columns)
        order = _sorted_by(hashed)
        first, last = _runs(hashed[order])
        at = order[np.repeat(last - first > 1, last - first)]
        doc, place = doc[at], place[at]
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    rows = [(*row[:3], b"") for row in _rows(doc % doc_parts, doc, place, doc.view(np.uint64))]
    return pd.DataFrame(rows, columns=["part", "docs", "places", "hashes"])


def _by_document(pdf: pd.DataFrame, runs: bool) -> pd.DataFrame:
    """One row for each document; with runs, its places as (first, last) of consecutive ones."""
    doc = np.concatenate([np.frombuffer(b, np.int64) for b in pdf["docs"]])
    place = np.concatenate([np.frombuffer(b, np.int32) for b in pdf["places"]])
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    rows = []
    for a, b in zip(*_runs(doc)):
        own = place[a:b]
        if runs:
            own = np.unique(own)
            gaps = np.nonzero(np.diff(own) > 1)[0]
            own = np.stack([own[np.concatenate([[0], gaps + 1])], own[np.concatenate([gaps, [len(own) - 1]])]], axis=1).astype(np.int32)
        rows.append((int(doc[a]), own.tobytes()))
    return pd.DataFrame(rows, columns=["doc_id", "places"])


def _survivors(blocks: DataFrame, doc_parts: int, last: bool) -> tuple[DataFrame, int]:
    """(doc_id, places) of what repeated, one row for each document, and the table's size in bytes. At the last level hashes have two columns and places are runs."""

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        return _repeated(pdf, doc_parts, 2 if last else 1)

    def by_document(pdf: pd.DataFrame) -> pd.DataFrame:
        return _by_document(pdf, last)

    found = blocks.groupBy("part").applyInPandas(repeated, _BLOCK)
    # A part of the documents holds as many places as their words at most.
    joined = cut(found.groupBy("part").applyInPandas(by_document, _FOUND))
    return joined, joined.agg(F.sum(F.octet_length("places") + 24)).first()[0] or 0


def _cover(batches, window: int):
    for pdf in (part for batch in batches for part in slices(batch)):
        rows = []
        for text, at in zip(pdf["text"], pdf["places"]):
            found = words(text, lower=False)
            n, removed = len(found), 0
            if at is not None:
                steps = np.zeros(n + 1, np.int64)
                first, last = np.frombuffer(at, np.int32).reshape(-1, 2).T
                fits = last + window <= n  # runs of another row of a repeated doc_id may not
                np.add.at(steps, first[fits], 1)
                np.add.at(steps, last[fits] + window, -1)
                covered = np.cumsum(steps)[:n] > 0
                removed = int(covered.sum())
                found = [w for w, gone in zip(found, covered) if not gone]
            rows.append((n, removed, hashlib.sha256(b" ".join(found)).hexdigest()))
        done = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])
        done.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
        yield done


def repeated_windows(docs: DataFrame, window: int = WINDOW, start: int = START) -> tuple[DataFrame, int]:
    """(doc_id, places: (first, last) of the runs of repeated full windows' starts), and the table's bytes. docs(doc_id long, text string)."""
    if window < 2 * start or window > 4 * start:
        raise ValueError("window must be two to four times the first level's length")
    partitions = shuffle_parts(docs.sparkSession)
    parts = text_parts(docs, RANGE_BYTES, RANGES * partitions)
    doc_parts = max(4, partitions // DOC_SHARE, parts * RANGE_BYTES // DOC_BYTES if parts > RANGES * partitions else 0)
    steps = levels(window, start)
    blocks = docs.filter("doc_id is not null").mapInPandas(functools.partial(_first_level, short=steps[0], window=window, parts=parts), _BLOCK)
    alive, size = _survivors(blocks, doc_parts, False)
    for length in steps[1:]:
        held = docs.join(broadcast_if_small(alive, 1, rows=size), "doc_id").select("doc_id", "text", "places")
        blocks = held.mapInPandas(functools.partial(_next_level, short=steps[0], length=length, window=window, parts=parts), _BLOCK)
        alive, size = _survivors(blocks, doc_parts, length == window)
    return alive, size


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by a space) for every row of docs(doc_id, text, ...).

    A null text has no words. A text of fewer than `window` words loses nothing. Rows that share a doc_id count as places of
    their own; a word goes if a repeated window starts at that place in any row of the id. A null doc_id is kept whole and
    counted nowhere. An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, size = repeated_windows(texts, window)
    joined = texts.join(broadcast_if_small(found, 1, rows=size), "doc_id", "left").select("doc_id", "text", "places")
    return joined.mapInPandas(functools.partial(_cover, window=window), "doc_id long, n_words long, n_removed long, kept_sha256 string")
