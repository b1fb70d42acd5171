"""Language-model scores from a log-frequency Bloom filter.

Unigram counts are exact. Words counted at least a threshold often (the smallest power of two that leaves FREQUENT of
them at most) are broadcast. So the broadcast has a fixed bound, and no frequent word is ever shuffled.

All bigrams are counted over the whole corpus, and each one, those found once included, has its part in the scores. Those of
two broadcast words found `cutoff` times or more go into the filter: a bigram whose quantised count is the q-th from that of
`cutoff` on is inserted q times, as (bigram, 1) to (bigram, q), and its count is read back by probing with 1, 2, ... until a
probe fails. `cutoff` is the smallest count of the first level for which the filter keeps BITS_EACH bits for each insertion
within MAX_BITS, so the filter's error rate holds at every size of the corpus. The other bigrams, found less often or with a word that is not
broadcast, stay distributed, and the documents' bigrams that the filter does not know are sent to them: those with a rare
(not broadcast) second word to the part of that word, which has all its bigrams and so its count, and those with a rare first
word to the part of the first, which has its count and M(v) below likewise. Texts that were learnt from hold
what the filter does not know once at least; a second, small filter has the bigrams of two broadcast words found more than
once but less than `cutoff` times, and what it does not know either was found exactly once and is not asked for. It only
saves questions: what it takes for one of its own is asked for, and answered exactly. Where it would have less than SPARE_EACH
bits for each bigram, it is left out. What lies in a part is packed, so a bigram is no row of its own in a shuffle. Counts are quantised there as well, so where a count is kept does not change a score. Counts of
1, 2 and 3 are levels of their own.

    P(w | v) = MIX * ((c(v, w) - D) / n(v) + (1 - M(v) / n(v)) * P(w)) + (1 - MIX) * P(w),    P(w) = (c(w) + 1) / (N + V + 1)

with quantised c(v, w). M(v) is the sum of c - D over v's bigrams, and n(v) the larger one of c(v) and M(v), so P(. | v)
sums to one. The first word of a text follows the end token of a
text before, which so stands for the start. With K(v) = MIX * (1 - M(v) / n(v)) + 1 - MIX, a score is a sum of
log10 P(w) + log10 K(v) over tokens w after v, and for each known bigram the rest, its bonus.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHARS, cut, mix, shuffle_parts, slices, text_parts, token_hashes

FREQUENT = 1_000_000
MAX_BITS = 1 << 28
#: With these a probe for what was not inserted succeeds once in about 1,070 times, at the filter's fullest.
BITS_EACH = 16
HASHES = 6
#: The filter that saves questions has at most this part of MAX_BITS, and is left out where a bigram has fewer bits.
SPARE_PART = 4
SPARE_EACH = 4
#: Counts are quantised by powers of this.
BASE = 1.5
#: The smallest count of each level that a 64-bit count can have, and the count in the middle of each; level 0 is a count of 0.
LOWS = np.array([math.ceil(BASE**k) for k in range(108)], np.int64)
MIDDLES = np.concatenate([[0], (LOWS[:-1] + LOWS[1:] - 1.0) / 2, LOWS[-1:]])
LEVELS = len(LOWS)
D = 0.75
MIX = 0.9
#: Pieces of the filter that are built apart.
SEGMENTS = 64
#: Distinct values that a task gathers before it sends them on.
GATHER = 3_000_000
#: Ranges of parts in which they are sorted and sent.
PIECES = 16
#: Words and bigrams that a task asks for at a time.
ASKED = 500_000
#: Bytes of text for which there is a part of the counts at least, so no part grows with the table.
PART_BYTES = 16 << 20

_END = np.uint64(0x51ED270B2E0DF6A1)
_POWERS = 1 << np.arange(40, dtype=np.int64)
#: Answers are whole numbers of such steps (of 2e-10), so they take few bytes and their sums do not depend on their order.
_STEP = 2.0**-32


def quantised(c: np.ndarray) -> np.ndarray:
    return np.searchsorted(LOWS, c, side="right")


def count_of(q: np.ndarray) -> np.ndarray:
    return MIDDLES[q]


def kappa_of(mass: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return MIX * (1 - mass / np.maximum(np.maximum(counts, mass), 1)) + 1 - MIX


def bonus_of(c: np.ndarray, n_v: np.ndarray, kappa: np.ndarray, log_w: np.ndarray) -> np.ndarray:
    """log10 P(w | v) - log10 P(w) - log10 K(v) for the count c of a bigram and n_v = n(v)."""
    plain = 10.0**log_w
    return np.log10(np.minimum(kappa + MIX * np.maximum(c - D, 0) / np.maximum(n_v, 1) / plain, 1 / plain)) - np.log10(kappa)


def hashed(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The first hash of each (key, level) and the step to the next ones."""
    h = mix(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
    return h, mix(h) | np.uint64(1)


def bits_of(keys: np.ndarray, level: int, n_bits: int):
    """The HASHES bit positions of (key, level), all in the key's segment, so a segment is built from its keys alone."""
    size = np.uint64(n_bits // SEGMENTS)
    start = _part_of(keys, SEGMENTS).astype(np.uint64) * size
    h, step = hashed(keys, level)
    for _ in range(HASHES):
        yield start + (h & (size - np.uint64(1)))
        h = h + step


def probe(filter_bytes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Level of each key: probes with 1, 2, ... until one fails."""
    size = np.uint64(8 * len(filter_bytes) // SEGMENTS)
    start = _part_of(keys, SEGMENTS).astype(np.uint64) * size
    level = np.zeros(len(keys), np.int64)
    left = np.arange(len(keys))
    for q in range(1, LEVELS + 1):
        h, step = hashed(keys[left], q)
        for _ in range(HASHES):
            position = start[left] + (h & (size - np.uint64(1)))
            ok = (filter_bytes[position >> np.uint64(3)] >> (position & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left, h, step = left[ok], (h + step)[ok], step[ok]
        if not len(left):
            break
        level[left] = q
    return level


def _packed(values: np.ndarray) -> bytes:
    """The bytes of 64-bit numbers (or rows of them), those of equal weight together, so that they compress, and without high ones that are all 0; their number comes first.

    Of numbers that never fall, the first one and the steps between them are kept instead (and 128 is added).
    """
    if not len(values):
        return b""
    head, width = b"", values[0].nbytes
    if rising := values.ndim == 1 and bool((values[1:] >= values[:-1]).all()):
        head, values = values[:1].tobytes(), np.diff(values)
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), width).T
    kept = next((i for i in range(width, 1, -1) if planes[i - 1].any()), 1)
    return bytes([kept + 128 * rising]) + head + planes[:kept].tobytes()


def _opened(data: bytes, kind: type = np.int64, width: int = 1) -> np.ndarray:
    """The numbers that _packed got; with a width over 1, in rows of so many."""
    rising, kept = divmod(data[0], 128) if data else (0, 1)
    planes = np.frombuffer(data, np.uint8)[1 + 8 * rising :].reshape(kept, -1)
    out = np.zeros((planes.shape[1] + rising, 8 * width), np.uint8)
    out[rising:, :kept] = planes.T
    if rising:
        out[0] = np.frombuffer(data, np.uint8, 8, 1)
    out = out.view(kind) if width > 1 else out.view(kind).reshape(-1)
    return np.cumsum(out, dtype=kind) if rising else out


def _all(blocks, kind: type = np.int64, width: int = 1) -> np.ndarray:
    return np.concatenate([_opened(b, kind, width) for b in blocks])


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]).nonzero()[0] if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _merge_pairs(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of two words with their summed counts."""
    order, number = _numbered(pairs)
    first = np.concatenate([[True], number[1:] != number[:-1]]).nonzero()[0] if len(pairs) else np.zeros(0, int)
    return pairs[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts


def _numbered(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts rows of two words, and the number of each sorted row among the distinct ones."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    rows = pairs[order]
    return order, np.cumsum(np.concatenate([[0], (rows[1:] != rows[:-1]).any(axis=1)])[: len(rows)])


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(keys) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _send(keys: np.ndarray, counts: np.ndarray, parts: int, side: int = 0) -> pd.DataFrame:
    """Keys, or rows of two words by the first, with their counts by part; each side has parts of its own."""
    part = _part_of(keys if keys.ndim == 1 else keys[:, 0].view(np.uint64), parts) + side * parts
    order = np.argsort(part.astype(np.min_scalar_type((side + 1) * parts)), kind="stable")
    part, keys, counts = part[order], keys[order], counts[order].astype(np.int64)
    del order
    edges = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]) if len(part) else np.zeros(1, int)
    rows = [(int(part[a]), _packed(keys[a:b]), _packed(counts[a:b])) for a, b in zip(edges[:-1], edges[1:])]
    return pd.DataFrame(rows, columns=["part", "keys", "counts"])


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts in a row, each text's ended by the end token and one before all, and the number of each text's."""
    each = token_hashes(texts, lower=True)
    sizes = np.array([len(h) for h in each], np.int64)
    return np.insert(np.concatenate(each), np.concatenate([[0], np.cumsum(sizes)]), _END), sizes + 1


def _counted(batches, keys_of, parts: int):
    """Count the keys of all texts of a task, a few million distinct at a time, and send them by part; rows of two words are sent as they are."""
    waiting, n = [], 0
    for pdf in batches:
        for some in slices(pdf, CHARS):
            keys, *sides = keys_of(some["text"])
            waiting.append((*_in_pieces(*np.unique(keys, return_counts=True)), *sides))
            n += len(waiting[-1][0]) + sum(map(len, sides))
            if n > GATHER:
                yield from _sent(waiting, parts)
                waiting, n = [], 0
    if waiting:
        yield from _sent(waiting, parts)


def _in_pieces(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts (of one slice, so 32 bits do) by ranges of parts, and the edges of these."""
    piece = _part_of(keys, PIECES).astype(np.uint8)
    order = np.argsort(piece, kind="stable")
    return keys[order], counts[order].astype(np.int32), np.searchsorted(piece[order], np.arange(PIECES + 1))


def _sent(waiting: list[tuple], parts: int):
    """A range of parts after the other, so that few of the keys are copied at once."""
    for g in range(PIECES):
        keys, counts = (np.concatenate([w[i][w[2][g] : w[2][g + 1]] for w in waiting]) for i in (0, 1))
        yield _send(*_merge(keys, counts.astype(np.int64)), parts)
    for side, pairs in enumerate(zip(*(w[3:] for w in waiting)), 1):
        pairs = np.concatenate(pairs)
        if len(pairs):
            yield _send(pairs, np.ones(len(pairs), np.int64), parts, side)


_BLOCK = "part long, keys binary, counts binary"


def _unigrams(batches, parts: int):
    yield from _counted(batches, lambda texts: (_tokens(texts)[0][1:],), parts)


def _gather(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _merge(_all(pdf["keys"], np.uint64), _all(pdf["counts"]))


def _merge_unigrams(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, counts = _gather(pdf)
    above = [int((counts >= p).sum()) for p in _POWERS]
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "keys": [_packed(keys)], "counts": [_packed(counts)], "tokens": [int(counts.sum())], "above": [above]})


def _at_least(batches, least: int):
    for pdf in batches:
        for k, c in zip(pdf["keys"], pdf["counts"]):
            keys, counts = _opened(k, np.uint64), _opened(c)
            some = counts >= least
            yield pd.DataFrame({"keys": [keys[some].tobytes()], "counts": [counts[some].tobytes()]})


class Frequent:
    """The broadcast words: sorted hashes with their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def index(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 for others."""
        if not len(self.keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, -1)

    def named(self, h: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Each word by its index if it is broadcast, else by its hash; one word in 10**13 has a hash that looks like an index."""
        return np.where(index >= 0, index, h.view(np.int64))

    @staticmethod
    def pairs(index: np.ndarray) -> np.ndarray:
        """Mask over tokens from the second on: those that end a bigram of two broadcast words."""
        return (index[1:] >= 0) & (index[:-1] >= 0)

    def pair_keys(self, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Bigrams as numbers without gaps, so that they take few bytes: the first word's index times the number of words, and the second's."""
        return index[:-1][mask].astype(np.uint64) * np.uint64(len(self.keys)) + index[1:][mask].astype(np.uint64)


def _is_broadcast(names: np.ndarray, n_words: int) -> np.ndarray:
    return (names >= 0) & (names < n_words)


def _bigrams(batches, frequent, parts: int):
    """Bigrams of two broadcast words, counted; (w, v) of those with a rare second word on side 1; (v, w) of the others on side 2."""
    table = frequent.value

    def keys_of(texts):
        tokens, _ = _tokens(texts)
        index = table.index(tokens)
        rare = np.nonzero(index < 0)[0]
        around = np.unique(np.concatenate([rare[rare > 0], rare[rare < len(tokens) - 1] + 1]))
        names, second = table.named(tokens, index), index[around] < 0
        both = np.stack([names[around], names[around - 1]], axis=1)
        return table.pair_keys(index, table.pairs(index)), both[second], both[~second, ::-1]

    yield from _counted(batches, keys_of, parts)


_PAIRS = f"{_BLOCK}, inserts array<long>, pairs binary, found binary"


def _merge_bigrams(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """The part's bigrams; inserts[i] are the insertions that counts from LOWS[i] up need. Those of sides 1 and 2 are in pairs and found."""
    part = int(pdf["part"].iloc[0])
    if part >= parts:
        pairs, counts = _merge_pairs(_all(pdf["keys"], width=2), _all(pdf["counts"]))
        return pd.DataFrame({"part": [part], "keys": [None], "counts": [None], "inserts": [None], "pairs": [_packed(pairs)], "found": [_packed(counts)]})
    keys, counts = _gather(pdf)
    q = quantised(counts)
    inserts = np.cumsum(np.cumsum(np.bincount(q - 1, minlength=LEVELS)[::-1]))[::-1].tolist()
    return pd.DataFrame({"part": [part], "keys": [_packed(keys)], "counts": [_packed(counts)], "inserts": [inserts], "pairs": [None], "found": [None]})


def _placed(batches, parts: int, least: int, n_words: int, spare: bool):
    """The filter's bigrams with their levels by segment, those of the second one under segments from SEGMENTS on, and the sums of c - D of all bigrams by first word, if broadcast, under segments below 0."""
    for pdf in batches:
        for part, k, c, p, f in zip(pdf["part"], pdf["keys"], pdf["counts"], pdf["pairs"], pdf["found"]):
            if part >= parts:
                first, counts = _opened(p, width=2)[:, 1], _opened(f)
                some = _is_broadcast(first, n_words) & (part < 2 * parts)
                first, counts, keys = first[some], counts[some], np.zeros(0, np.uint64)
            else:
                keys, counts = _opened(k, np.uint64), _opened(c)
                first = keys // np.uint64(max(n_words, 1))
            if not len(first):
                continue
            first, inverse = np.unique(first, return_inverse=True)
            sums, width = np.bincount(inverse, weights=count_of(quantised(counts)) - D), -(-n_words // SEGMENTS)
            edges = np.searchsorted(first, np.arange(SEGMENTS + 1) * width)
            rows = [(-1 - s, (first[a:b].astype(np.int64) - s * width).astype(np.uint32).tobytes(), sums[a:b].tobytes()) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            if len(keys):
                some = counts >= (2 if spare else least)
                keys, counts = keys[some], counts[some]
                q = np.maximum(quantised(counts) - quantised(least) + 1, 1).astype(np.uint8)
                segment = _part_of(keys, SEGMENTS) + SEGMENTS * (counts < least)
                rows += [(int(s), _packed(keys[segment == s]), q[segment == s].tobytes()) for s in np.unique(segment)]
            yield pd.DataFrame(rows, columns=["segment", "keys", "held"])


def _built(key, pdf: pd.DataFrame, sizes: tuple[int, int], n_words: int) -> pd.DataFrame:
    if key[0] < 0:
        mass = np.zeros(-(-n_words // SEGMENTS))
        for at, m in zip(pdf["keys"], pdf["held"]):
            mass[np.frombuffer(at, np.uint32)] += np.frombuffer(m, np.float64)
        return pd.DataFrame({"segment": [int(key[0])], "data": [mass.tobytes()]})
    size = sizes[key[0] // SEGMENTS]
    bits = np.zeros(size, np.uint8)
    for k, held in zip(pdf["keys"], pdf["held"]):
        keys, q = _opened(k, np.uint64), np.frombuffer(held, np.uint8)
        for level in range(1, int(q.max()) + 1):
            for position in bits_of(keys[q >= level], level, size * SEGMENTS):
                bits[position & np.uint64(size - 1)] = 1
    return pd.DataFrame({"segment": [int(key[0])], "data": [np.packbits(bits, bitorder="little").tobytes()]})


class Model:
    """What the scoring tasks use: the frequent words, the filter, the one that saves questions (or None) and M(v), all of bounded size."""

    def __init__(self, frequent: Frequent, filter_bytes: np.ndarray, spare: np.ndarray | None, mass: np.ndarray, tokens: int, vocabulary: int, cutoff: int, others: bool):
        self.frequent, self.filter, self.spare, self.cutoff, self.others = frequent, filter_bytes, spare, cutoff, others
        self.norm = float(np.log10(tokens + vocabulary + 1))
        self.mass = mass

    @functools.cached_property
    def logs(self) -> np.ndarray:
        return np.log10(self.frequent.counts + 1.0) - self.norm

    @functools.cached_property
    def kappa(self) -> np.ndarray:
        return kappa_of(self.mass, self.frequent.counts)

    @functools.cached_property
    def norms(self) -> np.ndarray:
        return np.maximum(self.frequent.counts, self.mass)

    def bonus(self, keys: np.ndarray, q: np.ndarray) -> np.ndarray:
        v, w = (x.astype(np.int64) for x in np.divmod(keys, np.uint64(max(len(self.frequent.keys), 1))))
        return bonus_of(count_of(q), self.norms[v], self.kappa[v], self.logs[w])


class Pieces:
    """A model as the driver sends it: segments as they were built, not put together there, and without the words, which workers have from a broadcast of their own."""

    def __init__(self, built: dict[int, bytes], sizes: tuple[int, int], spare: bool, *numbers):
        self.built, self.sizes, self.spare, self.numbers = built, sizes, spare, numbers
        self.whole: Model | None = None

    def model(self, frequent: Frequent) -> Model:
        """Put together once in a worker. A piece goes as soon as it is copied, so nothing is held twice."""
        if self.whole is None:
            n_words = len(frequent.keys)
            filters = [np.zeros((SEGMENTS, size // 8), np.uint8) for size in self.sizes]
            mass = np.zeros((SEGMENTS, -(-n_words // SEGMENTS)))
            while self.built:
                segment, data = self.built.popitem()
                if segment < 0:
                    mass[-1 - segment] = np.frombuffer(data, np.float64)
                else:
                    filters[segment // SEGMENTS][segment % SEGMENTS] = np.frombuffer(data, np.uint8)
            bits, spare = (f.reshape(-1) for f in filters)
            self.whole = Model(frequent, bits, spare if self.spare else None, mass.reshape(-1)[:n_words], *self.numbers)
        return self.whole


def _score(batches, frequent, pieces, parts: int):
    """What the filter and the broadcast words tell of a text, and what is asked of the parts for it, with its row: bigrams that the
    filter does not know, and on sides 1 and 2 those with a rare second and first word (with two, on both). Side 3 has the texts.
    """
    waiting, n, model = [], 0, pieces.value.model(frequent.value)
    for pdf in batches:
        for some in slices(pdf, CHARS):
            waiting.append(_scored(some, model))
            n += sum(len(row) for row, _ in waiting[-1])
            if n > ASKED:
                yield from _asked(waiting, parts)
                waiting, n = [], 0
    yield from _asked(waiting, parts)


def _asked(waiting: list[list], parts: int):
    for side, blocks in enumerate(zip(*waiting)):
        row, keys = map(np.concatenate, zip(*blocks))
        if side < 3:
            yield _send(keys, row, parts, side)
            continue
        part = row % parts
        yield pd.DataFrame([(int(p) + 3 * parts, _packed(keys[part == p]), b"") for p in np.unique(part)], columns=["part", "keys", "counts"])


def _scored(texts: pd.DataFrame, m: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    table = m.frequent
    tokens, sizes = _tokens(texts["text"])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    row, ids, held = texts["row"].to_numpy(np.int64), texts["doc_id"], texts["held_out"].to_numpy(bool)
    index = table.index(tokens)
    before, after = index[:-1], index[1:]
    known = after >= 0
    base, factor = np.full(len(after), -m.norm), np.zeros(len(after))
    rest, asked = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row_of = np.repeat(row, sizes)
    if len(table.keys):
        base[known] = m.logs[after[known]]
        factor[before >= 0] = np.log10(m.kappa[before[before >= 0]])
        at = np.nonzero(table.pairs(index))[0]
        keys = table.pair_keys(index, table.pairs(index))
        q = probe(m.filter, keys)
        q[q > 0] += quantised(m.cutoff) - 1
        if m.cutoff > 1 and m.spare is not None:
            learnt = np.nonzero((q == 0) & np.repeat(~held & ~ids.isna().to_numpy(), sizes)[at])[0]
            q[learnt[probe(m.spare, keys[learnt]) == 0]] = 1
        hit = q > 0
        factor[at[hit]] += m.bonus(keys[hit], q[hit])
        if m.cutoff > 1:
            rest, asked = keys[~hit], row_of[at[~hit]]
    out = [(asked, rest)]
    for rare, other in ((1, 0), (0, 1)):
        at = np.nonzero(index[rare : len(index) - 1 + rare] < 0)[0] if m.others else np.zeros(0, np.int64)
        words = [table.named(tokens[at + i], index[at + i]) for i in (rare, other)]
        out.append((row_of[at], np.stack(words, axis=1)))
    sums = np.add.reduceat(base, first)
    values = (ids.isna().to_numpy(np.int64), held.astype(np.int64), sizes, np.add.reduceat(known, first, dtype=np.int64), sums.view(np.int64), (sums + np.add.reduceat(factor, first)).view(np.int64))
    out.append((row, np.stack([row, ids.fillna("0").to_numpy(object).astype(np.int64), *values], axis=1)))
    return out


_HELD = f"{_BLOCK}, others binary"


def _held(batches, parts: int, cutoff: int, n_words: int):
    """What is looked up: bigrams that the filter leaves out, and those with a rare word; with two, also by the first, with the second's count."""
    for pdf in batches:
        for part, k, c, p, f in zip(pdf["part"], pdf["keys"], pdf["counts"], pdf["pairs"], pdf["found"]):
            if part < parts:
                if cutoff > 1:
                    keys, counts = _opened(k, np.uint64), _opened(c)
                    yield pd.DataFrame({"part": [part], "keys": [_packed(keys[counts < cutoff])], "counts": [_packed(counts[counts < cutoff])], "others": [b""]})
                continue
            pairs, counts = _opened(p, width=2), _opened(f)
            yield pd.DataFrame({"part": [part], "keys": [p], "counts": [f], "others": [_packed(np.zeros(len(counts), np.int64))]})
            rare = ~_is_broadcast(pairs[:, 1], n_words)
            if part < 2 * parts and rare.any():
                _, at = np.unique(pairs[:, 0], return_inverse=True)
                n_w = np.bincount(at, weights=counts).astype(np.int64)[at]
                to = _part_of(pairs[rare, 1].view(np.uint64), parts) + 2 * parts
                rows = [(int(t), _packed(pairs[rare][to == t][:, ::-1]), _packed(counts[rare][to == t]), _packed(n_w[rare][to == t])) for t in np.unique(to)]
                yield pd.DataFrame(rows, columns=["part", "keys", "counts", "others"])


def _answer(asked: pd.DataFrame, held: pd.DataFrame, parts: int, frequent, pieces) -> pd.DataFrame:
    """What the asked words and bigrams add to log10 P of words, number of known words and score, summed by document and sent on by its part."""
    if len(asked) and asked["part"].iloc[0] >= 3 * parts:
        return asked.assign(part=asked["part"] - 3 * parts)
    if not len(asked) or not len(held):
        return pd.DataFrame({"part": [], "keys": [], "counts": []})
    m, part = pieces.value.model(frequent.value), asked["part"].iloc[0]
    row, counts = _all(asked["counts"]), _all(held["counts"])
    if part < parts:
        key, keys = _all(asked["keys"], np.uint64), _all(held["keys"], np.uint64)
        if not len(keys):
            return pd.DataFrame({"part": [], "keys": [], "counts": []})
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)  # a part's keys are one block, sorted
        seen = keys[at] == key
        return _by_row(row[seen], np.zeros((2, seen.sum())), m.bonus(key[seen], quantised(counts[at[seen]])), parts)
    # The held bigrams come first, then the asked ones; equal words, and equal bigrams, have the same number.
    both, n = np.concatenate([_all(held["keys"], width=2), _all(asked["keys"], width=2)]), len(counts)
    _, word = np.unique(both[:, 0], return_inverse=True)
    order, sorted_number = _numbered(both)
    number = np.empty(len(both), np.int64)
    number[order] = sorted_number
    level = count_of(quantised(counts))
    n_first = np.bincount(word[:n], weights=counts, minlength=word.max() + 1)
    c = np.zeros(number.max() + 1)
    c[number[:n]] = level
    c, n_first_asked, other = c[number[n:]], n_first[word[n:]], both[n:, 1]
    if part < 2 * parts:
        base, bonus = np.log10(n_first_asked + 1), np.zeros(len(row))
        at = np.nonzero((c > 0) & _is_broadcast(other, len(m.logs)))[0]
        bonus[at] = bonus_of(c[at], m.norms[other[at]], m.kappa[other[at]], base[at] - m.norm)
        return _by_row(row, np.stack([base, n_first_asked > 0]), bonus, parts)
    mass = np.bincount(word[:n], weights=level - D, minlength=len(n_first))
    kappa = kappa_of(mass, n_first)[word[n:]]
    log_held = np.log10(_all(held["others"]) + 1.0) - m.norm
    at = _is_broadcast(both[:n, 1], len(m.logs))
    log_held[at] = m.logs[both[:n, 1][at]]
    log_w = np.zeros(number.max() + 1)
    log_w[number[:n]] = log_held
    value, at = np.log10(kappa), np.nonzero(c > 0)[0]
    value[at] += bonus_of(c[at], np.maximum(n_first, mass)[word[n:][at]], kappa[at], log_w[number[n:][at]])
    return _by_row(row, np.zeros((2, len(row))), value, parts)


def _by_row(row: np.ndarray, words: np.ndarray, bonus: np.ndarray, parts: int) -> pd.DataFrame:
    rows, inverse = np.unique(row, return_inverse=True)
    sums = np.stack([np.bincount(inverse, weights=x, minlength=len(rows)) for x in (*words, bonus)], axis=1)
    sums, part = np.rint(sums / _STEP).astype(np.int64), rows % parts
    out = [(int(p), _packed(rows[part == p]), _packed(sums[part == p])) for p in np.unique(part)]
    return pd.DataFrame(out, columns=["part", "keys", "counts"])


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _total(pdf: pd.DataFrame) -> pd.DataFrame:
    """The texts, sent without counts, with all that the answers add to them."""
    texts = pdf["counts"].map(len) == 0
    own = _all(pdf["keys"][texts], width=8)
    own = own[np.argsort(own[:, 0])]
    base, score = own[:, 6].copy().view(np.float64), own[:, 7].copy().view(np.float64)
    n_known = own[:, 5].copy()
    if not texts.all():
        at = np.searchsorted(own[:, 0], _all(pdf["keys"][~texts]))
        values = _all(pdf["counts"][~texts], width=3).T * _STEP
        more, known, bonus = (np.bincount(at, weights=x, minlength=len(own)) for x in values)
        base, score, n_known = base + more, score + more + bonus, n_known + known.astype(np.int64)
    ids = pd.array(own[:, 1], "Int64")
    ids[own[:, 2] == 1] = pd.NA
    return pd.DataFrame({"doc_id": ids, "held_out": own[:, 3] == 1, "n_tokens": own[:, 4], "n_known": n_known, "base_score": base, "score": score})


def score_texts(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of docs(doc_id, text, ...).

    Rows whose crc32(doc_id as text) mod folds is not held_fold are learnt from. A null text is empty: its only token is the
    end. A null doc_id is scored, not learnt from, and not held out. Repeated rows are learnt from and scored one by one.
    With nothing to learn from, N = V = 0 and every token has probability 1. An empty table gives no rows; other columns
    are ignored.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"))
    train = texts.filter(~F.col("held_out") & F.col("doc_id").isNotNull()).select("text")

    parts = text_parts(texts, PART_BYTES, 2 * shuffle_parts(spark))
    counted = train.mapInPandas(functools.partial(_unigrams, parts=parts), _BLOCK)
    counted = cut(counted.groupBy("part").applyInPandas(_merge_unigrams, f"{_BLOCK}, tokens long, above array<long>"))
    sums = counted.agg(F.sum("tokens"), *(F.sum(F.col("above")[i]) for i in range(len(_POWERS)))).first()
    tokens, above = sums[0] or 0, [x or 0 for x in sums[1:]]
    least = int(next(p for p, n in zip(_POWERS, above) if n <= FREQUENT))
    # What goes to the driver is of bounded size, and comes a partition of a small table at a time: a collect() would hold it all in the JVM several times over.
    got = list(cut(counted.mapInPandas(functools.partial(_at_least, least=least), "keys binary, counts binary")).toLocalIterator())  # FREQUENT words at most
    join = lambda name, kind: np.frombuffer(b"".join(bytes(r[name]) for r in got), kind)
    table = Frequent(join("keys", np.uint64), join("counts", np.int64))
    frequent, n_words = sc.broadcast(table), len(table.keys)
    del got, table

    pairs = train.mapInPandas(functools.partial(_bigrams, frequent=frequent, parts=parts), _BLOCK)
    pairs = cut(pairs.groupBy("part").applyInPandas(lambda pdf: _merge_bigrams(pdf, parts), _PAIRS))
    needs = [x or 0 for x in pairs.agg(*(F.sum(F.col("inserts")[i]) for i in range(LEVELS))).first()]
    cutoff, need = next(((int(c), n) for c, n in zip(LOWS, needs) if n * BITS_EACH <= MAX_BITS), (int(LOWS[-1]) + 1, 0))
    n_bits = max(1 << 16, 1 << int(max(1, need * BITS_EACH) - 1).bit_length())
    distinct = [a - b for a, b in zip(needs, [*needs[1:], 0])]  # bigrams from each level on
    between = max(0, distinct[1] - (distinct[int(quantised(cutoff)) - 1] if cutoff <= LOWS[-1] else 0))  # found more than once, but not in the filter
    spare_bits = max(1 << 16, min(1 << int(max(1, between * BITS_EACH) - 1).bit_length(), MAX_BITS // SPARE_PART))
    spare = cutoff > 1 and between * SPARE_EACH <= spare_bits
    sizes = (n_bits // SEGMENTS, spare_bits // SEGMENTS)
    placed = pairs.drop("inserts").mapInPandas(functools.partial(_placed, parts=parts, least=cutoff, n_words=n_words, spare=spare), "segment int, keys binary, held binary")
    built = cut(placed.groupBy("segment").applyInPandas(lambda key, pdf: _built(key, pdf, sizes, n_words), "segment int, data binary"), narrow=True)
    built = {r["segment"]: bytes(r["data"]) for r in built.toLocalIterator()}  # MAX_BITS, a SPARE_PART of it and a number for each of FREQUENT words at most
    vocabulary = above[0]
    others = least > 1  # some words are not broadcast
    pieces = sc.broadcast(Pieces(built, sizes, spare, tokens, vocabulary, cutoff, others))
    del built

    # A doc_id goes to Python as text: a null would make its column one of doubles, which do not hold all 64 bits.
    rows = texts.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text", "held_out")
    asked = rows.mapInPandas(functools.partial(_score, frequent=frequent, pieces=pieces, parts=parts), _BLOCK)
    held = pairs.drop("inserts").mapInPandas(functools.partial(_held, parts=parts, cutoff=cutoff, n_words=n_words), _HELD)
    answers = asked.groupBy("part").cogroup(held.groupBy("part")).applyInPandas(lambda a, b: _answer(a, b, parts, frequent, pieces), _BLOCK)
    return answers.groupBy("part").applyInPandas(_total, _SCORES).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
