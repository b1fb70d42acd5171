import collections
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest

from pulsemill.llm import webp_columns as w


def entropy(argb, top=True, cache_bits=0):
    """A test image with one literal prefix code for each channel; lengths differ, so it takes the symbol-wise path."""
    bits = w.BitWriter()
    bits.put(bool(cache_bits), 1)
    if cache_bits:
        bits.put(cache_bits, 4)
    if top:
        bits.put(0, 1)
    tables = []
    cache, ops = {}, []
    for p in argb.tolist():
        key = (w.CACHE_MULTIPLIER * p & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else None
        ops.append(280 + key if cache_bits and cache.get(key, 0) == p else p)
        cache[key] = p
    is_pixel = [op is p or op == p for op, p in zip(ops, argb.tolist())]
    greens = sorted({(op >> 8 & 255) if ok else op for op, ok in zip(ops, is_pixel)})
    size = 280 + (1 << cache_bits if cache_bits else 0)

    for symbols, alphabet in ((greens, size), *((sorted({p >> s & 255 for p, ok in zip(argb.tolist(), is_pixel) if ok}), 256) for s in (16, 0, 24)), ([0], 40)):
        counts = np.zeros(alphabet, int)
        counts[symbols] = np.arange(len(symbols)) ** 2 + 1  # so that the codes' lengths differ
        lengths = w.code_lengths(counts, 15)
        w.write_code(bits, lengths)
        tables.append(w.canonical(lengths) if sum(map(bool, lengths)) > 1 else None)
    for op, ok in zip(ops, is_pixel):
        symbols = [op >> 8 & 255, op >> 16 & 255, op & 255, op >> 24] if ok else [op]
        for table, s in zip(tables, symbols):
            bits.put(*(table[s] if table else (0, 0)))
    return bits.data()


def head(*fields):
    bits = w.BitWriter()
    for value, n in fields:
        bits.put(value, n)
    return bits.data()


@pytest.fixture
def image():
    rng = np.random.default_rng(1)
    return (rng.integers(0, 6, (24, 20, 4)) * 40 + 10).astype(np.int64)


def decoded(width, height, *parts):
    return w.decode_image(w._file(width, height, np.concatenate(parts)))[0].astype(np.int64)


def test_symbols_and_colour_cache(image):
    argb = w._argb(image).reshape(-1)
    for cache in (0, 1, 4):
        assert (decoded(20, 24, head((0, 1)), entropy(argb, cache_bits=cache)) == image).all()


def test_subtract_green(image):
    stored = image.copy()
    stored[..., 1] -= stored[..., 2]
    stored[..., 3] -= stored[..., 2]
    assert (decoded(20, 24, head((1, 1), (w.SUBTRACT_GREEN, 2), (0, 1)), entropy(w._argb(stored).reshape(-1))) == image).all()


@pytest.mark.parametrize("mode", range(14))
def test_predictors(image, mode):
    stored = np.zeros_like(image)
    for y in range(24):
        for x in range(20):
            stored[y, x] = image[y, x] - w.predicted(image, x, y, mode)
    modes = np.full(3 * 3, 0xFF000000 | mode << 8, np.uint32)
    bits = [head((1, 1), (w.PREDICTOR, 2), (1, 3)), entropy(modes, top=False), head((0, 1)), entropy(w._argb(stored).reshape(-1))]
    assert (decoded(20, 24, *bits) == image).all()


def test_cross_colour(image):
    codes = np.full(3 * 3, 0xFF000000 | 200 << 16 | 17 << 8 | 250, np.uint32)
    stored = w.cross_colour(w._argb(image).reshape(-1), 20, codes, 3, sign=-1)
    assert (stored != w._argb(image).reshape(-1)).any()
    assert (decoded(20, 24, head((1, 1), (w.CROSS_COLOUR, 2), (1, 3)), entropy(codes, top=False), head((0, 1)), entropy(stored)) == image).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 9, 16, 17, 200])
def test_palettes(colours):
    rng = np.random.default_rng(colours)
    table = np.unique(rng.integers(0, 1 << 32, 4 * colours, dtype=np.uint64).astype(np.uint32))[:colours]
    index = rng.integers(0, colours, (9, 21))
    k = w._bundle(colours)
    size, across = 8 >> k, -(-21 >> k)
    padded = np.zeros((9, across << k), np.uint32)
    padded[:, :21] = index
    packed = (padded.reshape(9, across, 1 << k) << (np.arange(1 << k, dtype=np.uint32) * np.uint32(size))).sum(axis=-1).astype(np.uint32).reshape(-1)
    steps = w._argb(np.diff(w._channels(table), axis=0, prepend=np.zeros((1, 4), np.int64)))
    bits = [head((1, 1), (w.PALETTE, 2), (colours - 1, 8)), entropy(steps, top=False), head((0, 1)), entropy(packed << np.uint32(8) | np.uint32(0xFF000000))]
    assert (decoded(21, 9, *bits) == w._channels(table[index])).all()


def test_references_copy_overlapping_runs():
    argb = np.concatenate([np.arange(64, dtype=np.uint32) * np.uint32(0x01030507)] + [np.repeat(np.array([7, 9], np.uint32), 8)] * 5000)
    data = w.encode_image(argb)
    assert len(data) < len(argb) / 10
    assert (w._argb(w.decode_image(data)[0].astype(np.int64)).reshape(-1) == argb).all()


def test_code_lengths_are_optimal_and_bounded():
    rng = np.random.default_rng(0)
    for n in (2, 3, 7, 60, 256):
        counts = rng.integers(0, 1000, n) ** 2 + 1
        lengths = w.code_lengths(counts, 60)
        assert sum(2.0**-k for k in lengths) == 1
        heap = sorted(counts.tolist())
        cost = 0
        while len(heap) > 1:
            two = heap[0] + heap[1]
            cost += two
            heap = sorted(heap[2:] + [two])
        assert int(np.dot(counts, lengths)) == cost
    steep = w.code_lengths([1 << min(i, 40) for i in range(30)], 11)
    assert max(steep) <= 11 and sum(2.0**-k for k in steep) == 1


def test_transforms_are_used_where_they_help():
    seen = collections.Counter()
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 3, 16_000)
    level = bytes((np.repeat(rng.integers(0, 200, 250), 64) + noise).astype(np.uint8))  # rows of nearly one value
    shared = rng.integers(0, 100, 4000)
    tied = np.stack([rng.integers(0, 3, 4000), shared, shared, shared], axis=1).astype(np.uint8).tobytes()  # red, green and blue alike
    for raw in (level, tied, b"abcdabce" * 100, bytes(range(256)) * 40):
        assert w.load(w.store(raw), seen).tobytes()[: len(raw)] == raw
    assert seen["predictor"] and seen["cross_colour"] + seen["subtract_green"] and seen["palette"] and seen["references"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_documents_run_through_the_decoder():
    seen, stored, raw_bytes = collections.Counter(), 0, 0
    for (text,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall():
        raw = (text or "").encode()
        media = w.store(raw)
        assert w.load(media, seen).tobytes()[: len(raw)] == raw
        stored, raw_bytes = stored + len(media), raw_bytes + len(raw)
    assert all(seen[k] for k in ("long_codes", "references", "cache_hits", "palette")) and stored < 0.6 * raw_bytes


def test_rejects_other_files():
    good = w.store(b"some text to be stored here")
    for bad in (b"RIFF....WEBPVP8 ", b"x" + good[1:], good[:20] + b"\0" + good[21:]):
        with pytest.raises(ValueError):
            w.decode_image(bad)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 70_000, 1_100_000])
def test_payloads_round_trip(n):
    rng = np.random.default_rng(n)
    for raw in (rng.bytes(n), b"ab" * (n // 2), bytes(rng.integers(97, 123, n, dtype=np.uint8))):
        assert w.load(w.store(raw)).tobytes() == raw + b"\0" * (-len(raw) % 64 if raw else 64)


def test_columns(docs, corpus):
    got = {r["doc_id"]: r for r in w.read_media(w.to_media(docs)).collect()}
    for i, t, *_ in corpus:
        raw = t.encode()
        payload = raw + b"\0" * (-len(raw) % 64)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], bytes(r["pixels"])) == (len(raw), len(payload), payload)
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
