"""Lossless WebP columns: an encoder for payloads, and a decoder of the whole lossless format to pixel arrays.

Decoder: prefix codes (simple, normal and by meta image), back-references with the distance map, the colour cache, and the
inverses of the four transforms (predictor, cross-colour, subtract-green, palette with pixel bundling).

Encoder: the payload's bytes are the A, R, G and B samples of 16 pixels wide rows. An image of few colours gets a palette
with bundled pixels; another one the predictor, cross-colour or subtract-green transform with the least estimated entropy, or
none. Its pixels become back-references, found along chains of equal pixel pairs, colours in the cache, and literals, in
prefix codes fitted to the image. Payloads over ROWS rows are several images in a row, as a file says its own length.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

WIDTH = 16
UNIT = 4 * WIDTH
#: Rows of one image at most; the format allows 16,384.
ROWS = 16_384

# Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Offsets (x, y) of the distance codes 1 to 120: nearest first; x counts leftwards from the pixel, y upwards.
DISTANCE_MAP = tuple(
    map(
        tuple,
        [
            [0, 1], [1, 0], [1, 1], [-1, 1], [0, 2], [2, 0], [1, 2], [-1, 2], [2, 1], [-2, 1], [2, 2], [-2, 2], [0, 3], [3, 0], [1, 3], [-1, 3],
            [3, 1], [-3, 1], [2, 3], [-2, 3], [3, 2], [-3, 2], [0, 4], [4, 0], [1, 4], [-1, 4], [4, 1], [-4, 1], [3, 3], [-3, 3], [2, 4], [-2, 4],
            [4, 2], [-4, 2], [0, 5], [3, 4], [-3, 4], [4, 3], [-4, 3], [5, 0], [1, 5], [-1, 5], [5, 1], [-5, 1], [2, 5], [-2, 5], [5, 2], [-5, 2],
            [4, 4], [-4, 4], [3, 5], [-3, 5], [5, 3], [-5, 3], [0, 6], [6, 0], [1, 6], [-1, 6], [6, 1], [-6, 1], [2, 6], [-2, 6], [6, 2], [-6, 2],
            [4, 5], [-4, 5], [5, 4], [-5, 4], [3, 6], [-3, 6], [6, 3], [-6, 3], [0, 7], [7, 0], [1, 7], [-1, 7], [5, 5], [-5, 5], [7, 1], [-7, 1],
            [4, 6], [-4, 6], [6, 4], [-6, 4], [2, 7], [-2, 7], [7, 2], [-7, 2], [3, 7], [-3, 7], [7, 3], [-7, 3], [5, 6], [-5, 6], [6, 5], [-6, 5],
            [8, 0], [4, 7], [-4, 7], [7, 4], [-7, 4], [8, 1], [8, 2], [6, 6], [-6, 6], [8, 3], [5, 7], [-5, 7], [7, 5], [-7, 5], [8, 4], [6, 7],
            [-6, 7], [7, 6], [-7, 6], [8, 5], [7, 7], [-7, 7], [8, 6], [8, 7],
        ],
    )
)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
TRANSFORMS = ("predictor", "cross_colour", "subtract_green", "palette")
CACHE_MULTIPLIER = 0x1E35A7BD
GREEN_SYMBOLS, LENGTH_SYMBOLS, DISTANCE_SYMBOLS = 256, 24, 40


# --- bits -----------------------------------------------------------------------------------------------------------


class BitWriter:
    """Bits from the least significant on."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, bits: int) -> None:
        self.value |= value << self.n
        self.n += bits

    def add(self, other: BitWriter) -> None:
        self.put(other.value, other.n)

    def data(self) -> np.ndarray:
        raw = self.value.to_bytes(-(-self.n // 8), "little")
        return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: self.n]


class BitReader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def peek(self, bits: int) -> int:
        start = self.at >> 3
        return (int.from_bytes(self.data[start : start + 6], "little") >> (self.at & 7)) & ((1 << bits) - 1)

    def get(self, bits: int) -> int:
        value = self.peek(bits)
        self.at += bits
        return value


# --- prefix codes ----------------------------------------------------------------------------------------------------


def _mirror() -> np.ndarray:
    whole = np.arange(1 << 15)
    return sum(((whole >> i) & 1) << (14 - i) for i in range(15))


#: The 15 bits of each number in reverse.
_MIRROR = _mirror()


def _codes(lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols in use, their codes with the first bit lowest, and the codes' lengths."""
    sizes = np.array(lengths, np.int64)
    symbols = np.nonzero(sizes)[0]
    symbols = symbols[np.argsort(sizes[symbols], kind="stable")]
    sizes = sizes[symbols]
    share = 1 << (15 - sizes)
    return symbols, _MIRROR[np.cumsum(share) - share], sizes


def canonical(lengths) -> dict[int, tuple[int, int]]:
    """symbol -> (code with its first bit lowest, length)."""
    symbols, codes, sizes = (a.tolist() for a in _codes(lengths))
    return dict(zip(symbols, zip(codes, sizes)))


def code_lengths(counts, most: int) -> list[int]:
    """Lengths of an optimal prefix code, `most` bits at most (then nearly optimal); a symbol that stands alone has length 1."""
    counts = np.asarray(counts)
    used = np.nonzero(counts)[0]
    lengths = [0] * len(counts)
    if len(used) < 2:
        lengths[int(used[0]) if len(used) else 0] = 1
        return lengths
    weights = counts[used].astype(np.int64)
    n = len(used)
    while True:
        order = np.argsort(weights, kind="stable")
        leaves, inner = [*weights[order].tolist(), math.inf], [math.inf] * n
        parent = [0] * (2 * n - 1)
        leaf = node = 0
        for new in range(n - 1):  # inner nodes come out in rising order, so two queues do
            if leaves[leaf] <= inner[node]:
                total, parent[leaf], leaf = leaves[leaf], n + new, leaf + 1
            else:
                total, parent[n + node], node = inner[node], n + new, node + 1
            if leaves[leaf] <= inner[node]:
                inner[new], parent[leaf], leaf = total + leaves[leaf], n + new, leaf + 1
            else:
                inner[new], parent[n + node], node = total + inner[node], n + new, node + 1
        depth = [0] * (2 * n - 1)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[parent[node]] + 1
        if max(depth[:n]) <= most:
            break
        weights = weights // 2 + 1  # flatter, until the code is short enough
    for symbol, size in zip(used[order].tolist(), depth):
        lengths[symbol] = size
    return lengths


@functools.cache
def _mirrored(width: int) -> np.ndarray:
    """The numbers of `width` bits with their bits in reverse."""
    return _MIRROR[: 1 << width] >> (15 - width)


class PrefixCode:
    """Decoding table of a prefix code: symbol << 4 | length for the next `width` bits. A code of one symbol takes no bits."""

    def __init__(self, lengths: list[int]):
        sizes = np.array(lengths, np.int64)
        symbols = np.nonzero(sizes)[0]
        if len(symbols) == 1:
            self.width, self.table = 0, (symbols << 4).astype(np.uint16)
            return
        symbols = symbols[np.argsort(sizes[symbols], kind="stable")]
        sizes = sizes[symbols]
        self.width = int(sizes[-1]) if len(sizes) else 0
        share = 1 << (self.width - sizes)
        if share.sum() != 1 << self.width:
            raise ValueError("prefix code is not complete")
        self.table = np.repeat((symbols << 4 | sizes).astype(np.uint16), share)[_mirrored(self.width)]

    @functools.cached_property
    def listed(self) -> list[int]:
        return self.table.tolist()

    @functools.cached_property
    def sizes(self) -> np.ndarray:
        return (self.table & 15).astype(np.intp)

    def read(self, bits: BitReader) -> int:
        entry = int(self.table[bits.peek(self.width)])
        bits.at += entry & 15
        return entry >> 4


def read_code(bits: BitReader, alphabet: int, last: tuple[PrefixCode, int, int] | None = None) -> PrefixCode:
    """The next prefix code. last: a code of the same alphabet with its place and bits; if the same bits follow, so does the same code."""
    if last is not None:
        code, start, size = last
        whole = lambda at: (int.from_bytes(bits.data[at >> 3 : (at + size + 7) >> 3], "little") >> (at & 7)) & ((1 << size) - 1)
        if whole(start) == whole(bits.at):
            bits.at += size
            return code
    lengths = [0] * alphabet
    if bits.get(1):  # simple: one or two symbols
        two = bits.get(1)
        lengths[bits.get(8 if bits.get(1) else 1)] = 1
        if two:
            lengths[bits.get(8)] = 1
        return PrefixCode(lengths)
    own = [0] * 19
    for symbol in CODE_LENGTH_ORDER[: 4 + bits.get(4)]:
        own[symbol] = bits.get(3)
    code = PrefixCode(own)
    left = 2 + bits.get(2 + 2 * bits.get(3)) if bits.get(1) else alphabet
    table, mask = code.listed, (1 << code.width) - 1
    data, start, held, window = bits.data, bits.at, 0, 0
    at, last_length = 0, 8
    while at < alphabet and left:
        left -= 1
        if held < 16:  # a symbol with its extra bits takes 14 at most
            window = int.from_bytes(data[start >> 3 : (start >> 3) + 64], "little") >> (start & 7)
            held = 512 - (start & 7)
        entry = table[window & mask]
        symbol, size = entry >> 4, entry & 15
        window >>= size
        if symbol < 16:
            lengths[at] = symbol
            last_length = symbol or last_length
            at += 1
        else:
            extra, base, value = (2, 3, last_length) if symbol == 16 else (3, 3, 0) if symbol == 17 else (7, 11, 0)
            n = base + (window & ((1 << extra) - 1))
            window >>= extra
            size += extra
            if value:
                lengths[at : at + n] = [value] * n
            at += n
        start += size
        held -= size
    bits.at = start
    if at > alphabet:
        raise ValueError("code lengths run over the alphabet")
    return PrefixCode(lengths)


def read_codes(bits: BitReader, sizes: tuple[int, ...]) -> list[PrefixCode]:
    """One code for each alphabet."""
    out: list[PrefixCode] = []
    last: dict[int, tuple[PrefixCode, int, int]] = {}
    for alphabet in sizes:
        start = bits.at
        out.append(read_code(bits, alphabet, last.get(alphabet)))
        last[alphabet] = (out[-1], start, bits.at - start)
    return out


def _length_steps(lengths: list[int], used: list[int]) -> list[tuple[int, int, int]]:
    """(symbol, extra, bits of extra) that spell the lengths: runs of zeros are cut short."""
    out, at = [], 0
    for symbol in [*used, len(lengths)]:
        gap, at = symbol - at, symbol + 1
        while gap > 10:
            step = min(gap, 138)
            out.append((18, step - 11, 7))
            gap -= step
        if gap > 2:
            out.append((17, gap - 3, 3))
        else:
            out += [(0, 0, 0)] * gap
        if symbol < len(lengths):
            out.append((lengths[symbol], 0, 0))
    return out


def write_code(bits: BitWriter, lengths: list[int]) -> None:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and used[-1] < 256:
        bits.put(1, 1)
        bits.put(len(used) - 1, 1)
        bits.put(1, 1)
        bits.put(used[0], 8)
        if len(used) == 2:
            bits.put(used[1], 8)
        return
    steps = _length_steps(lengths, used)
    counts = [0] * 19
    for kind, _, _ in steps:
        counts[kind] += 1
    sizes = code_lengths(counts, 7)
    told = max(4, max(i for i, symbol in enumerate(CODE_LENGTH_ORDER) if sizes[symbol]) + 1)
    bits.put(0, 1)
    bits.put(told - 4, 4)
    for symbol in CODE_LENGTH_ORDER[:told]:
        bits.put(sizes[symbol], 3)
    bits.put(0, 1)
    codes = canonical(sizes)
    if len(codes) == 1:
        codes = dict.fromkeys(codes, (0, 0))
    value, at = 0, 0
    for kind, extra, extra_bits in steps:
        code, size = codes[kind]
        value |= (code | extra << size) << at
        at += size + extra_bits
    bits.put(value, at)


# --- decoder -----------------------------------------------------------------------------------------------------------


def _extra(symbol: int, bits: BitReader) -> int:
    """Length or distance of a prefix symbol and its extra bits."""
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.get(n) + 1


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    x, y = DISTANCE_MAP[code - 1]
    return max(1, x + y * width)


#: Pixels from which on an image with one group of codes is read by array operations.
FEW = 64
#: Bytes of an image's bits that are looked up at once.
BLOCK = 2048


def _one_group(bits: BitReader, width: int, total: int, group: list[PrefixCode], cache_bits: int, seen: Counter) -> np.ndarray:
    """Pixels of an image with one group of codes.

    All codes are looked up at each bit of a block, as if a pixel started there, so what is left to do one by one is to go
    from pixel to pixel; the values of those that do start are put together at once.
    """
    green, red, blue, alpha, far = group
    # bits to the next pixel and 1, where green says so: 0 for a reference, -1 for a literal
    known = np.where(green.table < 4096, -1, np.where(green.table >> 4 < 256 + LENGTH_SYMBOLS, 0, green.sizes + 1))
    raw = np.frombuffer(bits.data + bytes(BLOCK + 32), np.uint8).astype(np.uint32)
    shifts, here = np.arange(8, dtype=np.uint32), np.arange(8 * BLOCK)
    values, slots, copies = [], [], []
    at, left, tokens = bits.at, total, 0
    while left:
        start = at >> 3
        if start > len(bits.data):
            raise ValueError("image ends early")
        own = min(BLOCK, len(bits.data) + 1 - start)
        b = raw[start : start + own + 10]
        window = ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16))[:, None] >> shifts).reshape(-1).astype(np.intp)
        look = {c: window & ((1 << c.width) - 1) for c in {green, red, blue, alpha}}
        sizes = {c: c.sizes[look[c]] for c in {red, blue, alpha}}
        first = look[green][: 8 * own]
        r_at = here[: 8 * own] + green.sizes[first]
        b_at = r_at + sizes[red][r_at]
        a_at = b_at + sizes[blue][b_at]
        whole = a_at + sizes[alpha][a_at] - here[: 8 * own] + 1
        step = known[first]
        step = np.where(step < 0, whole, step).astype(np.uint8).tobytes()
        base, end, places = 8 * start, 8 * own, []
        place = at - base
        while place < end and left:
            size = step[place]
            if size:
                places.append(place)
                place += size - 1
                left -= 1
                continue
            entry = int(green.table[first[place]])
            bits.at = base + place + (entry & 15)
            length = min(_extra((entry >> 4) - 256, bits), left)
            copies.append((tokens + len(places), length, _distance(_extra(far.read(bits), bits), width)))
            left -= length
            place = bits.at - base
        at, tokens = base + place, tokens + len(places)
        p = np.array(places, np.int64)
        symbol = green.table[first[p]] >> 4
        r, bl, a = (code.table[look[code][x[p]]] >> 4 for code, x in ((red, r_at), (blue, b_at), (alpha, a_at)))
        pixel = (a.astype(np.uint32) << np.uint32(24)) | (r.astype(np.uint32) << np.uint32(16)) | (symbol.astype(np.uint32) << np.uint32(8)) | bl
        slot = symbol.astype(np.int64) - 256 - LENGTH_SYMBOLS
        values.append(pixel)
        slots.append(slot)
    bits.at = at
    value, slot = np.concatenate(values), np.concatenate(slots)
    from_cache = np.nonzero(slot >= 0)[0].tolist()
    seen.update(cache_hits=len(from_cache), references=len(copies))
    if not copies and not from_cache:
        return value
    if from_cache:
        slot = np.where(slot < 0, (value * np.uint32(CACHE_MULTIPLIER)) >> np.uint32(32 - cache_bits), slot)
    value, slot, cache = value.tolist(), slot.tolist(), {}
    pixels, kept_at = [], []  # the pixels and their places in the cache
    taken, cached, hit = 0, 0, 0
    for token, length, back in [*copies, (tokens, 0, 1)]:
        while hit < len(from_cache) and from_cache[hit] < token:
            n = from_cache[hit]
            pixels += value[taken:n]
            kept_at += slot[taken : n + 1]
            cache.update(zip(kept_at[cached:-1], pixels[cached:]))
            cached = len(kept_at)  # what comes from the cache is there already
            pixels.append(cache.get(slot[n], 0))
            taken, hit = n + 1, hit + 1
        pixels += value[taken:token]
        kept_at += slot[taken:token]
        taken, n = token, len(pixels)
        if length and back > n:
            raise ValueError("reference before the image")
        if length:  # it may run on over what it has just copied
            times, first, last = -(-length // min(length, back)), n - back, n - back + min(length, back)
            pixels += (pixels[first:last] * times)[:length]
            kept_at += (kept_at[first:last] * times)[:length]
    return np.array(pixels, np.uint32)


def _entropy_image(bits: BitReader, width: int, height: int, top: bool, seen: Counter) -> np.ndarray:
    """ARGB pixels of an image without transforms: codes, references and colour cache."""
    cache_bits = bits.get(4) if bits.get(1) else 0
    meta, shift = None, 0
    if top and bits.get(1):
        shift = bits.get(3) + 2
        meta = _entropy_image(bits, -(-width >> shift), -(-height >> shift), False, seen)
        meta = ((meta >> 8) & 0xFFFF).tolist()
    sizes = (GREEN_SYMBOLS + LENGTH_SYMBOLS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_SYMBOLS)
    groups = [read_codes(bits, sizes) for _ in range(1 + (max(meta) if meta is not None else 0))]
    total, across = width * height, -(-width >> shift)
    seen.update(literals=total, long_codes=sum(c.width > 0 for g in groups for c in g), meta_images=int(meta is not None))
    if meta is None and total >= FEW:
        return _one_group(bits, width, total, groups[0], cache_bits, seen)
    cache, drop = [0] * (1 << cache_bits), 32 - cache_bits
    pixels: list[int] = []
    cached = 0  # pixels that the cache has taken in; it is brought up to date only when it is read
    data, at, n, hits, copies = bits.data, bits.at, 0, 0, 0
    window, left = 0, 0  # bits that are read ahead
    green, red, blue, alpha, far = groups[0]
    g_table, g_mask = green.listed, (1 << green.width) - 1
    r_table, r_mask, b_table, b_mask, a_table, a_mask = red.listed, (1 << red.width) - 1, blue.listed, (1 << blue.width) - 1, alpha.listed, (1 << alpha.width) - 1
    while n < total:
        if meta is not None:
            green, red, blue, alpha, far = groups[meta[(n // width >> shift) * across + (n % width >> shift)]]
            g_table, g_mask = green.listed, (1 << green.width) - 1
            r_table, r_mask, b_table, b_mask, a_table, a_mask = red.listed, (1 << red.width) - 1, blue.listed, (1 << blue.width) - 1, alpha.listed, (1 << alpha.width) - 1
        if left < 60:  # the four codes take no more
            window = int.from_bytes(data[at >> 3 : (at >> 3) + 32], "little") >> (at & 7)
            left = 256 - (at & 7)
        entry = g_table[window & g_mask]
        size = entry & 15
        window >>= size
        if entry < 4096:
            r = r_table[window & r_mask]
            window >>= r & 15
            b = b_table[window & b_mask]
            window >>= b & 15
            a = a_table[window & a_mask]
            window >>= a & 15
            size += (r & 15) + (b & 15) + (a & 15)
            at += size
            left -= size
            pixels.append((a >> 4) << 24 | (r >> 4) << 16 | (entry >> 4) << 8 | b >> 4)
            n += 1
            continue
        left -= size
        symbol, at = entry >> 4, at + size
        if symbol >= 256 + LENGTH_SYMBOLS:
            for p in pixels[cached:n]:
                cache[(CACHE_MULTIPLIER * p & 0xFFFFFFFF) >> drop] = p
            cached = n
            pixels.append(cache[symbol - 256 - LENGTH_SYMBOLS])
            n += 1
            hits += 1
            continue
        bits.at = at
        left = 0
        length = min(_extra(symbol - 256, bits), total - n)
        back = _distance(_extra(far.read(bits), bits), width)
        at = bits.at
        if back > n:
            raise ValueError("reference before the image")
        run = pixels[n - back : n - back + min(length, back)]  # a reference may run on over what it has just copied
        pixels += (run * (-(-length // len(run))))[:length]
        n += length
        copies += 1
    bits.at = at
    seen.update(cache_hits=hits, references=copies)
    return np.array(pixels, np.uint32)


def _channels(argb: np.ndarray) -> np.ndarray:
    """int64 array of A, R, G, B in the last axis."""
    return np.stack([(argb >> np.uint32(s)) & np.uint32(255) for s in (24, 16, 8, 0)], axis=-1).astype(np.int64)


def _argb(channels: np.ndarray) -> np.ndarray:
    c = (channels & 255).astype(np.uint32)
    return c[..., 0] << np.uint32(24) | c[..., 1] << np.uint32(16) | c[..., 2] << np.uint32(8) | c[..., 3]


def _select(left, top, corner):
    """The one of left and top that is nearer to left + top - corner over all channels."""
    to_left, to_top = np.abs(top - corner).sum(axis=-1), np.abs(left - corner).sum(axis=-1)
    return np.where((to_left < to_top)[..., None], left, top)


def _half(a, b):
    d = a - b
    return np.clip(a + np.where(d < 0, -(-d // 2), d // 2), 0, 255)


PREDICTORS = (
    lambda l, t, c, r: np.broadcast_to(np.array([255, 0, 0, 0]), l.shape),
    lambda l, t, c, r: l,
    lambda l, t, c, r: t,
    lambda l, t, c, r: r,
    lambda l, t, c, r: c,
    lambda l, t, c, r: ((l + r) // 2 + t) // 2,
    lambda l, t, c, r: (l + c) // 2,
    lambda l, t, c, r: (l + t) // 2,
    lambda l, t, c, r: (c + t) // 2,
    lambda l, t, c, r: (t + r) // 2,
    lambda l, t, c, r: ((l + c) // 2 + (t + r) // 2) // 2,
    lambda l, t, c, r: _select(l, t, c),
    lambda l, t, c, r: np.clip(l + t - c, 0, 255),
    lambda l, t, c, r: _half((l + t) // 2, c),
)


def predicted(pixels: np.ndarray, x: int, y: int, mode: int) -> np.ndarray:
    """Prediction of pixel (x, y) from pixels before it; pixels: height, width, 4."""
    if not y:
        return np.array([255, 0, 0, 0]) if not x else pixels[0, x - 1]
    if not x:
        return pixels[y - 1, 0]
    width = pixels.shape[1]
    right = pixels[y - 1, x + 1] if x + 1 < width else pixels[y, 0]
    return PREDICTORS[mode if mode < 14 else 0](pixels[y, x - 1], pixels[y - 1, x], pixels[y - 1, x - 1], right)


#: Modes that don't use the pixel to the left, so a row's block is one array operation.
_ABOVE_ONLY = {0, 2, 3, 4, 8, 9}


def undo_predictor(argb: np.ndarray, width: int, modes: np.ndarray, shift: int) -> np.ndarray:
    p = _channels(argb).reshape(-1, width, 4)
    modes = ((modes >> np.uint32(8)) & np.uint32(15)).reshape(-1, -(-width >> shift))
    p[0, 0] += [255, 0, 0, 0]
    p[0] = np.cumsum(p[0], axis=0) & 255
    for y in range(1, len(p)):
        row, above = p[y], p[y - 1]
        row[0] = (row[0] + above[0]) & 255
        for b, mode in enumerate(modes[y >> shift]):
            lo, hi = max(1, b << shift), min(width, (b + 1) << shift)
            if lo >= hi:
                continue
            if mode == 1:
                row[lo:hi] = (row[lo - 1] + np.cumsum(row[lo:hi], axis=0)) & 255
            elif int(mode) in _ABOVE_ONLY or mode > 13:
                right = np.concatenate([above[lo + 1 : hi + 1], row[:1]])[: hi - lo]
                row[lo:hi] = (row[lo:hi] + PREDICTORS[mode if mode < 14 else 0](above[lo:hi], above[lo:hi], above[lo - 1 : hi - 1], right)) & 255
            else:
                for x in range(lo, hi):
                    row[x] = (row[x] + predicted(p, x, y, int(mode))) & 255
    return _argb(p).reshape(-1)


def _signed(x: np.ndarray) -> np.ndarray:
    return ((x & 255) ^ 128) - 128


def cross_colour(argb: np.ndarray, width: int, codes: np.ndarray, shift: int, sign: int = 1) -> np.ndarray:
    """Add (sign 1: the inverse) or take away (-1: the transform) the colour correlations of each block."""
    p = _channels(argb).reshape(-1, width, 4)
    y, x = np.indices(p.shape[:2])
    code = _channels(codes).reshape(-1, -(-width >> shift), 4)[y >> shift, x >> shift]
    delta = lambda t, c: _signed(t) * _signed(c) >> 5
    red, green, blue = p[..., 1], p[..., 2], p[..., 3]
    new_red = (red + sign * delta(code[..., 3], green)) & 255
    by_red = new_red if sign > 0 else red
    new_blue = (blue + sign * (delta(code[..., 2], green) + delta(code[..., 1], by_red))) & 255
    return _argb(np.stack([p[..., 0], new_red, green, new_blue], axis=-1)).reshape(-1)


def add_green(argb: np.ndarray) -> np.ndarray:
    p = _channels(argb)
    p[..., 1] += p[..., 2]
    p[..., 3] += p[..., 2]
    return _argb(p)


def _bundle(colours: int) -> int:
    """Pixels of a palette image that share one stored pixel: 2 to this power."""
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def undo_palette(argb: np.ndarray, width: int, table: np.ndarray) -> np.ndarray:
    k = _bundle(len(table))
    stored = ((argb >> np.uint32(8)) & np.uint32(255)).reshape(-1, -(-width >> k))
    size = 8 >> k
    index = np.stack([(stored >> np.uint32(i * size)) & np.uint32((1 << size) - 1) for i in range(1 << k)], axis=-1)
    index = index.reshape(len(stored), -1)[:, :width].reshape(-1)
    whole = np.zeros(256, np.uint32)
    whole[: len(table)] = table
    return whole[index]


def decode_image(data: bytes, start: int = 0, seen: Counter | None = None) -> tuple[np.ndarray, int, int]:
    """Pixels (height, width, 4: A, R, G, B as uint8) of the image at `start`, its bytes, and the file's length. seen counts what was decoded."""
    seen = Counter() if seen is None else seen
    if data[start : start + 4] != b"RIFF" or data[start + 8 : start + 16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    length = 8 + struct.unpack_from("<I", data, start + 4)[0]
    size = struct.unpack_from("<I", data, start + 16)[0]
    bits = BitReader(data[start + 20 : start + 20 + size])
    if bits.get(8) != 0x2F:
        raise ValueError("no lossless signature")
    width, height = bits.get(14) + 1, bits.get(14) + 1
    bits.get(1)
    if bits.get(3):
        raise ValueError("unknown version")
    undo, used, stored = [], set(), width
    while bits.get(1):
        kind = bits.get(2)
        if kind in used:
            raise ValueError("a transform is used twice")
        used.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.get(3) + 2
            image = _entropy_image(bits, -(-stored >> shift), -(-height >> shift), False, seen)
            undo.append((undo_predictor if kind == PREDICTOR else cross_colour, (stored, image, shift)))
        elif kind == SUBTRACT_GREEN:
            undo.append((add_green, ()))
        else:
            n = bits.get(8) + 1
            table = _argb(np.cumsum(_channels(_entropy_image(bits, n, 1, False, seen)), axis=0))
            undo.append((undo_palette, (stored, table)))
            stored = -(-stored >> _bundle(n))
    argb = _entropy_image(bits, stored, height, True, seen)
    seen.update(TRANSFORMS[kind] for kind in used)
    for function, args in reversed(undo):
        argb = function(argb, *args)
    return argb.astype(">u4").view(np.uint8).reshape(height, width, 4), size, length


# --- encoder -----------------------------------------------------------------------------------------------------------


def _file(width: int, height: int, bits: np.ndarray) -> bytes:
    head = BitWriter()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)):
        head.put(value, n)
    body = np.packbits(np.concatenate([head.data(), bits]), bitorder="little").tobytes()
    pad = b"\0" * (len(body) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(body) + len(pad)) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body + pad


#: Bits of the longest code that the encoder writes; the format allows 15, and shorter tables are read faster.
LONGEST_CODE = 11
#: Candidates that are tried along a chain, and pixels that one reference copies at most.
CHAIN, MOST_COPIED = 8, 4096
#: Modes that the encoder tries; their inverses are array operations.
MODES = (1, 2, 3, 4)
#: Rows of a block with a mode or a colour correlation of its own.
BLOCK_BITS = 4


def _entropy(argb: np.ndarray) -> float:
    """Bits that the four channels take with a prefix code each, about."""
    bits = 0.0
    for shift in (24, 16, 8, 0):
        n = np.bincount((argb >> np.uint32(shift)).astype(np.uint8), minlength=256)
        n = n[n > 0]
        bits += float(n @ np.log2(len(argb) / n)) + 6 * len(n)  # about six bits tell a symbol's length
    return bits


@functools.cache
def _distance_codes(width: int) -> dict[int, int]:
    return {max(1, x + y * width): code for code, (x, y) in reversed(list(enumerate(DISTANCE_MAP, 1)))}


def _references(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy (start, length, distance) of copies of two pixels or more, the longest of CHAIN candidates along chains of equal pixel pairs."""
    n = len(pixels)
    if n < 3:
        return []
    pair = (pixels[:-1].astype(np.uint64) << np.uint64(32)) | pixels[1:]
    order = np.argsort(pair, kind="stable")
    same = pair[order[1:]] == pair[order[:-1]]
    if not same.any():
        return []
    before = np.full(n, -1)
    before[order[1:][same]] = order[:-1][same]
    starts, before, values = np.nonzero(before >= 0)[0].tolist(), before.tolist(), pixels.tolist()
    out, k = [], 0
    while k < len(starts):
        at = starts[k]
        best, distance, source = 0, 0, before[at]
        most = min(n - at, MOST_COPIED)
        for _ in range(CHAIN):
            if source < 0:
                break
            size = 2
            while size < most and values[source + size] == values[at + size]:
                size += 1
            if size > best:
                best, distance = size, at - source
            if size == most:
                break
            source = before[source]
        out.append((at, best, distance))
        k = bisect_left(starts, at + best, k + 1)
    return out


def _prefixes(values: list[int]) -> np.ndarray:
    """Symbols, extra bits and their numbers for lengths or distances."""
    out = []
    for v in values:
        v -= 1
        n = max(v.bit_length() - 2, 0)
        out.append((v, 0, 0) if v < 4 else (2 * n + 2 + ((v >> n) & 1), v & ((1 << n) - 1), n))
    return np.array(out, np.int64).reshape(-1, 3).T


def _cache_hits(argb: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cache slot of each pixel, and whether the slot holds the pixel when it comes."""
    slot = ((argb * np.uint32(CACHE_MULTIPLIER)) >> np.uint32(32 - bits)).astype(np.uint16)
    order = np.argsort(slot, kind="stable")
    hit = np.zeros(len(argb), bool)
    hit[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (argb[order[1:]] == argb[order[:-1]])
    return slot.astype(np.int64), hit


def _code_table(counts: np.ndarray) -> tuple[np.ndarray, BitWriter]:
    """(codes and their lengths by symbol, the code as it is written); a code of one symbol takes no bits."""
    lengths = code_lengths(counts, LONGEST_CODE)
    written = BitWriter()
    write_code(written, lengths)
    symbols, codes, sizes = _codes(lengths)
    table = np.zeros((2, len(counts)), np.uint64)
    if len(symbols) > 1:
        table[0, symbols], table[1, symbols] = codes, sizes
    return table, written


def _entropy_bits(argb: np.ndarray, width: int, top: bool) -> BitWriter:
    """The bits of an image without transforms. Red, blue and alpha share one code: payloads of text fill them alike."""
    n = len(argb)
    literal = np.ones(n, bool)
    copies = np.array(_references(argb), np.int64).reshape(-1, 3)
    for start, length, _ in copies.tolist():
        literal[start : start + length] = False
    cache_bits = min(10, max(1, n.bit_length() - 4))
    slot, hit = _cache_hits(argb, cache_bits)
    hit &= literal
    if np.count_nonzero(hit) < 8:  # too few for what the longer alphabet costs
        cache_bits, hit = 0, np.zeros(n, bool)
    literal &= ~hit
    at, hit_at = np.nonzero(literal)[0], np.nonzero(hit)[0]
    samples = argb[at].view(np.uint8).reshape(-1, 4)  # blue, green, red, alpha
    near = _distance_codes(width)
    length, length_extra, length_bits = _prefixes(copies[:, 1].tolist())
    far, far_extra, far_bits = _prefixes([near.get(d, d + 120) for d in copies[:, 2].tolist()])
    alphabet = GREEN_SYMBOLS + LENGTH_SYMBOLS + (1 << cache_bits if cache_bits else 0)
    first = np.concatenate([samples[:, 1], GREEN_SYMBOLS + length, GREEN_SYMBOLS + LENGTH_SYMBOLS + slot[hit_at]]).astype(np.int64)
    green, green_written = _code_table(np.bincount(first, minlength=alphabet))
    other, other_written = _code_table(np.bincount(samples[:, [0, 2, 3]].ravel(), minlength=256))
    distance, distance_written = _code_table(np.bincount(far, minlength=DISTANCE_SYMBOLS))

    head = BitWriter()
    head.put(int(cache_bits > 0), 1)
    if cache_bits:
        head.put(cache_bits, 4)
    if top:
        head.put(0, 1)  # no meta image
    for written in (green_written, other_written, other_written, other_written, distance_written):
        head.add(written)

    place = np.concatenate([at, copies[:, 0], hit_at])
    words, size = green[0][first], green[1][first]
    m, k = len(at), len(copies)
    for channel in (2, 0, 3):
        words[:m] |= other[0][samples[:, channel]] << size[:m]
        size[:m] += other[1][samples[:, channel]]
    for value, bits in ((length_extra, length_bits), (distance[0][far], distance[1][far]), (far_extra, far_bits)):
        words[m : m + k] |= value.astype(np.uint64) << size[m : m + k]
        size[m : m + k] += bits.astype(np.uint64)
    order = np.argsort(place)
    head.add(_joined(words[order], size[order]))
    return head


def _joined(words: np.ndarray, size: np.ndarray) -> BitWriter:
    """Words of `size` bits, fewer than 64, one after another."""
    out = BitWriter()
    end = np.cumsum(size)
    start = end - size
    cell, inside = start >> np.uint64(6), start & np.uint64(63)
    first = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1])  # a word starts in every cell
    last = np.concatenate([first[1:], [len(words)]]) - 1
    cells = np.zeros(len(first) + 1, np.uint64)
    cells[:-1] = np.bitwise_or.reduceat(words << inside, first)
    cells[1:] |= (words[last] >> np.uint64(1)) >> (np.uint64(63) - inside[last])  # what runs over into the next cell
    out.put(int.from_bytes(cells.tobytes(), "little"), int(end[-1]))
    return out


def _neighbours(pixels: np.ndarray) -> tuple[np.ndarray, ...]:
    """Left, top, top left and top right pixels; zeros where there are none (those places aren't predicted by mode)."""
    flat = pixels.reshape(-1, 4)
    width = pixels.shape[1]
    moved = lambda k: np.concatenate([np.zeros((k, 4), np.int64), flat])[: len(flat)].reshape(pixels.shape)
    return moved(1), moved(width), moved(width + 1), moved(width - 1)


def do_predictor(argb: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(residuals, image of modes): for each block the one of MODES with the smallest residuals."""
    p = _channels(argb).reshape(-1, width, 4)
    around = _neighbours(p)
    rest = np.stack([_signed(p - PREDICTORS[mode](*around)) for mode in MODES])
    rows = np.arange(0, len(p), 1 << BLOCK_BITS)
    columns = np.arange(0, width, 1 << BLOCK_BITS)
    sums = np.add.reduceat(np.add.reduceat(np.abs(rest).sum(axis=-1), rows, axis=1), columns, axis=2)
    best = sums.argmin(axis=0)
    y, x = np.indices(p.shape[:2]) >> BLOCK_BITS
    out = np.take_along_axis(rest, best[y, x][None, :, :, None], axis=0)[0]
    out[0] = p[0] - around[0][0]
    out[1:, 0] = p[1:, 0] - p[:-1, 0]
    out[0, 0] = p[0, 0] - [255, 0, 0, 0]
    return _argb(out).reshape(-1), (np.array(MODES, np.uint32)[best.reshape(-1)] << np.uint32(8)) | np.uint32(0xFF000000)


def do_cross_colour(argb: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(pixels, image of colour codes): red and blue less the share of green that least squares give for the image."""
    p = _signed(_channels(argb)).astype(np.float64)
    green = p[:, 2] - p[:, 2].mean()
    power = max(float(green @ green), 1.0)
    share = lambda c: int(np.clip(round(32 * float(green @ (p[:, c] - p[:, c].mean())) / power), -127, 127)) & 255
    blocks = -(-width >> BLOCK_BITS) * -(-(len(argb) // width) >> BLOCK_BITS)
    codes = np.full(blocks, 0xFF000000 | share(3) << 8 | share(1), np.uint32)
    return cross_colour(argb, width, codes, BLOCK_BITS, sign=-1), codes


def _take_green(argb: np.ndarray) -> np.ndarray:
    p = _channels(argb)
    p[..., 1] -= p[..., 2]
    p[..., 3] -= p[..., 2]
    return _argb(p)


def _related(argb: np.ndarray) -> bool:
    """Whether neighbours or channels are alike enough for a transform to be worth trying."""
    samples = argb.view(np.uint8)
    near = max(float((samples[4:] == samples[:-4]).mean()), float((samples[UNIT:] == samples[:-UNIT]).mean()) if len(samples) > UNIT else 0.0)
    p = argb.view(np.uint8).reshape(-1, 4)
    return near > 0.3 or float((p[:, 1] == p[:, 2]).mean()) > 0.3 or float((p[:, 1] == p[:, 0]).mean()) > 0.3


def encode_image(argb: np.ndarray, width: int = WIDTH) -> bytes:
    """A file of pixels in rows of `width`."""
    height = len(argb) // width
    head = BitWriter()

    def transform(kind: int) -> None:
        head.put(1, 1)
        head.put(kind, 2)

    colours = np.sort(argb)
    colours = colours[np.concatenate([[True], colours[1:] != colours[:-1]])]
    if len(colours) <= 256 and 4 * len(colours) <= len(argb):
        k = _bundle(len(colours))
        index = np.zeros((height, -(-width >> k) << k), np.uint32)
        index[:, :width] = np.searchsorted(colours, argb).reshape(height, width)
        bundled = (index.reshape(height, -1, 1 << k) << (np.arange(1 << k, dtype=np.uint32) * np.uint32(8 >> k))).sum(axis=-1).astype(np.uint32).reshape(-1)
        transform(PALETTE)
        head.put(len(colours) - 1, 8)
        steps = _argb(np.diff(_channels(colours), axis=0, prepend=np.zeros((1, 4), np.int64)))
        head.add(_entropy_bits(steps, len(steps), False))
        head.put(0, 1)  # no further transform
        head.add(_entropy_bits(bundled << np.uint32(8) | np.uint32(0xFF000000), -(-width >> k), True))
        return _file(width, height, head.data())
    pixels = argb
    if _related(argb):
        rest, modes = do_predictor(argb, width)
        shifted, codes = do_cross_colour(argb, width)
        options = [(_entropy(argb), None, argb, None), (_entropy(rest) + _entropy(modes), PREDICTOR, rest, modes), (_entropy(shifted) + _entropy(codes), CROSS_COLOUR, shifted, codes), (_entropy(green := _take_green(argb)), SUBTRACT_GREEN, green, None)]
        _, kind, pixels, image = min(options, key=lambda o: o[0])
        if kind is not None:
            transform(kind)
            if image is not None:
                head.put(BLOCK_BITS - 2, 3)
                head.add(_entropy_bits(image, -(-width >> BLOCK_BITS), False))
    head.put(0, 1)
    head.add(_entropy_bits(pixels, width, True))
    return _file(width, height, head.data())


def store(raw: bytes) -> bytes:
    """The payload (raw with bytes 0 up to a positive multiple of UNIT) as one or more files."""
    payload = raw + b"\0" * (-len(raw) % UNIT if raw else UNIT)
    argb = np.frombuffer(payload, ">u4").astype(np.uint32)
    return b"".join(encode_image(argb[i : i + ROWS * WIDTH]) for i in range(0, len(argb), ROWS * WIDTH))


def load(media: bytes, seen: Counter | None = None) -> np.ndarray:
    """Pixels (rows, WIDTH, 4) of all files in media."""
    parts, at = [], 0
    while at < len(media):
        pixels, _, length = decode_image(media, at, seen)
        parts.append(pixels)
        at += length
    return np.concatenate(parts)


def features(pixels: np.ndarray) -> str:
    """Sums and squares of each channel and of the steps between rows, as whole numbers."""
    p = pixels.reshape(-1, 4)
    sums, squares = p.sum(axis=0, dtype=np.int64), (p.astype(np.uint32) ** 2).sum(axis=0, dtype=np.int64)
    steps = np.abs(np.diff(pixels.astype(np.int16), axis=0)).sum(axis=(0, 1), dtype=np.int64)
    return f"rows={len(pixels)};sum={','.join(map(str, sums))};sq={','.join(map(str, squares))};step={','.join(map(str, steps))}"


# --- operators ---------------------------------------------------------------------------------------------------------


#: Characters of text, or bytes of media, that are coded before the results are sent on.
SLICE = 2_000_000


def _encode(batches):
    for pdf in (part for batch in batches for part in slices(batch, SLICE)):
        raw = [("" if t is None else t).encode("utf-8", "surrogatepass") for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").to_numpy(), "n_bytes": [len(r) for r in raw], "media": [store(r) for r in raw]})


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media for every row of docs(doc_id, text, ...). A null text is empty: one unit of bytes 0.

    Repeated rows are stored one by one; an empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInPandas(_encode, "doc_id long, n_bytes long, media binary")


def _decode(batches, keep_pixels: bool):
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", *(["pixels"] if keep_pixels else [])]
    for pdf in batches:
        rows, held = [], 0
        for doc_id, n_bytes, media in zip(pdf["doc_id"].astype("Int64"), pdf["n_bytes"], pdf["media"]):
            pixels = load(media)
            payload = pixels.tobytes()
            rows.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), features(pixels), *([payload] if keep_pixels else [])))
            held += len(payload)
            if held > SLICE:
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


_DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_media(media: DataFrame, keep_pixels: bool = True) -> DataFrame:
    """The digests and features of media(doc_id, n_bytes, media), decoded; with keep_pixels the A, R, G, B samples too (pixels binary).

    Equal media give equal values; repeated rows are read one by one; an empty table gives no rows; other columns are ignored.
    """

    def run(batches):
        return _decode(batches, keep_pixels)

    return media.select("doc_id", "n_bytes", "media").mapInPandas(run, _DIGESTS + (", pixels binary" if keep_pixels else ""))
