"""Vectorised text helpers that run inside Arrow batches.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; as those six
characters are ASCII, the UTF-8 bytes give the same words as the code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in chunks of at most so many UTF-8 bytes (one longer
#: text makes a chunk of its own), so that a task's memory does not follow
#: the number of rows in an Arrow batch.
CHUNK_BYTES = 500_000

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x1E3779B97F4A7C15  # below the prime that hash_slices counts with
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each row; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def text_ranges(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """The row ranges of ``chunks``; no text is taken out of the Arrow batch."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).tolist()
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """The row ranges of ``chunks`` with their texts; only one range's texts are held outside the Arrow batch."""
    for start, end in text_ranges(column, limit):
        yield start, end, utf8(column.slice(start, end - start))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by a newline; where each begins (and the end)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return buf, np.concatenate([[0], np.cumsum(lens + 1)])


def word_spans(buf: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (and the end)."""
    inside = np.concatenate([[False], ~_WS[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, begins)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(mult)
    return x ^ (x >> np.uint64(31))


def _lanes(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slices' bytes as little-endian 64-bit values (the last one of a slice filled up with
    zeros), how many each slice has, and where each slice's begin."""
    count = (lens + 7) >> 3
    first = np.cumsum(count) - count
    at = np.repeat(starts - 8 * first, count) + 8 * np.arange(int(count.sum()))
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(buf) + 1,), "<u8", padded.data, strides=(1,))[at]
    full = np.flatnonzero((lens & 7) > 0)
    last = first[full] + count[full] - 1
    lanes[last] &= (np.uint64(1) << (8 * (lens[full] & 7)).astype(np.uint64)) - np.uint64(1)
    return lanes, count, first


def _hash_lanes(lanes: np.ndarray, count: np.ndarray, first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Each value is scrambled together with its place in the slice before the sum is taken."""
    place = mix((np.arange(len(lanes)) - np.repeat(first, count)).astype(np.uint64) + np.uint64(1))
    total = np.zeros(len(lanes) + 1, np.uint64)
    np.cumsum(mix(lanes + place) * (place | np.uint64(1)), out=total[1:])
    return mix(total[first + count] - total[first] ^ lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte slices ``buf[start:end]``; slices of one
    length up to 8 have equal hashes only if they are equal."""
    lens = ends - starts
    return _hash_lanes(*_lanes(buf, starts, lens), lens)


def distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the byte slices, the indices of one of each kind, and the kind of
    each slice.  Kinds are told by hash, then compared byte by byte."""
    lens = ends - starts
    lanes, count, first = _lanes(buf, starts, lens)
    _, at, kind = np.unique(_hash_lanes(lanes, count, first, lens), return_index=True, return_inverse=True)
    stands = at[kind]
    if (lens == lens[stands]).all() and (lanes == lanes[ragged(first[stands], count)]).all():
        return at, kind
    raw, seen = buf.tobytes(), {}
    kind = np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
    return np.unique(kind, return_index=True)[1], kind


# ---- slices of 64-bit values: sums of value x power modulo a prime ---------
_PRIME = np.uint64((1 << 61) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime 2**61 - 1 of values below it."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    mid = a1 * b0 + a0 * b1
    return _reduced(np.uint64(2) * a1 * b1 + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of each at least."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_BASE, pow(_BASE, -1, int(_PRIME))):
            p = np.ones(size, np.uint64)
            k = 1
            while k < size:
                p[k:2 * k] = _times(p[:k], np.full(k, pow(base, k, int(_PRIME)), np.uint64))
                k *= 2
            out.append(p)
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def hash_slices(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` of scrambled 64-bit values; equal
    slices have equal hashes wherever they stand, and slices may overlap."""
    power, inverse = _powers(len(values) + 1)
    v = _times(_reduced(values.astype(np.uint64)), power[:len(values)])
    high, low = np.zeros(len(v) + 1, np.uint64), np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v >> np.uint64(32), out=high[1:])
    np.cumsum(v & np.uint64(0xFFFFFFFF), out=low[1:])
    up, down = high[ends] - high[starts], low[ends] - low[starts]
    total = _reduced((up >> np.uint64(29)) + ((up & np.uint64((1 << 29) - 1)) << np.uint64(32)) + down)
    return mix(_times(total, inverse[starts]) ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(buf: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the index of each text's first word (and the end)."""
    starts, ends, first = word_spans(buf, begins)
    return hash_bytes(buf, starts, ends), first


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all ``size``-word windows that lie in one text, and their hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[size - 1:])
    return at, hash_slices(hashes, at, at + size)


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all slices ``begins[i] : begins[i] + lengths[i]``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))
