"""Vectorised byte and word arithmetic on Arrow string columns (used inside Spark tasks).

A batch of texts is one ``uint8`` buffer with document offsets.  UTF-8 keeps
every byte of a non-ASCII character at 0x80 or above, so the word classes
used here can be read from single bytes.
"""
from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

U64 = np.uint64
#: Bytes of text held at once by the vectorised loops; longer documents are taken alone.
BLOCK_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_INV = pow(_ODD, -1, 1 << 64)


def _class(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = False
    return out


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: ``[^\x20\x09-\x0D]+``.
NONSPACE = _class([(0x20, 0x20), (0x09, 0x0D)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_ODD))
_BYTE_LOWER = _BYTE[LOWER]
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least n of each."""
    if "p" not in _powers or len(_powers["p"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("p", _ODD), ("i", _INV)):
            full = np.full(size, base, dtype=U64)
            full[0] = 1
            _powers[key] = np.cumprod(full, dtype=U64)
    return _powers["p"], _powers["i"]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """cum[i] = sum of values[j] * P**j for j < i (modulo 2**64)."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * p[:len(values)], dtype=U64, out=out[1:])
    return out


def span_hashes(cum: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of each span of the values behind ``cum``."""
    _, inv = powers(len(cum))
    return mix((cum[ends] - cum[starts]) * inv[starts])


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values (len(values) - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    cum = prefix_sums(values)
    _, inv = powers(len(cum))
    return mix((cum[k:] - cum[:n]) * inv[:n])


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: nothing to trim
    _libc = None


def release() -> None:
    """Gives freed memory back to the system; a Python worker outlives its task and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32, count=n + column.offset + 1)[column.offset:].astype(np.int64) \
        if offs is not None and offs.size else np.zeros(n + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Document ranges [lo, hi) of at most ``limit`` bytes each, one document at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets per document); words never cross documents."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    inside = is_word[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Longest word named by the polynomial sum.  Modulo 2**64 the sum loses its low bits on patterned texts
#: (a Thue-Morse word of 1,024 letters and its complement agree for every multiplier); at 32 bytes 45 bits are left.
SUMMED = 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each span's bytes: the polynomial sum for short ones, XXH3 of the bytes for longer ones."""
    out = span_hashes(prefix_sums((_BYTE_LOWER if lower else _BYTE)[data]), starts, ends)
    wide = np.flatnonzero(ends - starts > SUMMED)
    if len(wide):
        raw = (LOWER[data] if lower else data).tobytes()
        out[wide] = [xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[wide].tolist(), ends[wide].tolist())]
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def inside_windows(offsets: np.ndarray, k: int) -> np.ndarray:
    """Start positions of the k-windows that stay inside one document."""
    n = int(offsets[-1])
    ok = np.zeros(n + 1, dtype=np.int32)
    lengths = np.diff(offsets)
    full = lengths >= k
    np.add.at(ok, offsets[:-1][full], 1)
    np.add.at(ok, offsets[1:][full] - k + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def sliding_min_position(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the minimum of each window of w values, rightmost on ties."""
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = values.copy()
    pos = np.arange(len(values), dtype=np.int64)
    have = 1
    while have < w:
        step = min(have, w - have)
        m = len(best) - step
        right = best[step:] <= best[:m]
        pos = np.where(right, pos[step:], pos[:m])
        best = np.where(right, best[step:], best[:m])
        have += step
    return pos[:n]
