"""Vectorised text kernels over Arrow batches: word tables, rolling hashes,
shingles. Words are maximal runs of bytes outside 0x20 and 0x09-0x0D, so
UTF-8 text is never decoded. All memory is bounded by ``CHUNK_BYTES`` plus
the longest single document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
SEGMENT = 1 << 18

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)
_SHINGLE_MULT = U64(0xD1342543DE82EF95)
_BASE = 0x5851F42D4C957F2D                      # odd, so invertible mod 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    size = 1
    while size < n:
        take = min(size, n - size)
        out[size:size + take] = out[:take] * U64(pow(base, size, 1 << 64))
        size += take
    return out


_POW = _powers(_BASE, SEGMENT + 1)
_POW_INV = _powers(_BASE_INV, SEGMENT + 1)
_rng = np.random.default_rng(0x7E27)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
BYTE_CODE_LOWER = BYTE_CODE.copy()
BYTE_CODE_LOWER[0x41:0x5B] = BYTE_CODE[0x61:0x7B]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit (bijective)."""
    x = x ^ (x >> U64(32))
    x = x * _MULT
    x = x ^ (x >> U64(29))
    x = x * _SHINGLE_MULT
    return x ^ (x >> U64(32))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive documents of about ``limit`` bytes: (first, last + 1,
    bytes, offsets). A null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    col = col.fill_null(b"")
    n = len(col)
    if n == 0:
        return
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def runs(cls: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of one non-zero class that do not cross a document
    bound: (start, end, index of each document's first run)."""
    n = len(cls)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(bounds), np.int64)
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:])
    inner = bounds[(bounds > 0) & (bounds < n)]
    change[inner] = True
    at = np.flatnonzero(change)
    end = np.append(at[1:], n)
    keep = cls[at] != 0
    start, end = at[keep], end[keep]
    return start, end, np.searchsorted(start, bounds)


def run_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray = BYTE_CODE) -> np.ndarray:
    """64-bit hash of each byte run (equal bytes, equal hash). Runs are taken
    in segments of about ``SEGMENT`` bytes, so the scratch arrays stay small;
    a longer run is folded piece by piece."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        base = int(start[i])
        j = int(np.searchsorted(end, base + SEGMENT, "right"))
        if j <= i:                                 # one run longer than a segment
            h, at = U64(0), base
            while at < end[i]:
                stop = min(at + SEGMENT, int(end[i]))
                part = (codes[buf[at:stop]] * _POW[:stop - at]).sum(dtype=U64)
                h = h + part * U64(pow(_BASE, at - base, 1 << 64))
                at = stop
            out[i] = h
            i += 1
            continue
        stop = int(end[j - 1])
        acc = np.zeros(stop - base + 1, U64)
        np.cumsum(codes[buf[base:stop]] * _POW[:stop - base], dtype=U64, out=acc[1:])
        s = start[i:j] - base
        out[i:j] = (acc[end[i:j] - base] - acc[s]) * _POW_INV[s]
        i = j
    return mix(out)


def words(buf: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, ...]:
    """(start, end, hash, first word of each document) for the words of a
    chunk; ``lower`` hashes A-Z as a-z."""
    start, end, first = runs((~IS_SPACE[buf]).view(np.uint8), bounds)
    return start, end, run_hashes(buf, start, end, BYTE_CODE_LOWER if lower else BYTE_CODE), first


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries (length ``len(h) - k + 1``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= _SHINGLE_MULT
        acc += h[i:i + n]
    return mix(acc)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per document: the sorted distinct hashes of its k-word shingles. Fewer
    words than k: the whole sequence is the one shingle; no words: empty."""
    win = window_hashes(h, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(win[a:b - k + 1])
        elif b > a:
            yield window_hashes(np.append(h[a:b], U64(b - a)), b - a + 1)
        else:
            yield np.zeros(0, U64)


def per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a 0/1 array within each document's bounds."""
    acc = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=acc[1:])
    return acc[bounds[1:]] - acc[bounds[:-1]]
