"""Vectorised helpers that Python tasks use on one text at a time.

Hashes are polynomial over bytes (or over word hashes), so that the hash of any
run of words comes from two prefix sums; they depend on the content only, never
on where in a text it stands.  Long texts are worked in pieces, so that memory
per text stays a small multiple of its own size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
PRIME = 0x9E3779B97F4A7C15
PIECE = 1 << 18
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept per worker, at most PIECE long in practice."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.empty(size, U)
        have[0] = 1
        k = 1
        while k < size:
            have[k : 2 * k] = have[:k] * U(pow(base, k, 1 << 64))
            k *= 2
        _tables[base] = have
    return have[:n]


INVERSE = pow(PRIME, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _span_hashes(a: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    c = np.zeros(len(a) + 1, U)
    np.cumsum((a.astype(U) + U(1)) * _powers(PRIME, len(a)), out=c[1:])
    return mix((c[e] - c[s]) * _powers(INVERSE, len(a) + 1)[s] + (e - s).astype(U))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def is_space(a: np.ndarray) -> np.ndarray:
    return (a == 32) | ((a >= 9) & (a <= 13))


def pieces(a: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts bytes at white space into ranges of about PIECE; a longer one is a single word."""
    start, n = 0, len(a)
    while start < n:
        end = min(start + PIECE, n)
        if end < n:
            gap = np.flatnonzero(is_space(a[start:end]))
            if len(gap):
                end = start + int(gap[-1]) + 1
            else:
                while end < n:
                    gap = np.flatnonzero(is_space(a[end : end + PIECE]))
                    if len(gap):
                        end += int(gap[0])
                        break
                    end = min(end + PIECE, n)
        yield start, end
        start = end


def word_hashes(raw: bytes) -> np.ndarray:
    """The hash of each word (a run of bytes other than ASCII white space)."""
    a, out = np.frombuffer(raw, np.uint8), []
    for start, end in pieces(a):
        part = a[start:end]
        s, e = spans(~is_space(part))
        if len(part) > 2 * PIECE:
            out.append(np.array([xxhash.xxh64_intdigest(part[i:j].tobytes(), 7) for i, j in zip(s, e, strict=True)], U))
        elif len(s):
            out.append(_span_hashes(part, s, e))
    return np.concatenate(out) if out else np.zeros(0, U)


def gram_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k consecutive words."""
    total, out = len(w) - k + 1, []
    for start in range(0, max(0, total), PIECE):
        part = w[start : min(start + PIECE, total) + k - 1]
        n = len(part) - k + 1
        c = np.zeros(len(part) + 1, U)
        np.cumsum(part * _powers(PRIME, len(part)), out=c[1:])
        out.append(mix((c[k:] - c[:-k]) * _powers(INVERSE, n)))
    return np.concatenate(out) if out else np.zeros(0, U)


def minimizers(g: np.ndarray, w: int) -> np.ndarray:
    """For each window of w consecutive values, the place of its leftmost least value."""
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, width = g, np.arange(len(g)), 1
    while width < w:
        step = min(width, w - width)
        m = len(best) - step
        left = best[:m] <= best[step:]
        best, at = np.where(left, best[:m], best[step:]), np.where(left, at[:m], at[step:])
        width += step
    return at


def encoded(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; a null text is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield bytes(view[ends[i] : ends[i + 1]]) if valid[i] else b""


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cuts incoming batches, so that what is made from one at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
