"""Word hashing over whole texts, vectorised with numpy inside Spark tasks.

A word is a maximal run of bytes other than space and \\x09-\\x0D, as in `[^\\x20\\x09-\\x0D]+`.
Words become 64-bit hashes; equal words get equal hashes in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240501))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_BYTE = _rng.integers(1, 2**63, 256, dtype=U)
_BYTE[SPACE] = 0
_BASE, _INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_MIX = _rng.integers(1, 2**63, 64, dtype=U) | U(1)
_pows: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _pows.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 22:
            _pows[base] = have
    return have[:n]


def finish(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as an array, and where each word starts and ends."""
    a = np.frombuffer(raw, np.uint8)
    gap = np.empty(len(a) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = SPACE[a]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return a, edge[::2], edge[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    a, start, _ = word_spans(raw)
    if not len(start):
        return np.empty(0, U)
    sums = np.add.reduceat(_BYTE[a] * powers(_BASE, len(a)), start)
    return finish(sums * powers(_INV, len(a))[start])


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n successive words; shorter inputs give one hash of all their words."""
    k = min(n, len(h))
    if not k:
        return np.empty(0, U)
    out = np.full(len(h) - k + 1, k * 0xD6E8FEB86659FD93 % 2**64, U)
    for i in range(k):
        out += h[i : len(h) - k + 1 + i] * _MIX[i]
    return finish(out)


def shingle_set(raw: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles of A-Z lower-cased bytes."""
    return np.unique(windows(word_hashes(raw.lower()), n))


def raw_texts(column: pa.Array | pa.ChunkedArray):
    """Each text's UTF-8 bytes, or None; the Arrow buffers are read in place."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        wide = pa.types.is_large_string(chunk.type) or pa.types.is_large_binary(chunk.type)
        kept = np.asarray(chunk.is_valid())
        _, offsets, data = chunk.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, int)
        view = memoryview(data) if data is not None else memoryview(b"")
        for i in range(len(chunk)):
            yield bytes(view[at[i] : at[i + 1]]) if kept[i] else None
