"""Vectorised text work on the flat bytes of an Arrow column: slices, words, word hashes, shingles.

All texts of a slice lie in one byte array; a text's values never depend on its neighbours in the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_500_000

# White space of words, 20 and 09-0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 offsets; null counts as empty."""
    column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text_at: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of the batches in slices of about ``most`` text bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = flat(batch.column(text_at))[1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word (a run of bytes other than white space)."""
    inside = ~SPACE[data]
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)  # the first byte of a text, or the end
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, from one running sum over the bytes."""
    n = len(data) + 1
    if not _powers or len(_powers[0]) < n:
        size = max(n, min(SLICE_BYTES + 1, n + n // 4))  # slices vary a little
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, dtype=np.uint64))) for b in (_BASE, _INVERSE)]
    running = np.zeros(n, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _powers[0][: n - 1], out=running[1:])
    value = (running[end] - running[start]) * _powers[1][start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of every text, and n + 1 offsets.

    A text of fewer than k words (but at least one) has its whole sequence as its only shingle.
    """
    count = np.bincount(text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(count)])

    def joined(at: np.ndarray, length: int) -> np.ndarray:
        value = np.full(len(at), length, dtype=np.uint64)
        for j in range(length):
            value = mix(value * np.uint64(0x9FB21C651E98DF25) + hashes[at + j])
        return value

    per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    out = np.empty(bounds[-1], dtype=np.uint64)
    long = np.flatnonzero(count >= k)
    if len(long):
        within = np.arange(per[long].sum()) - np.repeat(np.cumsum(per[long]) - per[long], per[long])
        out[np.repeat(bounds[long], per[long]) + within] = joined(np.repeat(first[long], per[long]) + within, k)
    for length in range(1, k):
        short = np.flatnonzero(count == length)
        if len(short):
            out[bounds[short]] = joined(first[short], length)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][per > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[bounds]
