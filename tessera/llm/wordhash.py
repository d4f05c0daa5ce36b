"""Vectorised word and shingle hashes for text columns in Arrow batches.

A word is a maximal run of bytes other than space and tab..carriage return
(0x20, 0x09-0x0D); A-Z are lower-cased first. Every word gets a 64-bit hash,
computed for a whole chunk of documents at once: the prefix sums of a byte
polynomial modulo 2**64 give the hash of any byte range by one subtraction,
and a final mix spreads it over all bits. Chunks hold a bounded number of
bytes (one document at least), so memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: White space, and white space with all ASCII punctuation, as word separators.
SPACES = _SPACE
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_STEP = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers: list[np.ndarray] = []


def _powers_of(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n; those for a common chunk are kept, longer
    ones (of a single long text) are not."""
    if n > CHUNK_BYTES + 1:
        return _powers_of(_BASE, n), _powers_of(_INVERSE, n)
    if not _powers:
        _powers.extend(_powers_of(base, CHUNK_BYTES + 1) for base in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Word hashes of consecutive documents: those of document i are
    ``hashes[bounds[i]:bounds[i + 1]]``; ``start``/``end`` are byte positions
    in ``data`` (the chunk's lower-cased bytes)."""

    hashes: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of documents of at most ``limit`` bytes
    (one document at least): (first row, bytes, byte offset of each row)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Words of one chunk and their hashes; ``separators`` marks the bytes between words."""
    n = len(data)
    low = _LOWER[data]
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] = inside[cuts]  # a document's first byte never continues a word
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[low] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return Words(hashes, np.searchsorted(start, offsets), start, end, low)


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word window inside a document, in order, and for each
    document the range of its windows."""
    h, n = words.hashes, len(words.hashes)
    sizes = np.diff(words.bounds)
    counts = np.maximum(sizes - k + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if n < k:
        return np.zeros(0, np.uint64), bounds
    total = h[: n - k + 1] * _STEP[0]
    for j in range(1, k):
        total += h[j : n - k + 1 + j] * _STEP[j]
    keep = np.ones(len(total), dtype=bool)
    for edge in words.bounds[1:-1]:  # windows that reach over a document's end
        keep[max(0, edge - k + 1) : edge] = False
    return mix(total[keep]), bounds


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Each document's set: its distinct k-word windows, sorted (int64); the
    whole sequence as one when it has fewer words; empty without words."""
    values, bounds = windows(words, k)
    values = values.view(np.int64)
    sets = []
    for i in range(len(words)):
        a, b = bounds[i], bounds[i + 1]
        if b > a:
            sets.append(np.unique(values[a:b]))
        else:
            own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
            short = (own * _STEP[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))
            sets.append(mix(short).view(np.int64) if len(own) else np.zeros(0, np.int64))
    return sets


def int_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """An Arrow list<int64> column from one array per row."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))
