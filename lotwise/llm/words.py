"""Words and byte windows of UTF-8 text as 64-bit hashes, computed with array arithmetic on whole batches."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * M1
    x ^= x >> np.uint64(27)
    x *= M2
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=4)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base modulo 2**64 and of its inverse."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        p = np.full(count, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    size = SLICE_BYTES
    while size < count:
        size *= 2
    return _powers(size)


@functools.lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * M3)


@functools.lru_cache(maxsize=1)
def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it belongs to a word (anything but \\x20 \\x09-\\x0D), and its value after lower-casing A-Z."""
    inside = np.ones(256, dtype=bool)
    inside[[0x20, 9, 10, 11, 12, 13]] = False
    lower = np.arange(256)
    lower[65:91] += 32
    return inside, byte_values()[lower]


@functools.lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """The same for words of letters alone: a-z, A-Z and every byte of a non-ASCII character."""
    inside = np.zeros(256, dtype=bool)
    inside[65:91] = inside[97:123] = inside[128:] = True
    return inside, word_tables()[1]


@functools.lru_cache(maxsize=1)
def alnum_tables() -> tuple[np.ndarray, np.ndarray]:
    """The same for words of letters and digits."""
    inside = letter_tables()[0].copy()
    inside[48:58] = True
    return inside, word_tables()[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind each other, and the len + 1 offsets of the texts; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, tables: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and the len + 1 offsets of the texts in those arrays."""
    inside, values = tables or word_tables()
    member = inside[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = member[:-1]
    begins = np.flatnonzero(member & (~before | first[:-1]))
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[-1] = False
        after[:-1] = member[1:]
    ends = np.flatnonzero(member & (~after | first[1:])) + 1
    out = np.empty(len(begins), dtype=np.uint64)
    at = 0
    while at < len(begins):
        low = begins[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + SLICE_BYTES, side="right")))
        high = ends[stop - 1]
        up, down = powers(int(high - low) + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(values[data[low:high]] * up[:high - low], out=sums[1:])
        s, e = begins[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * down[s]
        at = stop
    lengths = (ends - begins).astype(np.uint64)
    return mix(out + lengths * M3), begins, ends, np.searchsorted(begins, offsets)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; a shorter text gives one hash of its whole sequence, no words give none."""
    n = len(words)
    if not n:
        return words
    span = min(n, width)
    out = np.full(n - span + 1, np.uint64(span), dtype=np.uint64)
    for i in range(span):
        out = mix(out * M1 + words[i:n - span + 1 + i])
    return out


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> list[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes; at least one text each."""
    out, at = [], 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        out.append((at, stop))
        at = stop
    return out
