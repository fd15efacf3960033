"""Whole columns of text as byte arrays: words, hashes and n-grams without a loop over rows.

Works inside Arrow tasks. Null texts count as empty. Memory follows ``SLICE_BYTES`` or the
longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

# ASCII white space, x20 and x09 to x0D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SEED = np.random.default_rng(20240607)
_BYTE_KEYS = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them."""
    col = column.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SLICE_BYTES`` of text, one row at least."""
    _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit keys."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the index of its first word (one more at the end)."""
    inside = np.zeros(len(buf) + 2, dtype=bool)
    inside[1:-1] = IS_WORD[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def stretch_hashes(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the stretches that ``bounds`` cut the bytes into, none of them empty."""
    if len(bounds) < 2:
        return np.zeros(0, np.uint64)
    sizes = np.diff(bounds)
    at = np.arange(len(buf), dtype=np.int32)
    at -= np.repeat(bounds[:-1].astype(np.int32), sizes)
    values = _BYTE_KEYS[buf]
    values *= powers(int(sizes.max()))[at]
    return mix(np.add.reduceat(values, bounds[:-1]) + sizes.astype(np.uint64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; the words are all of ``buf`` but its white space."""
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    return stretch_hashes(buf[IS_WORD[buf]], bounds)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows within one text, and the word index each starts at."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.zeros(n, np.uint64)
    for k in range(size):
        keys *= _STEP
        keys += hashes[k : k + n]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(keys[at]), at


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, empty ones included."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def char_grams(
    buf: np.ndarray, offsets: np.ndarray, size: int, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (a power of two) of all ``size``-byte n-grams within one text, and each text's bounds in them."""
    n = max(len(buf) - size + 1, 0)
    keys = np.full(n, size, np.uint64)
    for k in range(size):
        keys = keys * np.uint64(0x100000001B3) + buf[k : k + n]
    keys = (mix(keys) >> np.uint64(65 - buckets.bit_length())).astype(np.int32)
    if size == 1:
        return keys, offsets
    cut = np.zeros(len(buf) + 1, np.int32)
    np.add.at(cut, offsets[1:-1], 1)
    text = np.cumsum(cut)
    inside = np.flatnonzero(text[:n] == text[size - 1 : size - 1 + n])
    return keys[inside], np.searchsorted(inside, offsets)
