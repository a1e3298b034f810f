"""Flat views of text batches and hashes of their words, for operators that work in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Whitespace of the word rule [^\x20\x09-\x0D]+
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 places where they begin; null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, places, data = texts.buffers()
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(places, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes; one long text is a run of its own.
    Arrays of numbers take some fifty times the bytes of a run, so this bounds the memory of a task."""
    _, starts = flat(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def word_places(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of every word, and per text the number of words before it (n + 1 values)."""
    space = _SPACE[raw]
    before = np.ones(len(raw), dtype=bool)
    before[1:] = space[:-1]
    inner = starts[:-1]
    inner = inner[inner < len(raw)]
    before[inner] = True
    after = np.ones(len(raw), dtype=bool)
    after[:-1] = before[1:] | space[1:]
    first = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return first, end, np.searchsorted(first, starts)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, kept per process."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        both = []
        for base in (_ODD, inverse):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def word_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random byte values, from one running sum."""
    up, down = _powers(len(raw) + 1)
    values = _BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


def text_column(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return batch.column(column).fill_null("").to_pylist()
