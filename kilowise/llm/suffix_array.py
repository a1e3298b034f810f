"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

The corpus is routed by the anchors of its windows (``repeats``), so each task holds the places where
equal windows can lie. There a suffix array is built: suffixes smaller than their successors are
sorted directly, all others are induced from them by a scan over the buckets, and the common
prefixes of neighbours show the windows that occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilowise.llm import repeats
from kilowise.llm.common import flat

WINDOW = 200
GRAM = 64
_END = 0xFF  # after each text; no UTF-8 text has this byte
_WORD = 8


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (0xFF beyond the end)."""
    padded = np.concatenate((text, np.full(_WORD, _END, np.uint8))).astype(np.uint64)
    one = padded
    two = one[:-1] << np.uint64(8) | one[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    eight = four[:-4] << np.uint64(32) | four[4:]
    return eight[: len(text)]


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; equal bytes look on to the end of their run."""
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    rises = np.zeros(len(ends), dtype=bool)
    rises[:-1] = text[ends[:-1]] < text[ends[:-1] + 1]
    return np.repeat(rises, np.diff(np.concatenate(([-1], ends))))


def _sorted_directly(places: np.ndarray, eights: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes: eight bytes a round, only those still tied go on."""
    order = places[np.argsort(eights[places], kind="stable")]
    keys = eights[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(order) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    for at in range(_WORD, depth, _WORD):
        tied = np.zeros(len(order), dtype=bool)
        tied[1:] |= ~new[1:]
        tied[:-1] |= ~new[1:]
        tied &= room[order] > at
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        own = order[slots]
        keys = eights[np.minimum(own + at, len(eights) - 1)]
        by = np.lexsort((keys, group[slots]))
        order[slots] = own[by]
        keys, owner = keys[by], group[slots]
        split = np.zeros(len(slots), dtype=bool)
        split[1:] = (keys[1:] != keys[:-1]) & (owner[1:] == owner[:-1])
        new[slots[split]] = True
        group = np.cumsum(new) - 1
    return order


def suffix_array(text: np.ndarray, depth: int, room: np.ndarray) -> np.ndarray:
    """Places of ``text`` in the order of the first ``depth`` bytes of their suffixes.

    ``room``: bytes to the end of the own text, whose terminator no comparison needs to pass.
    """
    n = len(text)
    counts = np.bincount(text, minlength=256)
    starts = np.concatenate(([0], np.cumsum(counts)))
    small = _smaller_than_successor(text)
    direct = _sorted_directly(np.flatnonzero(small), _eights(text), room, depth)
    array = np.full(n, -1, dtype=np.int64)
    # In a bucket of one first byte the induced suffixes stand before those sorted directly.
    split = np.searchsorted(text[direct], np.arange(257))
    for c in range(256):
        own = direct[split[c] : split[c + 1]]
        array[starts[c + 1] - len(own) : starts[c + 1]] = own
    heads = starts[:-1].copy()

    def place(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        kinds, begin, many = np.unique(first, return_index=True, return_counts=True)
        for c, a, m in zip(kinds.tolist(), begin.tolist(), many.tolist()):
            array[heads[c] : heads[c] + m] = before[a : a + m]
            heads[c] += m

    # The last suffix comes before all others with its first byte, as if an end smaller than any byte followed.
    array[heads[text[-1]]] = n - 1
    heads[text[-1]] += 1
    for c in range(256):
        at = starts[c]
        while at < starts[c + 1]:
            # What stands in the bucket so far; runs of the same byte induce within it, a step at a time.
            to = heads[c] if at < heads[c] else starts[c + 1]
            place(array[at:to])
            at = to
    return array


def common_prefixes(array: np.ndarray, eights: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the next in the array, up to ``depth`` and within the own text."""
    left, right = array[:-1], array[1:]
    most = np.minimum(np.minimum(room[left], room[right]), depth)
    shared = np.zeros(len(left), dtype=np.int64)
    going = np.arange(len(left))
    for at in range(0, depth, _WORD):
        differ = eights[left[going] + at] ^ eights[right[going] + at]
        ended = differ != 0
        # The leading zero bytes of the difference are the bytes in which the two agree.
        top = np.zeros(len(going), dtype=np.int64)
        for shift in range(8, 65, 8):
            top += (differ >> np.uint64(64 - shift)) == 0
        shared[going] = at + top
        going = going[~ended]
        going = going[most[going] > at + _WORD]
        if not len(going):
            break
    return np.minimum(shared, most)


def repeated_windows(texts: list[np.ndarray], times: np.ndarray, window: int) -> list[np.ndarray]:
    """For each text a mask of its windows that occur twice or more in all texts, text i counting times[i]."""
    end = np.array([_END], np.uint8)
    text = np.concatenate([x for own in texts for x in (own, end)])
    lengths = np.array([len(x) for x in texts])
    stops = np.cumsum(lengths + 1)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    room = stops[owner] - 1 - np.arange(len(text))
    array = suffix_array(text, window, room)
    array = array[room[array] >= window]
    if not len(array):
        return [np.zeros(max(0, n - window + 1), bool) for n in lengths.tolist()]
    same = np.append(common_prefixes(array, _eights(text), room, window) >= window, False)
    hit = np.zeros(len(text), dtype=bool)
    hit[array] = same | np.concatenate(([False], same[:-1])) | (times[owner[array]] > 1)
    return [hit[stop - 1 - n : stop - window] for stop, n in zip(stops.tolist(), lengths.tolist())]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: every byte covered by a string of ``window``
    bytes that also starts anywhere else goes, judged on the input.

    Matches never cross documents; a repeated row is another place. Null is the empty text; texts
    shorter than the window stay whole; what is kept need not be valid UTF-8. Rows with equal id and text
    get equal results. An empty table gives an empty one; other columns are left out.
    """
    own = repeats.marked(docs)
    runs = repeats.removed_runs(own, repeats.Rule(window, gram, words=False), repeated_windows)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = flat(batch.column("text"))
            data = raw.tobytes()
            rows = []
            for a, b, found in zip(starts[:-1].tolist(), starts[1:].tolist(), batch.column("runs").to_pylist()):
                kept, at = [], a
                for run in found or ():
                    kept.append(data[at : a + run["first"]])
                    at = a + run["end"]
                text = b"".join([*kept, data[at:b]])
                rows.append((b - a, b - a - len(text), len(found or ()), hashlib.sha256(text).hexdigest(), text))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    return repeats.with_runs(own, runs).mapInArrow(cut, schema)
