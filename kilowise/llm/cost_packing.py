"""Cost-balanced packing: documents, dearest first, go to the cheapest sequence that has room.

The cost of a sequence is what a training step spends on it: linear in its tokens, and quadratic in
the length of each piece, as a token attends to the tokens of its own piece only. A task tokenises a
window of documents at a time and packs it before it reads on, so there is no shuffle, ids stay
where they were made, and memory is bounded by a window (and by the longest document).

The sequences of a window are laid out to hold its tokens exactly: as many full ones as fit, then one
for each power of two in the rest, which needs no padding either. Where no sequence has room
for a whole piece, the cheapest one with any room takes the head of it, and the tail queues up
again as a piece of its own. Each cut fills a sequence, so there are fewer cuts than sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import slices, text_column
from kilowise.llm.packing import token_ids

SEQUENCE_TOKENS = 2048
WINDOW_TOKENS = 1 << 22
# A layer of width d spends 24 d^2 operations on a token and 4 d on each pair of tokens of a piece.
WIDTH = 4096
LINEAR, QUADRATIC = 1.0, 1 / (6 * WIDTH)
_ID_BYTES = 4


class Piece(NamedTuple):
    doc: int
    start: int
    length: int
    sequence: int
    offset: int


def capacities(tokens: int, limit: int) -> list[int]:
    """Sequence lengths that add up to ``tokens``: full ones, then the powers of two in the rest."""
    full, rest = divmod(tokens, limit)
    return [limit] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(lengths: list[int], limit: int = SEQUENCE_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[Piece]:
    """Where each piece of each document lies. Ties go by the order of documents and of sequences.

    Full-length pieces of longer documents fill a sequence alone. ``cheapest[g]`` is the least cost of
    a sequence with g tokens of room, so one minimum over a slice finds the place of a piece.
    """
    pieces: list[Piece] = []
    queue: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        full, rest = divmod(n, limit)
        pieces.extend([Piece(doc, k * limit, limit, len(pieces) + k, 0) for k in range(full)])
        if rest:
            queue.append((-rest, doc, full * limit))
    alone = len(pieces)
    sizes = capacities(-sum(q[0] for q in queue), limit)
    with_room: list[list[tuple[float, int]]] = [[] for _ in range(limit + 1)]
    for sequence, size in enumerate(sizes):
        with_room[size].append((0.0, sequence))
    cheapest = np.array([x[0][0] if x else np.inf for x in with_room])
    heapify(queue)
    while queue:
        length, doc, start = heappop(queue)
        length = -length
        room = length + int(cheapest[length:].argmin())
        if cheapest[room] == np.inf:
            room = 1 + int(cheapest[1:].argmin())
        cost, sequence = heappop(with_room[room])
        cheapest[room] = with_room[room][0][0] if with_room[room] else np.inf
        taken = min(length, room)
        pieces.append(Piece(doc, start, taken, alone + sequence, sizes[sequence] - room))
        if taken < length:
            heappush(queue, (taken - length, doc, start + taken))
        if taken < room:
            heappush(with_room[room - taken], (cost + linear * taken + quadratic * taken * taken, sequence))
            cheapest[room - taken] = with_room[room - taken][0][0]
    return pieces


def pack_by_cost(
    docs: DataFrame,
    tokenizer: str,
    limit: int = SEQUENCE_TOKENS,
    end_id: int = 1,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    window_tokens: int = WINDOW_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost (and ids): one row per piece.

    A document is its ids and ``end_id``; null and empty texts hold ``end_id`` alone. ``cost`` is that of
    the piece. Repeated rows and rows of one id are documents of their own, a null id stays null, an
    empty table gives no row, columns besides doc_id and text are left out. A text of any length is
    packed whole. Balance holds within a window; sequence numbers are those of the task and its windows.
    """
    tail = np.array([end_id], dtype="<u4").tobytes()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
    names = [c.split(" ")[0] for c in schema.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.float64()] + [pa.list_(pa.int32())] * with_ids

    def packed(window: list[tuple[int | None, bytes]], first_sequence: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(ids) // _ID_BYTES for _, ids in window]
        rows, last = [], first_sequence - 1
        for p in assign(lengths, limit, linear, quadratic):
            doc_id, ids = window[p.doc]
            own = ids[p.start * _ID_BYTES : (p.start + p.length) * _ID_BYTES]
            sequence = first_sequence + p.sequence
            last = max(last, sequence)
            cost = linear * p.length + quadratic * p.length * p.length
            row = (doc_id, p.start, p.length, zlib.crc32(own), lengths[p.doc], sequence, p.offset, cost)
            rows.append((*row, np.frombuffer(own, "<u4").astype(np.int32)) if with_ids else row)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names), last + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        window, tokens = [], 0
        for batch in batches:
            found = (x for part in slices(batch, "text") for x in token_ids(text_column(part), tokenizer))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                window.append((doc_id, ids + tail))
                tokens += len(ids) // _ID_BYTES + 1
                if tokens >= window_tokens:
                    out, sequence = packed(window, sequence)
                    yield out
                    window, tokens = [], 0
        if window:
            yield packed(window, sequence)[0]

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, schema + ", ids array<int>" * with_ids)
