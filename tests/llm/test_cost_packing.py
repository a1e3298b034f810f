"""Cost-balanced packing: every id once, no padding, balance."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from kilowise.llm import cost_packing, packing
from kilowise.llm.queries import tokenizer_path
from tests.llm.conftest import DOCUMENT


def check_layout(pieces, lengths, limit):
    """Each id lies in one piece, sequences are gapless, full or a power of two long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc].append((p.start, p.length))
        by_sequence[p.sequence].append((p.offset, p.length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(by_doc[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == limit or at & (at - 1) == 0 and at < limit
    return by_sequence


@pytest.mark.parametrize("limit", [8, 64, 100, 2048])
def test_sequences_are_full(limit):
    draw = random.Random(limit)
    for n in (0, 1, 2, 7, 300):
        lengths = [draw.choice([1, draw.randint(1, limit), draw.randint(1, 5 * limit), limit]) for _ in range(n)]
        pieces = cost_packing.assign(lengths, limit)
        found = check_layout(pieces, lengths, limit)
        assert len(found) <= sum(lengths) // limit + limit.bit_length()
        assert len(pieces) <= len(lengths) + len(found) + sum(x // limit for x in lengths)


def test_goes_to_the_cheapest_with_room():
    """Two sequences of 8 for 5, 4, 4, 3: the dearest two apart, the next to the cheaper one."""
    pieces = cost_packing.assign([3, 4, 5, 4], 8)
    assert [(p.doc, p.length, p.sequence) for p in pieces] == [(2, 5, 0), (1, 4, 1), (3, 4, 1), (0, 3, 0)]


def test_a_piece_without_room_is_cut():
    pieces = cost_packing.assign([6, 6, 4], 8)
    assert [(p.doc, p.start, p.length, p.sequence, p.offset) for p in pieces] == [
        (0, 0, 6, 0, 0), (1, 0, 6, 1, 0), (2, 0, 2, 0, 6), (2, 2, 2, 1, 6)]


def test_costs_are_balanced():
    """Going to the cheapest spreads the costs of sequences less than going to the dearest one with room."""
    draw = random.Random(5)
    lengths = [draw.randint(20, 700) for _ in range(3000)]

    def spread(linear, quadratic):
        costs = defaultdict(float)
        for p in cost_packing.assign(lengths, 2048, linear, quadratic):
            costs[p.sequence] += p.length + p.length**2 / 2048
        return np.std([c for c in costs.values() if c > 2048])

    assert spread(1.0, 1 / 2048) < 0.75 * spread(-1.0, -1 / 2048)


@pytest.mark.parametrize("window", [300, 1 << 22])
def test_pack_by_cost(wide, rows, none, window):
    """Any frame of documents: ids equal those of the tokenizers library, whatever the window."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    found = cost_packing.pack_by_cost(wide, tokenizer_path(), 256, window_tokens=window, with_ids=True).collect()
    want = sorted((str(r[0]), [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows)
    place = defaultdict(list)
    for r in found:
        ids = np.array(r["ids"], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"] and len(ids) == r["length"]
        place[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in place.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= 256
    # Pieces of repeated ids are told apart by the sizes of their documents.
    groups = defaultdict(list)
    for r in found:
        groups[str(r["doc_id"]), r["doc_tokens"]].append((r["start"], r["ids"]))
    for doc_id, ids in want:
        own = groups[doc_id, len(ids)]
        copies = sum(w == (doc_id, ids) for w in want)
        if copies == 1:
            assert [x for _, part in sorted(own) for x in part] == ids
        else:
            assert sum(len(part) for _, part in own) == copies * len(ids)
            assert all(ids[start : start + len(part)] == part for start, part in own)
    assert sum(r["length"] for r in found) == sum(len(ids) for _, ids in want)
    assert cost_packing.pack_by_cost(none, tokenizer_path()).count() == 0


def test_long_runs(spark):
    """Runs that tiktoken cannot take; both packings agree with the tokenizers library."""
    from tokenizers import Tokenizer

    texts = [" " * 1_200_000, "\n" * 1_200_000 + "x", "a" * 300_000, "x \n" * 2000, "word " * 2000, "　" * 5000 + "é" * 5000, "b" + " " * 5000]
    library = Tokenizer.from_file(tokenizer_path())
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(packing.token_ids(texts, tokenizer_path())) == want
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENT).repartition(2)
    for found in (cost_packing.pack_by_cost(docs, tokenizer_path()), packing.pack_documents(docs, tokenizer_path())):
        sums = {r["doc_id"]: r["n"] for r in found.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
        assert sums == {i: len(w) // 4 + 1 for i, w in enumerate(want)}
