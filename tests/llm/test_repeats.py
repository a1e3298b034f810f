"""Repeated byte strings and word passages against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from kilowise.llm import repeats, substrings, suffix_array
from tests.llm.conftest import counted


def _kept(units, window):
    counts = Counter(tuple(u[i : i + window]) for u in units for i in range(len(u) - window + 1))
    masks = []
    for u in units:
        hit = np.zeros(len(u), dtype=bool)
        for i in range(len(u) - window + 1):
            if counts[tuple(u[i : i + window])] > 1:
                hit[i : i + window] = True
        masks.append(hit)
    return masks


def _bytes_by_hand(rows, window):
    texts = [(r[1] or "").encode() for r in rows]
    out = []
    for r, t, hit in zip(rows, texts, _kept(texts, window)):
        kept = bytes(b for b, h in zip(t, hit) if not h)
        spans = int((np.diff(np.concatenate(([0], hit.astype(int)))) == 1).sum())
        out.append((r[0], len(t), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def _words_by_hand(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    out = []
    for r, t, hit in zip(rows, texts, _kept(texts, window)):
        kept = " ".join(w for w, h in zip(t, hit) if not h)
        out.append((r[0], len(t), int(hit.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
PASSAGES = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_byte_strings(wide, rows):
    want = _bytes_by_hand(rows, 200)
    assert counted(suffix_array.remove_repeats(wide), *BYTES) == want


def test_word_passages(wide, rows):
    want = _words_by_hand(rows, 35)
    assert counted(substrings.remove_passages(wide), *PASSAGES) == want


def test_anchors_with_many_contents(docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_CONTENTS", 3)
    assert counted(substrings.remove_passages(docs), *PASSAGES) == _words_by_hand(rows, 35)


def test_small_blocks_and_filters(docs, rows, monkeypatch):
    """A filter that lets nearly all through, and a block per anchor, change nothing."""
    monkeypatch.setattr(repeats, "BITMAP_BITS", 1 << 16)
    monkeypatch.setattr(repeats, "BLOCK_UNITS", 1)
    monkeypatch.setattr(repeats, "BLOCK_WORDS", 1)
    monkeypatch.setattr(repeats, "broadcast_if_small", lambda df: df)
    assert counted(suffix_array.remove_repeats(docs, 40, 16), *BYTES) == _bytes_by_hand(rows, 40)


def test_empty_tables(none):
    assert suffix_array.remove_repeats(none).count() == 0
    assert substrings.remove_passages(none).count() == 0


def test_suffix_order():
    draw = np.random.default_rng(1)
    for _ in range(60):
        text = np.append(draw.integers(97, 97 + draw.integers(1, 4), draw.integers(1, 150)), 255).astype(np.uint8)
        data = text.tobytes()
        found = suffix_array.suffix_array(text, 200, len(text) - 1 - np.arange(len(text)))
        assert found.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("find, kind", [(suffix_array.repeated_windows, np.uint8), (substrings.repeated_windows, np.uint64)])
def test_windows_of_a_block(find, kind):
    draw = np.random.default_rng(2)
    for _ in range(80):
        window = int(draw.choice([4, 8, 11]))
        texts = [draw.integers(97, 97 + draw.integers(1, 4), draw.integers(window, 50)).astype(kind) for _ in range(draw.integers(1, 5))]
        texts.append(np.concatenate((texts[0], texts[-1])))
        times = draw.choice([1, 1, 2], len(texts))
        counts = Counter()
        for t, n in zip(texts, times):
            for i in range(len(t) - window + 1):
                counts[t[i : i + window].tobytes()] += n
        want = [[counts[t[i : i + window].tobytes()] > 1 for i in range(len(t) - window + 1)] for t in texts]
        assert [m.tolist() for m in find(texts, times, window)] == want
