"""Periodic runs against a search of all periods, for any cut of the text."""

from __future__ import annotations

import random

import numpy as np
import pytest

from kilowise.llm import squares
from kilowise.llm.squares import Run
from tests.llm.conftest import DOCUMENT


def brute_runs(words, min_repeats=4, min_length=6):
    """Stretches of equal words at each distance; the least distance names the run."""
    n, least = len(words), {}
    for q in range(1, n // min_repeats + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(min_length, min_repeats * q):
                least.setdefault((at, end + q), q)
            at = end + 1
    return sorted((Run(s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r.start, r.period))


def texts():
    draw = random.Random(7)
    out = [[], [1], [1] * 5, [1] * 6, [1] * 300, [1, 2] * 4, [1, 2] * 100, list(range(40)) * 4, list(range(40)) * 4 + [0]]
    for trial in range(120):
        letters = draw.choice([1, 2, 2, 3, 5, 50])
        words: list[int] = []
        while len(words) < draw.choice([20, 80, 300]):
            own = [draw.randrange(letters) for _ in range(draw.randint(1, draw.choice([2, 6, 30])))]
            words += (own * draw.randint(1, 7))[: draw.randint(1, 200)]
        out.append(words)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = [bin(i).count("1") % 2 for i in range(512)]
    return [*out, fibonacci[-1], morse, morse * 5, ([1] * 7 + [2]) * 6, ([1, 1, 2] * 9 + [3]) * 5]


@pytest.mark.parametrize("repeats,length", [(4, 6), (2, 2), (3, 5)])
def test_runs_are_those_of_all_periods(repeats, length):
    for words in texts():
        own = [str(w).encode() for w in words]
        assert squares.runs_of(own, repeats, length) == brute_runs(words, repeats, length), words


def test_any_cut_of_the_text():
    """Word by word, and in stretches of any length."""
    draw = random.Random(8)
    for words in texts()[::3]:
        want = brute_runs(words)
        for size in (1, draw.randint(2, 9), 50):
            catcher = squares.SquareCatcher()
            for at in range(0, len(words), size):
                catcher.append(np.array(words[at : at + size], np.int64))
            assert catcher.runs() == want, (size, words)


def test_caught_with_the_word_that_completes_it():
    catcher = squares.SquareCatcher(2, 2)
    caught = [catcher.append(np.array([w])) for w in (5, 7, 8, 7, 8, 7, 9)]
    assert caught == [[], [], [], [], [Run(1, 4, 2)], [], []]
    assert catcher.runs() == [Run(1, 5, 2)]


def test_long_texts_stay_small():
    """Each scale keeps its last blocks, whatever the length of the text."""
    catcher = squares.SquareCatcher()
    draw = np.random.default_rng(3)
    words = draw.integers(0, 1000, 300_000)
    words[100_000:140_000] = np.resize(words[100_000:109_000], 40_000)
    words[200_000:200_900] = 4
    for at in range(0, len(words), 5000):
        catcher.append(words[at : at + 5000])
    assert Run(100_000, 40_000, 9000) in catcher.runs() and Run(200_000, 900, 1) in catcher.runs()
    assert sum(len(s.hashes) for s in catcher._scales) < 8 * len(words)
    assert len(catcher._scales[0].hashes) < 20_000


def test_find_runs(spark, wide, rows, none):
    found = squares.find_runs(wide).collect()
    assert len(found) == len(rows)
    want = []
    for r in rows:
        words = (r[1] or "").encode().split()
        runs = brute_runs(words)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        want.append((str(r[0]), len(words), tuple(runs), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    got = [(str(r["doc_id"]), r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in found]
    assert sorted(got) == sorted(want)
    assert squares.find_runs(none).count() == 0


def test_very_long_texts(spark):
    """A megabyte of one word, of one period, and of one letter."""
    period = " ".join(f"w{i}" for i in range(5000))
    texts = ["word " * 200_000, f"{period} " * 40, "a" * 1_000_000, f"x {period} " + "y " * 6]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCUMENT)
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in squares.find_runs(docs).collect()}
    assert found == {0: [(0, 200_000, 1)], 1: [(0, 200_000, 5000)], 2: [], 3: [(5001, 6, 1)]}
