"""Periodic runs of words, found while the text is read: online dyadic square catching.

The text is cut at every scale into blocks of 1, 2, 4 ... words. A block that is complete becomes a
catcher: it waits for itself to come again 2b - 1 to 4b - 2 words after it began, b being its size.
These spans cover every period once, and the first half of any square of such a period holds a whole
block. So a word that comes in is compared, at each scale, with just two catchers: does the suffix it
ends equal the suffix that ended with the block? A catch names a period; it is extended word by word
to both sides and becomes a run, which goes on growing at the text's end while words keep the
period. Squares inside a run that is known merge into it, also those of multiples of its period.

Words come in as numbers, any number of them at a time; what is found does not depend on how the
text is cut. Suffixes are compared by hashes of their last b words, built from those of b / 2
words, and every catch is held against the words themselves. Each scale keeps its last few blocks only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import slices

MIN_REPEATS, MIN_LENGTH = 4, 6
APPEND_WORDS = 1 << 16
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(29)


class Run(NamedTuple):
    start: int
    length: int
    period: int


class _Scale:
    """Hashes of all windows of ``size`` words from place ``base`` on, and how many catches in a row are due."""

    def __init__(self, size: int, min_repeats: int) -> None:
        self.size = size
        self.base = 0
        self.hashes = np.zeros(0, np.uint64)
        # Words that lie min_repeats - 1 periods deep hold at least so many whole blocks on end.
        self.in_a_row = max(1, ((min_repeats - 1) * (2 * size - 1) - size + 1) // size)

    @property
    def end(self) -> int:
        return self.base + len(self.hashes)

    def trim(self) -> None:
        spare = len(self.hashes) - (self.in_a_row + 6) * self.size
        if spare > len(self.hashes) // 2:
            self.base += spare
            self.hashes = self.hashes[spare:].copy()


class SquareCatcher:
    """Runs of one text with at least ``min_repeats`` whole periods and ``min_length`` words."""

    def __init__(self, min_repeats: int = MIN_REPEATS, min_length: int = MIN_LENGTH) -> None:
        if min_repeats < 2:
            raise ValueError("a run repeats its period at least twice")
        self.min_repeats, self.min_length = min_repeats, min_length
        self._text = np.zeros(1024, np.int64)
        self.n = 0
        self._scales: list[_Scale] = []
        # start, end, period, reported; a stretch that ends with the text may grow.
        self._known: list[list[int]] = []

    def append(self, words: np.ndarray) -> list[Run]:
        """Take in more words; gives the runs that these words made long enough, as far as they reach by now."""
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self._text):
            grown = np.zeros(max(self.n, 2 * len(self._text)), np.int64)
            grown[:old] = self._text[:old]
            self._text = grown
        self._text[old : self.n] = words
        self._grow(old)
        level = 0
        while self.min_repeats * (2 * (1 << level) - 1) <= self.n:
            if level == len(self._scales):
                self._scales.append(_Scale(1 << level, self.min_repeats))
            begins, periods = self._catches(level)
            if len(begins):
                self._extend(1 << level, begins, periods)
            level += 1
        for scale in self._scales[:-1]:  # the last one is yet to seed the next
            scale.trim()
        new = [k for k in self._known if not k[3] and self._whole(*k[:3])]
        for known in new:
            known[3] = True
        return [Run(start, end - start, period) for start, end, period, _ in new]

    def runs(self) -> list[Run]:
        """Runs of the text so far, by start, then period; each with its least period."""
        least: dict[tuple[int, int], int] = {}
        for start, end, period, _ in self._known:
            if self._whole(start, end, period):
                least[start, end] = min(period, least.get((start, end), period))
        return sorted((Run(s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r.start, r.period))

    def _whole(self, start: int, end: int, period: int) -> bool:
        return end - start >= max(self.min_length, self.min_repeats * period)

    def _grow(self, old: int) -> None:
        """Stretches that reached the old end go on as far as the new words keep their period."""
        for known in self._known:
            if known[1] == old:
                known[1] += self._agree(old - known[2], old)
        self._known = [k for k in self._known if k[1] == self.n or self._whole(*k[:3])]

    def _agree(self, x: int, y: int) -> int:
        """How many words from ``x`` on equal those from ``y`` on (x < y)."""
        t, n, at, size = self._text, self.n, 0, 32
        while y + at < n:
            m = min(size, n - y - at)
            differ = t[x + at : x + at + m] != t[y + at : y + at + m]
            first = int(differ.argmax())
            if differ[first]:
                return at + first
            at, size = at + m, 2 * size
        return at

    def _agree_before(self, x: int, y: int) -> int:
        """How many words before ``x`` equal those before ``y`` (x < y)."""
        t, at, size = self._text, 0, 32
        while at < x:
            m = min(size, x - at)
            differ = (t[x - at - m : x - at] != t[y - at - m : y - at])[::-1]
            first = int(differ.argmax())
            if differ[first]:
                return at + first
            at, size = at + m, 2 * size
        return at

    def _catches(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins of catchers, and periods, for which the new words end ``in_a_row`` equal blocks on end."""
        scale = self._scales[level]
        b, first_new = scale.size, scale.end
        if level == 0:
            new = self._text[first_new : self.n].astype(np.uint64)
        else:
            below, half = self._scales[level - 1], b // 2
            own = below.hashes[first_new - below.base :]
            new = own[: len(own) - half] * _MIX_A + own[half:]
            new ^= new >> _SHIFT
            new *= _MIX_B
        scale.hashes = np.concatenate([scale.hashes, new]) if len(scale.hashes) else new
        h, base = scale.hashes, scale.base
        ends = np.arange(max(first_new, 2 * b - 1), scale.end)
        catcher = (ends - (2 * b - 1)) & -b
        begins, periods = [], []
        for older in (0, b):
            at, by = ends, catcher - older
            need = (scale.in_a_row - 1) * b
            skip = int(np.searchsorted(by, need))
            at, by = at[skip:], by[skip:]
            for back in range(scale.in_a_row):
                hit = np.flatnonzero(h[at - (back * b + base)] == h[by - (back * b + base)])
                if not len(hit):
                    break
                at, by = at[hit], by[hit]
            else:
                begins.append(by)
                periods.append(at - by)
        if not begins:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(begins), np.concatenate(periods)

    def _extend(self, b: int, begins: np.ndarray, periods: np.ndarray) -> None:
        """Stretches around the catches, but those inside a known stretch whose period divides theirs."""
        order = np.lexsort((periods, begins))
        begins, periods = begins[order], periods[order]
        keep = np.ones(len(begins), dtype=bool)
        for start, end, period, _ in self._known:
            if end - start >= 3 * b - 1 and end > begins[0]:
                part = slice(*np.searchsorted(begins, (start, end)))
                inside = (periods[part] % period == 0) & (begins[part] + periods[part] + b <= end)
                keep[part] &= ~inside
        begins, periods = begins[keep], periods[keep]
        order = np.lexsort((begins, periods))
        last_period, covered = 0, 0
        for begin, period in zip(begins[order].tolist(), periods[order].tolist()):
            if period == last_period and begin < covered:
                continue
            right = self._agree(begin, begin + period)
            if right < b:
                continue  # equal hashes of different blocks
            start = begin - self._agree_before(begin, begin + period)
            end = begin + period + right
            last_period, covered = period, end - period
            if end == self.n or self._whole(start, end, period):
                self._known.append([start, end, period, False])


def runs_of(words: list[bytes], min_repeats: int = MIN_REPEATS, min_length: int = MIN_LENGTH) -> list[Run]:
    """All runs of a list of words."""
    if len(words) < max(min_length, min_repeats):
        return []
    number = dict(zip(words, range(len(words))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    catcher = SquareCatcher(min_repeats, min_length)
    for at in range(0, len(ids), APPEND_WORDS):
        catcher.append(ids[at : at + APPEND_WORDS])
    return catcher.runs()


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for r in runs:
        kept[r.start + r.period : r.start + r.length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(
    docs: DataFrame,
    min_repeats: int = MIN_REPEATS,
    min_length: int = MIN_LENGTH,
    reword: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the periodic runs of each text and the text without their repeats.

    Words are what white space of ASCII parts. ``runs`` lists start, length and period by start, then
    period; ``collapsed`` joins the words that stay by one space. Null, empty and blank texts
    have no words, an empty list and an empty text. Each row is judged alone, so repeated rows and null
    ids are kept as they are; an empty table gives no row; columns besides doc_id and text are left out.
    Texts are read whole; a task holds the words of one. ``reword`` changes the words before they are read.
    """
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("doc_id")
                counts, places, found, texts = [], [0], [], []
                for doc_id, text in zip(ids.to_pylist(), part.column("text").cast(pa.large_binary()).to_pylist()):
                    words = (text or b"").split()
                    if reword:
                        words = reword(doc_id, words)
                    runs = runs_of(words, min_repeats, min_length)
                    counts.append(len(words))
                    found += runs
                    places.append(len(found))
                    texts.append(b" ".join(collapse(words, runs)))
                fields = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
                lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(run_type)))
                columns = [ids, pa.array(counts, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(judge, schema)
