"""Removal of repeated word passages with suffix automata of reference shards.

A shard is what the anchors of ``repeats`` route to one task: all passages that can share a window. Its
suffix automaton knows how often each string occurs; the passages of the shard stream through it, and
where the matching statistic reaches the window length, the state of that length tells whether
the window occurs again. Sending every document to every shard would cost documents times
shards; an anchor names the one shard in which a window can match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilowise.llm import repeats
from kilowise.llm.common import flat

WINDOW = 35
GRAM = 8


class ShardAutomaton:
    """Suffix automaton of numbered words with the number of places of each state's strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]

    def add(self, words: list[int], times: int) -> None:
        """Add one text, which stands for ``times`` equal ones."""
        following, link, length, places = self.next, self.link, self.length, self.places
        last = 0
        for w in words:
            q = following[last].get(w)
            if q is not None:
                if length[q] != length[last] + 1:
                    q = self._clone(last, w, q)
                last = q
            else:
                new, p = len(link), last
                following.append({})
                length.append(length[last] + 1)
                link.append(0)
                places.append(0)
                while p != -1 and w not in following[p]:
                    following[p][w] = new
                    p = link[p]
                if p != -1:
                    q = following[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
                last = new
            places[last] += times

    def _clone(self, p: int, w: int, q: int) -> int:
        following, link = self.next, self.link
        clone = len(link)
        following.append(dict(following[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.places.append(0)
        link[q] = clone
        while p != -1 and following[p].get(w) == q:
            following[p][w] = clone
            p = link[p]
        return clone

    def count(self) -> None:
        """Places of a state are those of all states that link to it, longest first."""
        link, places = self.link, self.places
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if state:
                places[link[state]] += places[state]

    def repeated(self, words: list[int], window: int) -> np.ndarray:
        """A mask of the windows of ``words`` that occur twice or more; stream and matching statistics."""
        following, link, length, places = self.next, self.link, self.length, self.places
        mask = np.zeros(max(0, len(words) - window + 1), dtype=bool)
        state = matched = 0
        for i, w in enumerate(words):
            while state and w not in following[state]:
                state = link[state]
                matched = length[state]
            if w in following[state]:
                state, matched = following[state][w], matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                mask[i + 1 - window] = places[state] > 1
        return mask


def repeated_windows(texts: list[np.ndarray], times: np.ndarray, window: int) -> list[np.ndarray]:
    """For each text a mask of its windows that occur twice or more in all texts, text i counting times[i]."""
    _, numbers = np.unique(np.concatenate(texts), return_inverse=True)
    stops = np.cumsum([len(x) for x in texts])
    own = [x.tolist() for x in np.split(numbers, stops[:-1])]
    automaton = ShardAutomaton()
    for words, n in zip(own, times.tolist()):
        automaton.add(words, n)
    automaton.count()
    return [
        np.ones(len(words) - window + 1, bool) if n > 1 else automaton.repeated(words, window)
        for words, n in zip(own, times.tolist())
    ]


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each word covered by a window of ``window`` words whose
    sequence also starts anywhere else goes, judged on the input; kept words are joined by single spaces.

    Words end at white space (0x20, 0x09-0x0D); windows never cross documents; a repeated row is
    another place. Null and empty texts have no words; texts shorter than the window stay whole.
    Rows with equal id and text get equal results. An empty table gives an empty one; other columns
    are left out.
    """
    own = repeats.marked(docs)
    runs = repeats.removed_runs(own, repeats.Rule(window, gram, words=True), repeated_windows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = flat(batch.column("text"))
            data = raw.tobytes()
            rows = []
            for a, b, found in zip(starts[:-1].tolist(), starts[1:].tolist(), batch.column("runs").to_pylist()):
                words = data[a:b].split()
                n = len(words)
                for run in reversed(found or ()):
                    del words[run["first"] : run["end"]]
                text = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(text).hexdigest(), text.decode()))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return repeats.with_runs(own, runs).mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
