"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all item texts, as sequences of words, is built once and broadcast; documents
stream through it word by word while the length of the longest suffix that occurs in some item
is tracked. The items are cut into shards of bounded size, each with its own automaton, so what
is broadcast has a proven bound; the documents pass all shards in one stage without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kilowise.llm.common import flat, slices

WINDOW = 10
SHARD_WORDS = 2_000_000  # words of test items per automaton
_BREAK = b"\xff"  # between texts; no UTF-8 text has this byte
# Bytes of words: 0-9, a-z and all of non-ASCII characters; A-Z become lower case, others spaces.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over numbered words.

    ``marks[state]`` lists the windows that are the state's own strings: (length, items).
    ``up[state]`` is the nearest state on the chain of shorter suffixes that has marks.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary = {_BREAK: -2}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = []
        for name, words in items:
            texts.append((name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
        self.shortest = min((min(window, len(w)) for _, w in texts if w), default=window)
        for _, words in texts:
            last = 0
            for w in words:
                last = self._extend(last, w)
        found: dict[int, dict[int, set[str]]] = {}
        pairs = set()
        for name, words in texts:
            pairs.update(zip(words, words[1:]))
            m = min(window, len(words))
            for end, (state, got) in enumerate(self.walk(words)):
                if m and end >= m - 1:
                    state = self._at_length(state, got, m)
                    found.setdefault(state, {}).setdefault(m, set()).add(name)
        self.marks = {s: [(m, sorted(names)) for m, names in by.items()] for s, by in found.items()}
        self.up = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            parent = self.link[state]
            self.up[state] = parent if parent in self.marks else self.up[parent]
        self.pairs = np.array(sorted(a << 32 | b for a, b in pairs), dtype=np.int64)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        new = len(self.link)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        clone = len(self.link)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _at_length(self, state: int, got: int, m: int) -> int:
        """The state that holds the suffix of length m of a match of length ``got``."""
        while self.length[self.link[state]] >= m:
            state = self.link[state]
        return state

    def walk(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word, the state and the length of the longest suffix that occurs in an item."""
        state = got = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                got = self.length[state]
            if w in self.next[state]:
                state, got = self.next[state][w], got + 1
            yield state, got

    def windows(self, words: list[int]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, end, items) of each window that occurs in ``words``."""
        for i, (state, got) in enumerate(self.walk(words)):
            if state not in self.marks:
                state, got = self.up[state], self.length[self.up[state]]
            while state:
                for m, names in self.marks[state]:
                    if m <= got:
                        yield i + 1 - m, i + 1, names
                state = self.up[state]
                got = self.length[state]

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words in which a window may lie: a word, and each pair of neighbours, unknown to
        the automaton would send it back to its start."""
        known = ids >= 0
        least = self.shortest
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
        first, end = edges[::2], edges[1::2]
        keep = end - first >= least
        for a, b in zip(first[keep].tolist(), end[keep].tolist()):
            if least == 1:
                yield a, b
                continue
            codes = ids[a : b - 1].astype(np.int64) << 32 | ids[a + 1 : b]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            good = np.concatenate(([False], self.pairs[at] == codes, [False])).astype(np.int8)
            inner = np.flatnonzero(np.diff(good))
            for x, y in zip(inner[::2].tolist(), inner[1::2].tolist()):
                if y - x >= least - 1:
                    yield a + x, a + y + 1


def _shards(items: DataFrame, window: int, shard_words: int) -> list[Automaton]:
    """One automaton for each shard of the items; a shard is collected by itself."""
    words = F.length(F.coalesce(F.col("text"), F.lit(""))) / 2 + 1  # at most one word per two characters
    total = items.agg(F.sum(words)).first()[0] or 0
    n = int(total // shard_words) + 1
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    made = []
    for i in range(n):
        rows = items.filter(shard == i).orderBy("item_id", "text").toLocalIterator()
        texts = [(r["item_id"], words_of((r["text"] or "").encode())) for r in rows]
        if any(w for _, w in texts):
            made.append(Automaton(texts, window))
    return made


def _cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what stands between two of them."""
    space = np.frombuffer(text.translate(_WORD_BYTES), np.uint8) == 0x20
    inside = np.concatenate(([True], space, [True]))
    first = np.flatnonzero(inside[:-1] & ~inside[1:])
    end = np.flatnonzero(~inside[:-1] & inside[1:])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    kept, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept.append(text[at : first[a]])
        at = end[b - 1]
    return b"".join([*kept, text[at:]])


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, keep: tuple[str, ...] = (),
    cut: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated, spans (and clean_text).

    A window is ``window`` consecutive item words; a shorter item is one window. ``spans`` are runs
    of hit words (first, end). Null and empty texts have no words and no hits; items without words
    have no window; a null item_id counts as "null"; repeated documents are judged alike, repeated
    items count once. ``keep`` names further columns of ``docs`` to pass on, ``cut`` adds the text
    without the hit spans. Columns of ``docs`` that are not named are left out; one of ``keep`` must not have the
    name of a result. An empty table of documents gives an empty one, an empty one of items no hits.
    """
    spark = docs.sparkSession
    automata = [spark.sparkContext.broadcast(x) for x in _shards(items, window, shard_words)]
    names = list(dict.fromkeys(["doc_id", *keep]))
    own = docs.select(*names, F.col("text").cast("string").alias("_text"))
    new = (
        "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean,"
        " spans array<struct<first:int,end:int>>" + ", clean_text string" * cut
    )
    schema = own.drop("_text").schema
    for field in StructType.fromDDL(new).fields:
        schema = schema.add(field)

    def judge(batch: pa.RecordBatch) -> list[tuple]:
        raw, starts = flat(batch.column("_text"))
        data = raw.tobytes()
        texts = [data[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        words = (b" " + _BREAK + b" ").join([*(t.translate(_WORD_BYTES) for t in texts), b""]).split()
        hit = np.zeros(len(words), dtype=bool)
        found: dict[int, set[str]] = {}
        breaks = None
        for automaton in (x.value for x in automata):
            ids = np.fromiter(map(automaton.vocabulary.get, words, repeat(-1)), np.int64, len(words))
            if breaks is None:
                breaks = np.flatnonzero(ids == -2)
            for a, b in automaton.runs(ids):
                for first, end, names in automaton.windows(ids[a:b].tolist()):
                    hit[a + first : a + end] = True
                    found.setdefault(int(np.searchsorted(breaks, a)), set()).update(names)
        if breaks is None:
            breaks = np.flatnonzero(np.fromiter((w == _BREAK for w in words), bool, len(words)))
        rows, at = [], 0
        for i, to in enumerate(breaks.tolist()):
            own_hit = hit[at:to]
            got = sorted(found.get(i, ()))
            n_hit = int(own_hit.sum())
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own_hit.astype(np.int8), [0])))).tolist() if n_hit else []
            digest = hashlib.sha256(",".join(got).encode()).hexdigest()
            spans = [{"first": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
            row = (to - at, n_hit, len(got), got, digest, n_hit > 0, spans)
            if cut:
                row += ((_cut(texts[i], own_hit) if n_hit else texts[i]).decode(),)
            rows.append(row)
            at = to + 1
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        kinds = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.string(), pa.bool_(), span] + [pa.string()] * cut
        labels = schema.names
        for batch in batches:
            for part in slices(batch, "_text"):
                columns = list(zip(*judge(part)))
                kept = [part.column(n) for n in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds))], labels)

    return own.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the texts, and documents of which
    more than ``max_coverage`` of the words are hit, or nothing is left, go. Columns stay as they are;
    a text without hits is unchanged, a null one becomes empty."""
    others = F.struct(F.lit(None).alias("_none"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    found = find_contamination(docs.select(F.lit(None).cast("long").alias("doc_id"), "text", others.alias("_kept")), items,
                               window, keep=("_kept",), cut=True)
    gone = F.col("contaminated") & (
        (F.col("n_hit") > max_coverage * F.col("n_words")) | (F.trim(F.col("clean_text")) == "")
    )
    return found.filter(~gone).select(
        *[F.col("clean_text").alias("text") if c == "text" else F.col(f"_kept.`{c}`").alias(c) for c in docs.columns]
    )
