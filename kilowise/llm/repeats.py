"""Windows of a fixed length that start anywhere else too, over a corpus of any size.

What is shared by the byte and the word form of repeated-passage removal:

1. Anchors. Each window of W units is named by its least k-gram (by hash, leftmost of equals).
   Equal windows have equal anchors at equal offsets. Neighbouring windows with the same anchor form
   a segment, so a corpus has about 2 / (W - k + 2) segments per unit.
2. Counts. Per anchor hash: number of segments and the least and greatest content hash. An anchor
   that occurs once ends here; one whose segments are all equal needs no look at the text.
3. Contents. Only anchors with different contents send their text, each content once per batch,
   to the task of the anchor, where a suffix structure finds the windows that occur twice.
   Anchors with very many contents send window hashes instead, which spread over all tasks.
4. Verdicts, one row per content, go back to the segments, and per document become removed runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import _BYTE_VALUES, _powers, flat, mix, slices, word_hashes, word_places
from kilowise.llm.jaccard import _bitmap, _in_bitmap
from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize

BITMAP_BITS = 1 << 27  # fixed size of each filter of anchors: 16 MB
SLICE_BYTES = 1 << 20
MAX_CONTENTS = 4096  # of one anchor in one task
BLOCK_UNITS = 1 << 20  # bytes of text per suffix structure
BLOCK_WORDS = 1 << 17  # words: an automaton takes about 440 bytes a word
_PLACE_BITS = 31
_STEPS = np.random.default_rng(7919).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """window, gram: lengths in units (gram a power of two); words: units are words, else bytes."""

    window: int
    gram: int
    words: bool


def units(batch: pa.RecordBatch, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash per unit of all texts, the places where texts begin (n + 1), and the units themselves
    (bytes, or the hashes again)."""
    raw, starts = flat(batch.column("text"))
    if not rule.words:
        return _BYTE_VALUES[raw], starts, raw
    first, end, upto = word_places(raw, starts)
    hashes = word_hashes(raw, first, end)
    return hashes, upto, hashes


def segments(hashes: np.ndarray, starts: np.ndarray, rule: Rule):
    """(text, first window, last window, anchor hash, content hash) arrays of all segments; places
    count from the start of the flat array."""
    n, k, w = len(hashes), rule.gram, rule.window - rule.gram + 1
    none = np.zeros(0, np.int64)
    if n < rule.window:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams, size, level = hashes, 1, 0
    while size < k:
        grams = grams[:-size] * _STEPS[level] + grams[size:]
        size, level = 2 * size, level + 1
    grams = mix(grams)
    least = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < w:
        least = np.minimum(least[: size - w], least[w - size :])
    place = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    valid = np.zeros(len(place) + 2, dtype=np.int8)  # windows that lie within one text
    lengths = np.diff(starts)
    long = lengths >= rule.window
    np.add.at(valid, starts[:-1][long], 1)
    np.add.at(valid, starts[:-1][long] + lengths[long] - rule.window + 1, -1)
    valid = np.cumsum(valid[: len(place)], dtype=np.int8) > 0
    change = np.empty(len(place), dtype=bool)
    change[0] = True
    np.not_equal(place[1:], place[:-1], out=change[1:])
    change[1:] |= valid[1:] != valid[:-1]
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(place)) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    end = last + rule.window
    content = mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))
    text = np.searchsorted(starts, first, "right") - 1
    return text, first, last, grams[place[first]], content


def _anchor_counts(docs: DataFrame, rule: Rule) -> DataFrame:
    """key (anchor hash), low, high (content hashes) of the anchors that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, contents = [], []
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, starts, _ = units(part, rule)
                *_, anchor, content = segments(hashes, starts, rule)
                anchors.append(anchor)
                contents.append(content)
            anchor, content = np.concatenate(anchors).view(np.int64), np.concatenate(contents).view(np.int64)
            order = np.lexsort((content, anchor))
            anchor, content = anchor[order], content[order]
            first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else order
            last = np.append(first[1:], len(anchor)) - 1 if len(anchor) else order
            columns = [anchor[first], (last - first + 1).astype(np.int32), content[first], content[last]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "n", "low", "high"])

    rows = docs.select("text").mapInArrow(run, "key long, n int, low long, high long")
    found = rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return found.filter("n > 1").select("key", "low", "high")


def _segment_rows(docs: DataFrame, rule: Rule, repeated, differing) -> DataFrame:
    """The segments of repeated anchors: doc_id, mark, first, last, anchor, content; the first of equal
    contents in a batch also has n, their number, and the text where the anchor has different contents."""
    schema = "doc_id long, mark long, first long, last long, anchor long, content long, n int, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(6)]
            bodies: list[bytes] = []
            seen: dict[tuple[int, int], int] = {}
            sent, counts = [], []
            at = 0
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, starts, source = units(part, rule)
                text, first, last, anchor, content = segments(hashes, starts, rule)
                keep = _in_bitmap(repeated.value, anchor)
                text, first, last, anchor, content = (x[keep] for x in (text, first, last, anchor, content))
                shown = np.flatnonzero(_in_bitmap(differing.value, anchor))
                for i, pair in zip(shown.tolist(), zip(anchor[shown].tolist(), content[shown].tolist())):
                    if pair in seen:
                        counts[seen[pair]] += 1
                    else:
                        seen[pair] = len(sent)
                        sent.append(at + i)
                        counts.append(1)
                        bodies.append(source[first[i] : last[i] + rule.window].tobytes())
                at += len(text)
                doc, mark = np.asarray(part.column("doc_id").fill_null(0)), np.asarray(part.column("mark"))
                null = np.asarray(part.column("doc_id").is_null())
                values = (pa.array(doc[text], mask=null[text]), mark[text], first - starts[text], last - starts[text],
                          anchor.view(np.int64), content.view(np.int64))
                for column, value in zip(found, values):
                    column.append(value if isinstance(value, pa.Array) else pa.array(value))
            if at:
                n = np.zeros(at, np.int32)
                n[sent] = counts
                body: list[bytes | None] = [None] * at
                for i, data in zip(sent, bodies):
                    body[i] = data
                columns = [pa.concat_arrays(c) for c in found]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n), pa.array(body, pa.binary())],
                    ["doc_id", "mark", "first", "last", "anchor", "content", "n", "body"],
                )

    return docs.mapInArrow(run, schema)


def _ranges(starts: np.ndarray) -> list[dict]:
    """Runs of consecutive window starts, ascending, as from / to pairs (to is inclusive)."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(a), "b": int(b)} for a, b in zip(starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]])]


_VERDICT = "anchor long, content long, ranges array<struct<a:int,b:int>>"
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

# Takes contents (arrays of units) and how often each occurs; gives for each a mask of its windows that occur twice.
Finder = Callable[[list[np.ndarray], np.ndarray, int], list[np.ndarray]]


def _found_in_blocks(contents: DataFrame, rule: Rule, finder: Finder) -> DataFrame:
    """Verdicts from suffix structures over blocks of whole anchors."""
    kind = np.uint64 if rule.words else np.uint8
    limit = BLOCK_WORDS if rule.words else BLOCK_UNITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}  # (anchor, content) -> [occurrences, text]
        size, last = 0, None

        def finish() -> pa.RecordBatch:
            keys = list(held)
            texts = [np.frombuffer(body, kind) for _, body in held.values()]
            times = np.array([n for n, _ in held.values()])
            masks = finder(texts, times, rule.window)
            rows = [(key, np.flatnonzero(mask)) for key, mask in zip(keys, masks)]
            rows = [(key, starts) for key, starts in rows if len(starts)]
            columns = [pa.array([k[0] for k, _ in rows], pa.int64()), pa.array([k[1] for k, _ in rows], pa.int64()),
                       pa.array([_ranges(s) for _, s in rows], _RANGES)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["anchor", "content", "ranges"])

        for batch in batches:
            for anchor, content, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != last and size >= limit:
                    yield finish()
                    size = 0
                last = anchor
                if (anchor, content) in held:
                    held[anchor, content][0] += n
                else:
                    held[anchor, content] = [n, body]
                    size += len(body) // kind().itemsize
        if held:
            yield finish()

    together = contents.repartition("anchor").sortWithinPartitions("anchor")
    return together.mapInArrow(run, _VERDICT)


def _found_by_hash(contents: DataFrame, rule: Rule) -> DataFrame:
    """Verdicts of anchors with very many contents: every window as a 128-bit hash, counted over all tasks."""
    kind = np.uint64 if rule.words else np.uint8
    schema = "anchor long, content long, at int, n int, h1 long, h2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(body, kind)
                values = own if rule.words else _BYTE_VALUES[own]
                m = len(own) - rule.window + 1
                both = []
                for x in (values, mix(values ^ _STEPS[0])):
                    up, down = _powers(len(own) + 1)
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[: len(own)])))
                    both.append(mix((sums[rule.window :] - sums[:m]) * down[:m]).view(np.int64))
                columns = [np.full(m, anchor), np.full(m, content), np.arange(m, dtype=np.int32), np.full(m, n, np.int32), *both]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["anchor", "content", "at", "n", "h1", "h2"]
                )

    rows = materialize(contents.mapInArrow(run, schema), "windows")
    twice = rows.groupBy("h1", "h2").agg(F.sum("n").alias("_n")).filter("_n > 1").drop("_n")
    hits = rows.join(materialize(twice, "twice"), ["h1", "h2"]).groupBy("anchor", "content").agg(F.collect_set("at").alias("at"))
    # At most as many places as a segment has windows.
    return hits.select("anchor", "content", F.transform(F.array_sort("at"), lambda i: F.struct(i.alias("a"), i.alias("b"))).alias("ranges"))


def removed_runs(docs: DataFrame, rule: Rule, finder: Finder) -> DataFrame:
    """doc_id, mark, runs: for every document with repeated windows, the maximal runs (first, end) of units
    that they cover. ``docs`` has doc_id, mark (a hash of the text) and text."""
    spark = docs.sparkSession
    counts = materialize(_anchor_counts(docs, rule), "anchors")
    repeated = spark.sparkContext.broadcast(_bitmap(counts, BITMAP_BITS))
    differing = spark.sparkContext.broadcast(_bitmap(counts.filter("low <> high"), BITMAP_BITS))
    rows = materialize(_segment_rows(docs, rule, repeated, differing), "segments")
    contents = rows.filter("body is not null").select("anchor", "content", "n", "body")
    many = materialize(
        contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MAX_CONTENTS).select("anchor"), "many"
    )
    verdicts = counts.filter("low = high").select(
        F.col("key").alias("anchor"), F.col("low").alias("content"), F.lit(None).cast("array<struct<a:int,b:int>>").alias("ranges")
    )
    if many.count():
        few = contents.join(many, "anchor", "left_anti")
        verdicts = verdicts.union(_found_by_hash(contents.join(many, "anchor", "left_semi"), rule))
    else:
        few = contents
    verdicts = materialize(verdicts.union(_found_in_blocks(few, rule, finder)), "verdicts")
    hits = rows.select("doc_id", "mark", "first", "last", "anchor", "content").join(verdicts, ["anchor", "content"])
    # No ranges: every window of the segment is repeated.
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("last") - F.col("first")).cast("int").alias("b")))
    parts = F.transform(
        F.coalesce("ranges", whole),
        lambda r: F.struct((F.col("first") + r["a"]).alias("first"), (F.col("first") + r["b"] + rule.window).alias("end")),
    )
    # One entry per segment of the document, also where its row is repeated, so a group is no larger than its text.
    grouped = hits.select("doc_id", "mark", parts.alias("parts")).groupBy("doc_id", "mark").agg(F.flatten(F.collect_set("parts")).alias("parts"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            runs = []
            for parts in batch.column("parts"):
                first, end = (np.asarray(parts.values.field(c)) for c in ("first", "end"))
                order = np.argsort(first, kind="stable")
                first, end = first[order], np.maximum.accumulate(end[order])
                cut = np.flatnonzero(first[1:] > end[:-1])
                runs.append([{"first": a, "end": b} for a, b in zip(first[np.r_[0, cut + 1]].tolist(), end[np.r_[cut, len(end) - 1]].tolist())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(runs, kind)], ["doc_id", "mark", "runs"])

    return grouped.mapInArrow(merge, "doc_id long, mark long, runs array<struct<first:bigint,end:bigint>>")


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, mark, text; null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Add the runs to their documents; a document is its id and the hash of its text."""
    runs = materialize(runs, "runs").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "runs")
    runs = broadcast_if_small(runs)
    same = (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return docs.join(runs, same, "left").select("doc_id", "text", "runs")
