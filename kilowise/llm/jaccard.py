"""Exact similarity join of word-shingle sets by vertical partitioning.

All shingles have one global order, that of their 64-bit hashes. It is cut into fragments, each
set into the segments that fall into them.

Candidates. Two sets x, y with |x & y| >= t |x | y| differ in at most (|x| + |y|)(1 - t) / (1 + t)
shingles. Cut into more fragments than that, they agree in a whole segment. A key is a hash of
(size class, fragment, segment); candidates share a key. A set of n shingles has about 0.3 n keys.
Cutting into 2 s fragments more than needed lets every set leave out its s most frequent keys
without losing a pair, which removes keys that consist of wide-spread shingles only.

Groups of candidates that are larger than a block hang together by shared passages for the most part. Their
sets are matched once more by their rarest shingles: all their shingles are counted, ordered by how
frequent they are, and two near sets share one of their first n - ceil(t n) + 1 shingles.

Counting. The sets of each group of connected candidates meet in blocks of bounded size; the
overlap of all pairs of a block is counted for one fragment of the order after the other and
summed. Only the links of a spanning forest leave a block. Equal sets are one node throughout.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowise.llm.common import flat, mix, slices, word_hashes, word_places
from kilowise.llm.components import connected_components
from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import discard, materialize, shuffles_freed

WORDS = 4
PERCENT = 85
NEAR_WORDS, NEAR_PERCENT = 5, 80  # of near duplicates, where nothing else is asked for
BLOCK = 1024  # sets on either side of a block of pairs
BITMAP_BITS = 1 << 26  # size of the filter of shared keys: 8 MB at least
NODE_BITS = 1 << 26  # fixed size of the filter of nodes: 8 MB
LEVELS = (2, 8, 64, 512, 4096)  # how often a shingle occurs, for the order by frequency
LEVEL_BITS = 1 << 23  # size of the filter of each level: 1 MB at least
MOST_BITS = 1 << 29  # size of any filter that grows with what it holds: 64 MB at most
SENT_PERCENT = 50  # of the shingles of all documents, that are sent to blocks at a time
HELD = 1 << 19  # numbers that a task counts at a time
COUNTED_BITS = 44  # of a number, by which it is counted, in ranges of 2^32; two counted as one give more candidates, not less
FRAGMENT = 1 << 19  # shingles of a block in one fragment of the order
SPARE = 3  # keys that a set may leave out
_CLASS_RATIO = 1.35
_COUNTED = np.uint64((1 << COUNTED_BITS) - 1)
_C = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


@functools.lru_cache(maxsize=1)
def _class_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * _CLASS_RATIO)))
    return np.array(starts)


@functools.lru_cache(maxsize=512)
def _cuts(size_class: int, percent: int) -> tuple[int, int, np.ndarray]:
    """Allowed differences, number of fragments and inner borders of the fragments of a size class."""
    largest = int(_class_starts()[size_class + 1]) - 1
    differ = 2 * largest * (100 - percent) // (100 + percent)
    n = differ + 1 + (2 * SPARE + differ // 32 if differ else 0)
    return differ, n, np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)


def sets_of(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, starts = flat(texts)
    first, end, upto = word_places(raw, starts)
    hashes = word_hashes(raw, first, end, lower=True)
    n = len(hashes)
    shingles = np.zeros(n, dtype=np.uint64)
    if n >= words:
        inner = hashes[: n - words + 1] * _C[0]
        for i in range(1, words):
            inner = mix(inner) + hashes[i : n - words + 1 + i] * _C[i % len(_C)]
        shingles[: n - words + 1] = mix(inner)
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if b - a >= words:
            own = np.sort(shingles[a : b - words + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            digest = hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest()
            yield np.frombuffer(digest, dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def segment_keys(own: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, np.ndarray]]:
    """(keys that may be left out, keys) of a set, for its own size class and each larger one in which a
    set can be near enough."""
    n = len(own)
    starts = _class_starts()
    own_class = int(np.searchsorted(starts, n, "right")) - 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(own ^ _C[0]), out=sums[1:])
    c = own_class - 1
    while c < own_class or 100 * n >= percent * int(starts[c + 1]):
        c += 1
        differ, fragments, borders = _cuts(c, percent)
        cut = np.concatenate(([0], np.searchsorted(own, borders), [n]))
        filled = cut[1:] > cut[:-1]
        label = np.arange(fragments, dtype=np.uint64) * _C[1] + np.full(fragments, c, np.uint64) * _C[2]
        keys = mix(sums[cut[1:]] - sums[cut[:-1]] + label)
        spare = int(filled.sum()) - differ - 1
        # Empty segments agree with each other too: they count where too few others are left.
        yield (spare // 2, keys[filled]) if spare >= 0 else (0, keys)


def _filter(rows: DataFrame, bits: int) -> np.ndarray:
    """A filter of fixed size in which every ``bit`` of ``rows`` is set. Each task sets the bits of some
    stretches of the filter, so no more than the filter itself reaches the driver."""
    stretch = 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.asarray(batch.column("bit"))
            for part in np.unique(at // stretch).tolist():
                own = made.setdefault(part, np.zeros(stretch // 8, np.uint8))
                own |= np.packbits(np.bincount(at[at // stretch == part] % stretch, minlength=stretch) > 0)
        rows = list(made.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.int64()), pa.array([v.tobytes() for _, v in rows], pa.binary())], ["part", "set"]
        )

    out = np.zeros(bits // 8, np.uint8)
    with shuffles_freed(rows.sparkSession):
        by_stretch = rows.select("bit").repartition(min(bits // stretch, 64), F.shiftright("bit", 16))
        for row in by_stretch.mapInArrow(run, "part long, set binary").collect():  # at most one row per stretch
            out[row["part"] * stretch // 8 : (row["part"] + 1) * stretch // 8] = np.frombuffer(row["set"], np.uint8)
    return out


def _bitmap(shared: DataFrame, bits: int) -> np.ndarray:
    """A filter that has the bit of every shared key."""
    return _filter(shared.select(F.col("key").bitwiseAND(bits - 1).alias("bit")), bits)


def _bits(n: int, least: int) -> int:
    """Size of a filter: four bits for each of ``n`` numbers, ``least`` at least, up to ``MOST_BITS``."""
    return min(max(1 << (4 * n - 1).bit_length(), least), max(MOST_BITS, least))


def _in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _packed(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """range, numbers, counts of the numbers in all arrays, added up for some ``HELD`` of them at a time; a row
    holds those of a range, four bytes each."""
    found: list[np.ndarray] = []
    size = 0
    for array in arrays:
        found.append(array)
        size += len(array)
        if size >= HELD:
            yield _ranges_of(found)
            found, size = [], 0
    if size:
        yield _ranges_of(found)


def _ranges_of(found: list[np.ndarray]) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(found) & _COUNTED, return_counts=True)
    ranges = (values >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1])))
    places = pa.py_buffer((np.append(first, len(values)) * 4).astype(np.int32))
    packed = [pa.Array.from_buffers(pa.binary(), len(first), [None, places, pa.py_buffer(x.astype(np.uint32))]) for x in (values, n)]
    return pa.RecordBatch.from_arrays([pa.array(ranges[first]), *packed], ["range", "numbers", "counts"])


def _added_up(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(numbers, kind="stable")  # made of sorted stretches
    numbers = numbers[order]
    first = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1])))
    return numbers[first], np.add.reduceat(counts[order], first)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, n of the numbers that occur more than once; the rows of a range come one after the other."""
    at, held, size = None, [], 0

    def counted() -> pa.RecordBatch:
        numbers, n = _added_up(*(np.concatenate(x) for x in zip(*held)))
        often = n > 1
        keys = numbers[often].astype(np.int64) + (int(at) << 32)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[often])], ["key", "n"])

    for batch in batches:
        ranges = np.asarray(batch.column("range"))
        (numbers, starts), (counts, _) = flat(batch.column("numbers")), flat(batch.column("counts"))
        first = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1]))) if len(ranges) else []
        for a, b in zip(first, [*first[1:], len(ranges)]):
            if at != ranges[a]:
                if held:
                    yield counted()
                at, held, size = ranges[a], [], 0
            own = (np.frombuffer(x[starts[a] : starts[b]].tobytes(), np.uint32) for x in (numbers, counts))
            held.append(tuple(x.astype(kind) for x, kind in zip(own, (np.uint32, np.int64))))
            size += len(held[-1][0])
            if size >= HELD:
                held = [_added_up(*(np.concatenate(x) for x in zip(*held)))]
                size = 0  # of what came since
    if held:
        yield counted()


def _counts(rows: DataFrame, numbers_of) -> DataFrame:
    """key, n: the numbers, by their last ``COUNTED_BITS`` bits, that occur more than once in what ``numbers_of``
    makes of the batches of ``rows``."""
    packed = rows.mapInArrow(lambda batches: _packed(numbers_of(batches)), "range int, numbers binary, counts binary")
    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(_unpacked, "key long, n long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, s1, s2 (a 128-bit digest of the set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [(len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest()) for own in sets_of(part.column("text"), words)]
                both = np.frombuffer(b"".join(x for _, x in sets), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([n for n, _ in sets], pa.int64()), pa.array(both[::2]), pa.array(both[1::2])],
                    ["doc_id", "n", "s1", "s2"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long")


def _node_filter(classes: DataFrame) -> np.ndarray:
    """A filter that has the bit of every node: an id, folded."""
    node = F.col("node")
    folded = node.bitwiseXOR(F.shiftrightunsigned(node, 26)).bitwiseXOR(F.shiftrightunsigned(node, 52))
    return _filter(classes.select(folded.bitwiseAND(NODE_BITS - 1).alias("bit")), NODE_BITS)


def _standing(batch: pa.RecordBatch, nodes: np.ndarray) -> pa.RecordBatch:
    """Rows whose id is that of a node. Some others may be among them: their sets are candidates once more, not less."""
    ids = np.asarray(batch.column("doc_id").fill_null(0)).view(np.uint64)
    known = _in_bitmap(nodes, ids ^ (ids >> np.uint64(26)) ^ (ids >> np.uint64(52)))
    return batch.filter(pa.array(known & np.asarray(batch.column("doc_id").is_valid())))


def _key_counts(docs: DataFrame, nodes, words: int, percent: int) -> DataFrame:
    """key, n: the keys that more than one set has."""

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for part in slices(_standing(batch, nodes.value), "text"):
                for own in sets_of(part.column("text"), words):
                    if len(own):
                        yield from (keys for _, keys in segment_keys(own, percent))

    return _counts(docs, keys_of)


def _shared_keys(docs: DataFrame, nodes, bitmap, words: int, percent: int) -> DataFrame:
    """node, slot, spare, key: the shared keys of each set, a slot for each of its size classes."""
    names = ["node", "slot", "spare", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_standing(batch, nodes.value), "text"):
                heads, found = [], []
                for node, own in zip(part.column("doc_id").to_pylist(), sets_of(part.column("text"), words)):
                    for slot, (spare, keys) in enumerate(segment_keys(own, percent)) if len(own) else ():
                        found.append((keys & _COUNTED)[_in_bitmap(bitmap.value, keys)])
                        heads.append((node, slot, spare))
                if found:
                    head = np.repeat(np.array(heads, np.int64), [len(x) for x in found], axis=0)
                    columns = [head[:, 0], head[:, 1].astype(np.int32), head[:, 2].astype(np.int32), np.concatenate(found).view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.mapInArrow(run, "node long, slot int, spare int, key long")


def _candidates(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """key, node: the keys that sets do not leave out."""
    by_set = Window.partitionBy("node", "slot").orderBy(F.desc("n"), "key")  # at most one row per fragment
    kept = rows.join(shared, "key").withColumn("_place", F.row_number().over(by_set)).filter("_place > spare").select("key", "node")
    return materialize(kept, "keys")


def _sets_of_members(docs: DataFrame, members: DataFrame) -> DataFrame:
    """text and the columns of ``members`` of the documents that stand for a set."""
    return docs.join(broadcast_if_small(members), F.col("doc_id") == F.col("node")).select("text", *members.columns)


def _own_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and set of each text whose set is the one that its row names (an id may be repeated)."""
    for i, own in enumerate(sets_of(batch.column("text"), words)):
        digest = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64)
        if batch.column("s1")[i].as_py() == digest[0] and batch.column("s2")[i].as_py() == digest[1]:
            yield i, own


def _by_rarest(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """key, node: the rarest shingles of ``members`` (node, s1, s2), of which near sets share one. The order needs only
    to be the same for all sets, so the levels of frequency are kept in filters of bounded size."""
    texts = _sets_of_members(docs, members)

    def shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from (own for _, own in _own_sets(part, words))

    counts = materialize(_counts(texts, shingles_of), "frequent")
    # One filter per level, made as one: a key has a bit in those of all levels that it reaches. Were they to fill up, rare
    # shingles would look frequent, and groups would hang together by what is no rarer than the rest.
    sizes = [_bits(n or 0, LEVEL_BITS) for n in counts.agg(*(F.sum((F.col("n") >= x).cast("long")) for x in LEVELS)).first()]
    starts = np.cumsum([0, *sizes])
    levels = [F.struct(F.lit(int(at)).cast("long").alias("at"), F.lit(size - 1).cast("long").alias("mask"), F.lit(x).alias("n")) for at, size, x in zip(starts, sizes, LEVELS)]
    reached = F.filter(F.array(*levels), lambda x: x["n"] <= F.col("n"))
    bits = counts.select(F.explode(reached).alias("x"), "key").select((F.col("x.at") + F.col("key").bitwiseAND(F.col("x.mask"))).alias("bit"))
    filters = np.split(_filter(bits, int(starts[-1])), starts[1:-1] // 8)
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    discard(counts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                nodes, keys = [], []
                for i, own in _own_sets(part, words):
                    level = sum(_in_bitmap(x, own).astype(np.int8) for x in sent.value)
                    many = len(own) + percent * len(own) // -100 + 1
                    rarest = np.argsort(level, kind="stable")[:many]  # a set is in hash order
                    rarest = rarest[level[rarest] > 0]  # others are in no second set
                    keys.append(own[rarest])
                    nodes.append(np.full(len(rarest), part.column("node")[i].as_py(), np.int64))
                if keys:
                    columns = [np.concatenate(keys).view(np.int64), np.concatenate(nodes)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node"])

    return materialize(texts.mapInArrow(first, "key long, node long"), "rarest")


def _groups(kept: DataFrame) -> DataFrame:
    """node, component: the groups of nodes that hang together by keys; each node is joined to the least node with the
    same key. ``kept`` (key, node) is a stored table and is deleted."""
    least = kept.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("_last")).filter("u < _last")
    least = materialize(least.select("key", "u"), "least-keys")
    edges = kept.join(least, "key").filter("node > u").select("u", F.col("node").alias("v")).distinct()
    groups = materialize(connected_components(edges), "candidates")
    discard(kept, least)
    return groups


def _links_between(rows: list[tuple[int, np.ndarray]], half: int, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between the sets before and from ``half`` on (all pairs where half is 0)."""
    parent = {node: node for node, _ in rows}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    n = len(rows)
    sizes = np.array([len(own) for _, own in rows])
    left, right = (slice(0, half), slice(half, None)) if half else (slice(None), slice(None))
    shared = np.zeros((half or n, n - half), dtype=np.float32)
    # Fragment after fragment of the order: each counts its own part of the overlaps of all pairs.
    fragments = -(-int(sizes.sum()) // FRAGMENT)
    borders = np.array([(i << 64) // fragments for i in range(1, fragments)], dtype=np.uint64)
    cuts = [np.concatenate(([0], np.searchsorted(own, borders), [len(own)])) for _, own in rows]
    width = max(64, (4 << 20) // n)  # shingles in a table of 16 MB
    for f in range(fragments):
        parts = [own[cut[f] : cut[f + 1]] for (_, own), cut in zip(rows, cuts)]
        row = np.repeat(np.arange(n), [len(x) for x in parts])
        _, column, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        often = counts > 1
        place = np.cumsum(often) - 1
        keep = often[column]
        row, column = row[keep], place[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        many = int(often.sum())
        for a in range(0, many, width):
            x, y = np.searchsorted(column, (a, a + width))
            table = np.zeros((n, min(width, many - a)), dtype=np.float32)
            table[row[x:y], column[x:y] - a] = 1
            shared += table[left] @ table[right].T
    near = (100 + percent) * shared.astype(np.int64) >= percent * (sizes[left][:, None] + sizes[right][None, :])
    if not half:
        near = np.triu(near, 1)
    for i, j in zip(*np.nonzero(near)):
        a, b = rows[i][0], rows[j + half][0]
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            yield a, b


def _links(docs: DataFrame, members: DataFrame, words: int, percent: int, rounds: int) -> DataFrame:
    """u, v: a spanning forest of the links within the groups of candidates.

    members: node, s1, s2, component, part, parts (blocks of the component). Each set goes to all pairs
    of blocks that hold it; a pair of blocks is counted in one task. The pairs are dealt over ``rounds``, one
    after the other, so that not all copies of the sets of a large group are on disk at once.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["component", "part", "parts", "node"]
        for batch in batches:
            for part in slices(batch, "text"):
                own = list(_own_sets(part, words))
                chosen = pa.array([i for i, _ in own], pa.int64())
                columns = [part.column(c).take(chosen) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for _, x in own], pa.binary())], [*names, "set"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish() -> pa.RecordBatch:
            distinct = {(half, node, data): None for half, node, data in held}
            rows = sorted(distinct, key=lambda x: x[0])
            half = sum(x[0] == 0 for x in rows) if key[1] != key[2] else 0
            found = list(_links_between([(node, np.frombuffer(data, np.uint64)) for _, node, data in rows], half, percent))
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["u", "v"]
            )

        key, held = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("component", "a", "b", "half", "node", "set"))
            for component, a, b, half, node, data in zip(*columns):
                if key != (component, a, b):
                    if len(held) > 1:
                        yield finish()
                    key, held = (component, a, b), []
                held.append((half, node, data))
        if len(held) > 1:
            yield finish()

    texts = _sets_of_members(docs, members)
    own = texts.mapInArrow(sets, "component long, part int, parts int, node long, set binary")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, F.col("part")).alias("a"), F.greatest(p, F.col("part")).alias("b")),
    )
    found = []
    for i in range(rounds):
        turn = F.filter(pairs, lambda p: F.pmod(F.xxhash64("component", p["a"], p["b"]), F.lit(rounds)) == i)  # noqa: B023
        dealt = own.withColumn("pair", F.explode(turn)).select("component", "pair.a", "pair.b", "part", "node", "set")
        dealt = dealt.withColumn("half", F.when(F.col("a") == F.col("b"), 0).otherwise((F.col("part") == F.col("b")).cast("int")))
        together = dealt.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b", "half")
        found.append(materialize(together.mapInArrow(count, "u long, v long"), "links"))
    return functools.reduce(DataFrame.unionByName, found)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Texts are lower-cased (A-Z) and cut at white space; a set holds the distinct runs of ``words``
    words, or the whole sequence of fewer. Sets link when 100 |x & y| >= percent |x | y|; a component
    is named by its least doc_id. Null, empty and blank texts have no shingle and stay alone. doc_id
    is taken as unique: each row of a repeated id is linked by its own text. A row without doc_id is
    linked through an equal set of a row that has one, else its component is null. An empty table
    gives an empty one; other columns are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialize(_sets(docs, words), "sets")
    # One node per distinct set; copies combine before the shuffle, and only one of them is cut into segments.
    classes = rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"))
    classes = materialize(classes.filter("node is not null"), "classes")
    nodes = spark.sparkContext.broadcast(_node_filter(classes))
    shared = materialize(_key_counts(docs, nodes, words, percent), "shared-keys")
    bitmap = spark.sparkContext.broadcast(_bitmap(shared, _bits(shared.count(), BITMAP_BITS)))
    kept = _candidates(_shared_keys(docs, nodes, bitmap, words, percent), shared)
    discard(shared)
    groups = _groups(kept)
    named_sets = classes.select("node", "s1", "s2")
    sizes = materialize(groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
    large = sizes.filter(F.col("size") > block).select("component")
    if large.count():
        members = materialize(groups.join(large, "component", "left_semi").join(named_sets, "node").select("node", "s1", "s2"), "large-groups")
        again = _groups(_by_rarest(docs, members, words, percent))
        groups = materialize(groups.join(large, "component", "left_anti").unionByName(again), "candidates-again")
        sizes = materialize(groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
    # Blocks of a candidate group: dealt by hash, as many as its size asks for.
    members = groups.join(sizes.select("component", F.ceil(F.col("size") / block).cast("int").alias("parts")), "component")
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    members = materialize(members.join(named_sets, "node"), "members")
    sent = members.join(classes.select("s1", "s2", "n"), ["s1", "s2"]).agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    rounds = max(1, -(-100 * sent // max(1, SENT_PERCENT * shingles)))
    labels = materialize(connected_components(_links(docs, members, words, percent, rounds)), "components")
    named = classes.select("s1", "s2", "node").join(labels, "node", "left")
    named = materialize(named.select("s1", "s2", F.coalesce("component", "node").alias("component_id")), "named")
    return rows.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, words: int = NEAR_WORDS, percent: int = NEAR_PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that with the least doc_id. Documents
    without words or without id all stay; rows that repeat a kept doc_id stay too. Where an id has several texts, its rows go
    together, if any of them is near an older document. Columns stay as they are; an empty table gives an empty one."""
    found = jaccard_components(docs, words, percent)
    gone = found.filter((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select("doc_id").distinct()
    gone = materialize(gone, "near-copies")
    gone = broadcast_if_small(gone)
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
