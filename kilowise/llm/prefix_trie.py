"""Prefix trie of conversations from sorted order, common prefixes and range minima.

Conversations are sorted by their turns, so those that begin alike stand side by side, and the members
of a trie node are an interval. ``lcp[i]`` says how many first turns conversation i shares with the one
before it. A sparse table of the minima of ``lcp`` over spans of 1, 2, 4 ... places lets each
candidate prefix find both ends of its interval by two binary searches, whatever the others find; nothing
is pushed on a stack. Everything that a node reports is a sum or a least value over its interval.

Equal conversations are one row with a count. The sort is Spark's, by range over all tasks. Blocks of
sorted rows are searched apart; a prefix that goes on over the border of a block gives one row per
block, and these add up. So a first turn that a third of all conversations share costs a row per
block. A block needs of its neighbours only the last and the first conversation.

Turns travel as digests of 16 bytes; texts stay where they are read. A conversation's
digests are one row, as the text of a document is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize

BLOCK_BITS = 14
_DIGEST_BYTES = 16

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, class_id binary"


class Trie(NamedTuple):
    """``nodes``: one row per node, with the ``class_id`` of the conversations that end there (null: none).
    ``members``: class_id and conv_id of every conversation."""

    nodes: DataFrame
    members: DataFrame


def digest_lists(turns: DataFrame) -> DataFrame:
    """conv_id, keys, sizes: digests and UTF-8 bytes of each conversation's turns in order.

    Turns are ordered by ``turn``, null first; equal ones by digest. Null role or text is empty.
    Rows without conv_id belong to no conversation and are left out, as are further columns. A turn's
    digest is 128 bits of the SHA-256 of its role, with its length before it, and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(marked, 256)), 1, _DIGEST_BYTES)
    row = F.struct("turn", key.alias("key"), F.octet_length(text).cast("long").alias("size"))
    lists = turns.filter("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id"))
    lists = lists.agg(F.sort_array(F.collect_list(row)).alias("t"))
    return lists.select("conv_id", F.col("t.key").alias("keys"), F.col("t.size").alias("sizes"))


def build_trie(lists: DataFrame, block_bits: int = BLOCK_BITS) -> Trie:
    """The trie of conversations given as (conv_id, keys, sizes), one row each, turnless ones included.

    Per node: ``conv_id``, the least member; ``depth``; ``parent_conv_id``, that of the parent (root: null);
    ``n_convs``, members; ``n_children``; ``n_leaves``, childless nodes below it, itself included;
    ``saved_tokens``, summed over its subtree, (members - 1) times the bytes of each node's last turn.
    Repeated rows count as often as they are there. Without conversations there is no node.
    """
    class_id = F.unhex(F.sha2(F.array_join(F.transform("keys", F.hex), ""), 256))
    lists = materialize(lists.select("conv_id", "keys", "sizes", class_id.alias("class_id")), "conversations")
    classes = lists.groupBy("class_id").agg(
        F.first("keys").alias("keys"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")
    )
    # Equal conversations are one row by now, so no run of equal keys lands in one task.
    ordered = classes.orderBy("keys").withColumn("place", F.monotonically_increasing_id())
    ordered = materialize(ordered.withColumn("block", F.shiftright("place", block_bits)), "sorted-conversations")
    borders = ordered.groupBy("block").agg(F.min_by("keys", "place").alias("first"), F.max_by("keys", "place").alias("last"))
    by_block = Window.orderBy("block")  # one row per block of 2 ** block_bits conversations
    borders = borders.select("block", F.lag("last").over(by_block).alias("before"), F.lead("first").over(by_block).alias("after"))

    found = ordered.groupBy("block").cogroup(borders.groupBy("block")).applyInArrow(search_block, f"{NODE}, key binary, parent_key binary")
    found = materialize(found, "trie-blocks")
    inside = found.filter("key IS NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    across = found.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        *sums, F.max("class_id").alias("class_id"), F.first("parent_key").alias("parent_key"),
    )
    across = materialize(across, "trie-borders")
    # Both sides are stored tables, so AQE can split the children of one node where the hint is not given.
    parents = across.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    nodes = inside.unionByName(across).join(broadcast_if_small(parents), "parent_key", "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("_parent", "parent_conv_id"))
    return Trie(nodes.select(*(c.split(" ")[0] for c in NODE.split(", "))), lists.select("class_id", "conv_id"))


class RangeMinimum:
    """Sparse table: least value of any span of an array by two look-ups, and how far a bound holds."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= self.n:
            half, last = 1 << (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.rows[k][first[own]], self.rows[k][last[own] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Last place R such that all values in (at, R] are at least ``bound``."""
        at = at.copy()
        for k in reversed(range(len(self.rows))):
            may = np.flatnonzero(at + (1 << k) < self.n)
            good = may[self.rows[k][at[may] + 1] >= bound[may]]
            at[good] += 1 << k
        return at

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First place L such that all values in (L, at] are at least ``bound``."""
        at = at.copy()
        for k in reversed(range(len(self.rows))):
            may = np.flatnonzero(at - (1 << k) >= 0)
            good = may[self.rows[k][at[may] - (1 << k) + 1] >= bound[may]]
            at[good] -= 1 << k
        return at


def common_turns(a: list[bytes] | None, b: list[bytes] | None) -> int:
    """First turns that two lists share; -1 where there is no such neighbour."""
    if a is None or b is None:
        return -1
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def adjacent_prefixes(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First turns that each list shares with the one before it; -1 for the first. ``keys`` holds all lists end to end."""
    lengths = np.diff(starts)
    row = np.repeat(np.arange(len(lengths)), lengths)
    turn = np.arange(len(keys)) - starts[row]
    here = np.flatnonzero((row > 0) & (turn < lengths[row - 1]))
    same = np.zeros(len(keys), dtype=bool)
    same[here] = (keys[here] == keys[starts[row[here] - 1] + turn[here]]).all(axis=1)
    lcp = np.zeros(len(lengths), np.int64)
    some = np.flatnonzero(lengths)
    if len(some):
        lcp[some] = np.minimum(np.minimum.reduceat(np.where(same, len(keys), turn), starts[some]), lengths[some])
    lcp[:1] = -1
    return lcp


def _prefix_ids(keys: list[bytes], upto: int) -> list[bytes]:
    """Names of the first 0 ... ``upto`` turns of a list."""
    running = hashlib.sha256()
    names = [running.digest()]
    for key in keys[:upto]:
        running.update(key)
        names.append(running.digest())
    return names


def search_block(rows: pa.Table, border: pa.Table) -> pa.Table:
    """Nodes of one block of sorted, distinct conversations; ``border`` holds its neighbours.

    Nodes whose interval goes on beyond the block carry their ``key`` and only this block's share.
    """
    rows = rows.sort_by("place").combine_chunks()
    lists = rows["keys"].combine_chunks().cast(pa.list_(pa.binary()))
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    keys = np.frombuffer(b"".join(flat.to_pylist()), np.uint64).reshape(-1, _DIGEST_BYTES // 8)
    n, lengths = len(rows), np.diff(starts)
    before, after = (border[c][0].as_py() for c in ("before", "after"))
    first, last = lists[0].as_py(), lists[n - 1].as_py()
    from_before, to_after = common_turns(before, first), common_turns(last, after)

    lcp = adjacent_prefixes(keys, starts)
    minima = RangeMinimum(lcp)
    # Candidates: every prefix at the first place in the block where it stands.
    fresh = lengths - lcp
    place = np.repeat(np.arange(n), fresh)
    depth = np.arange(len(place)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + lcp[place] + 1

    def extent(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both ends, and whether the interval begins before, or goes on after, the block."""
        low, high = minima.left(place, d), minima.right(place, d)
        return low, high, (low == 0) & (from_before >= d), (high == n - 1) & (to_after >= d)

    low, high, open_left, open_right = extent(depth)
    parent_low, parent_high, parent_left, parent_right = extent(depth - 1)
    crossing, parent_crossing = open_left | open_right, parent_left | parent_right
    root = depth == 0

    least = RangeMinimum(rows["least"].to_numpy())
    count = rows["n"].to_numpy()
    turn_bytes = np.concatenate([[0], np.cumsum(rows["sizes"].combine_chunks().flatten().to_numpy())]).astype(np.int64)
    bytes_upto = lambda at, d: turn_bytes[starts[at] + d] - turn_bytes[starts[at]]
    total = bytes_upto(np.arange(n), lengths)
    shared = lcp.copy()
    shared[0] = max(from_before, 0)
    # Of all turns, and of those that no conversation before has in the same trie node.
    all_sums, new_sums, counts = (
        np.concatenate([[0], np.cumsum(x)]).astype(np.int64)
        for x in (count * total, total - bytes_upto(np.arange(n), shared), count)
    )
    childless = np.append(lcp[1:], to_after) < lengths
    leaves = np.concatenate([[0], np.cumsum(childless)])
    begun = ~open_left  # the node's first member of all is in this block

    n_convs = counts[high + 1] - counts[low]
    above = bytes_upto(low, np.maximum(depth - 1, 0))
    new = new_sums[high + 1] - new_sums[low + begun] + np.where(begun, total[low] - above, 0)
    saved = all_sums[high + 1] - all_sums[low] - n_convs * above - new
    # A child begins where the common prefix is as deep as the node; the first member begins one too if it goes on.
    falls = np.where(np.arange(n) == 0, from_before, lcp) * n + np.arange(n)
    falls.sort()
    children = np.searchsorted(falls, depth * n + high, "right") - np.searchsorted(falls, depth * n + low + begun, "left")
    children = children + (begun & (lengths[low] > depth))

    names = [_prefix_ids(own, upto) for own, upto in ((first, from_before), (last, to_after))]

    def named(d: np.ndarray, from_left: np.ndarray, which: np.ndarray) -> pa.Array:
        out = [None] * len(d)
        for i in np.flatnonzero(which).tolist():
            out[i] = names[0 if from_left[i] else 1][d[i]]
        return pa.array(out, pa.binary())

    ends_here = begun & (lengths[low] == depth)
    class_ids = rows["class_id"].combine_chunks().take(pa.array(np.where(ends_here, low, 0)))
    nothing = pa.scalar(None, pa.binary())
    columns = {
        "conv_id": pa.array(least.least(low, high)),
        "depth": pa.array(depth),
        "parent_conv_id": pa.array(least.least(parent_low, parent_high), mask=root | parent_crossing),
        "n_convs": pa.array(n_convs),
        "n_children": pa.array(children.astype(np.int64)),
        "n_leaves": pa.array((leaves[high + 1] - leaves[low]).astype(np.int64)),
        "saved_tokens": pa.array(saved),
        "class_id": pc.if_else(pa.array(ends_here), class_ids, nothing),
        "key": named(depth, open_left, crossing),
        "parent_key": named(depth - 1, parent_left, parent_crossing & ~root),
    }
    return pa.table(columns)


def digest_of_ids(members: DataFrame) -> DataFrame:
    """class_id, ends_sha256: SHA-256 of each class's conv_ids in ascending order, comma-joined.

    Ids are read in order and hashed as they come, so memory does not grow with a class. One digest
    has to see all ids of its class one after the other; that is the only work a large class has in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            ids = batch.column("class_id")
            changes = np.flatnonzero(np.append(True, ids[1:].to_numpy(zero_copy_only=False) != ids[:-1].to_numpy(zero_copy_only=False)))
            numbers = batch.column("conv_id").to_pylist()
            for at, to in zip(changes.tolist(), [*changes[1:].tolist(), batch.num_rows]):
                text = ",".join(map(str, numbers[at:to])).encode()
                if name == ids[at].as_py():
                    running.update(b"," + text)
                else:
                    if name is not None:
                        done.append((name, running.hexdigest()))
                    name, running = ids[at].as_py(), hashlib.sha256(text)
            yield _digests(done)
        if name is not None:
            yield _digests([(name, running.hexdigest())])

    ordered = members.repartition("class_id").sortWithinPartitions("class_id", "conv_id")
    return ordered.mapInArrow(run, "class_id binary, ends_sha256 string")


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["class_id", "ends_sha256"])
