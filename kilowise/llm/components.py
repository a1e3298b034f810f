"""Connected components of a graph of any size, by forests of stretches of its edges.

Each task joins the edges that it reads, some ``HELD`` at a time, to a forest and gives every node the least
node of its tree as a label. A node then has one label per stretch that it occurs in; it keeps the
least, and where it has several, these labels are the edges of a smaller graph of labels, which is
solved in the same way. Labels are gathered by node, so a node with very many neighbours costs as little as
others: it is a label, and a label is gathered nowhere. Where the graph of labels stops shrinking, as for long
paths whose edges lie all over the table, alternating stars solve what is left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.plans.storage import materialize

HELD = 1 << 16  # edges that a task joins at a time


def _forest(held: int):
    """node, label for the nodes of each stretch of edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent[x]) != x:
                parent[x] = x = parent[up]
            return x

        def labels() -> pa.RecordBatch:
            nodes = list(parent)
            columns = [pa.array(nodes, pa.int64()), pa.array(list(map(root, nodes)), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["node", "label"])

        n = 0
        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                parent.setdefault(u, u)
                parent.setdefault(v, v)
                x, y = root(u), root(v)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                n += 1
                if n >= held:
                    yield labels()
                    parent.clear()
                    n = 0
        if parent:
            yield labels()

    return run


def connected_components(edges: DataFrame, held: int = HELD) -> DataFrame:
    """node, component for every node of ``edges`` (u, v: long, no nulls), one row each; the component is its least node.

    Repeated edges do no harm, those of a node to itself count as none; an empty table gives an empty one.
    """
    edges = edges.filter("u <> v")
    levels: list[DataFrame] = []
    before = None
    while True:
        labels = edges.select("u", "v").mapInArrow(_forest(held), "node long, label long")
        by_node = labels.groupBy("node").agg(F.min("label").alias("label"), F.collect_set("label").alias("labels"))
        by_node = materialize(by_node, "labels")
        levels.append(by_node.select("node", F.col("label").alias("component")))
        several = by_node.filter(F.size("labels") > 1).select(F.explode("labels").alias("u"), F.col("label").alias("v")).filter("u <> v")
        left = several.count()
        if not left:
            break
        if before is not None and 2 * left > before:
            levels.append(_by_stars(several))
            break
        # Stretches of the usual size, so that what lies in many small files is joined at once.
        edges, before = several.coalesce(math.ceil(left / held)), left
    found = levels.pop()
    for level in reversed(levels):
        # Both sides are stored, so the join can be split at a label of very many nodes.
        found = materialize(found.select(F.col("node").alias("_label"), F.col("component").alias("_final")), "label-components")
        joined = level.join(found, F.col("component") == F.col("_label"), "left")
        found = joined.select("node", F.coalesce("_final", "component").alias("component"))
    return found


def _with_least(edges: DataFrame) -> DataFrame:
    """Add to each edge the least of its first node and that node's neighbours. The table of least
    nodes is stored, so that the join can be split at a node with very many neighbours."""
    least = materialize(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return edges.join(least, "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v") % (1 << 40)
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _by_stars(edges: DataFrame) -> DataFrame:
    """The same by alternating large and small stars: each round replaces the neighbours of a node by one common least
    node; the number of rounds grows with the logarithm of the longest path. Rounds are stored tables, not lineage."""
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        # Large star: neighbours above a node are joined to the least node around it.
        large = _with_least(_both_ways(edges)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large")
        # Small star: a node and its neighbours below it are joined to the least of them.
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
