"""Components against a plain search, however the edges lie in the table."""

from __future__ import annotations

import random

import pytest

from kilowise.llm import components


def brute(edges):
    near = {}
    for u, v in (e for e in edges if e[0] != e[1]):
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    label = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = start
                todo += near[x]
    return label


def graphs():
    draw = random.Random(4)
    path = [(i, i + 1) for i in range(70)]
    draw.shuffle(path)
    star = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1010)]
    sparse = [(draw.randrange(500), draw.randrange(500)) for _ in range(350)]
    return {"path": path, "star": star, "sparse": sparse + sparse[:40] + [(9, 9), (-5, 7)], "none": []}


@pytest.mark.parametrize("name", graphs())
@pytest.mark.parametrize("held", [3, 1 << 18])
def test_components(spark, name, held):
    edges = graphs()[name]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    found = components.connected_components(frame, held).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == brute(edges)


def test_stars_solve_what_does_not_shrink(spark, monkeypatch):
    """A path with each edge in a stretch of its own."""
    called = []
    stars = components._by_stars
    monkeypatch.setattr(components, "_by_stars", lambda e: called.append(1) or stars(e))
    edges = [(i, i + 1) for i in range(40)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(6), 1).collect()
    assert {r["node"]: r["component"] for r in found} == brute(edges) and called
