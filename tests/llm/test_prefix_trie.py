"""Prefix trie against all prefixes, with blocks of any size."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilowise.llm import prefix_trie, queries

CONVERSATION = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def brute(conversations):
    """Rows of all nodes of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, own in members.items()
    )


def rows_of(frame):
    return sorted(tuple(r[c] for c in (*COLUMNS, "ends_sha256")) for r in frame.collect())


def with_ends(trie):
    ends = prefix_trie.digest_of_ids(trie.members)
    return trie.nodes.join(ends, "class_id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def conversations(seed, n, letters=3, turns=6):
    draw = random.Random(seed)
    out = {}
    for c in range(n):
        out[c * 3 - 20] = [(draw.choice(["user", ""]), "é" * draw.randrange(letters)) for _ in range(draw.randint(0, turns))]
    out[9000] = [("user", "x")] * 60
    out[9001] = [("user", "x")] * 59 + [("user", "y")]
    return out


@pytest.mark.parametrize("bits,parts", [(0, 3), (1, 1), (3, 4), (14, 5), (14, 1)])
def test_trie_is_that_of_all_prefixes(spark, bits, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    own = conversations(bits + parts, 150)
    lists = spark.createDataFrame(
        [(c, [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16] for r, t in w], [len(t.encode()) for _, t in w]) for c, w in own.items()],
        "conv_id long, keys array<binary>, sizes array<long>",
    )
    try:
        assert rows_of(with_ends(prefix_trie.build_trie(lists, bits))) == brute(own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_single_roots(spark):
    lists = spark.createDataFrame([(5, [], []), (3, [], [])], "conv_id long, keys array<binary>, sizes array<long>")
    assert rows_of(with_ends(prefix_trie.build_trie(lists))) == brute({5: [], 3: []})
    assert prefix_trie.build_trie(lists.limit(0)).nodes.count() == 0


def test_digest_lists(spark):
    """Nulls, ties, repeated rows, rows without id, further columns, roles that run into texts."""
    rows = [(1, 2, "b", "c"), (1, None, None, None), (1, 1, "u", "a"), (1, 2, "b", "c"), (2, 0, "", ""), (2, 1, "ua", ""),
            (2, 2, "u", "a"), (None, 0, "u", "a"), (3, 0, "ab", "1:c")]
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], CONVERSATION + ", keys string, size int")
    found = {r["conv_id"]: r for r in prefix_trie.digest_lists(frame).collect()}
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:16]
    assert [bytes(k) for k in found[1]["keys"]] == [digest("", ""), digest("u", "a"), digest("b", "c"), digest("b", "c")]
    assert found[1]["sizes"] == [0, 1, 1, 1] and set(found) == {1, 2, 3}
    assert len(set(map(bytes, found[2]["keys"]))) == 3 and bytes(found[2]["keys"][0]) == bytes(found[1]["keys"][0])
    assert prefix_trie.digest_lists(frame.limit(0)).count() == 0


def test_query_on_rebuilt_conversations(spark, tmp_path):
    """The registered query, from turns to digests; donors that are absent, short or negative."""
    draw = random.Random(4)
    rows = [(c, t, draw.choice(["user", None]), draw.choice(["a", "b", None, "ü"])) for c in draw.sample(range(-30, 400), 250) for t in range(draw.randint(1, 12))]
    spark.createDataFrame(rows, CONVERSATION).write.parquet(f"{tmp_path}/conversations.parquet")
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role or "", text or ""))
    remade = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        remade[c] = own.get(donor, [])[:h] + turns[h:]
    assert rows_of(queries.op13_prefix_trie(spark, str(tmp_path))) == brute(remade)


def test_range_minimum():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 9, 77)
    table = prefix_trie.RangeMinimum(values)
    at, bound = draw.integers(0, 77, 500), draw.integers(0, 9, 500)
    right = [next((x - 1 for x in range(a + 1, 77) if values[x] < b), 76) for a, b in zip(at, bound)]
    left = [next((x for x in range(a, 0, -1) if values[x] < b), 0) for a, b in zip(at, bound)]
    assert table.right(at, bound).tolist() == right and table.left(at, bound).tolist() == left
    first, last = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
    assert table.least(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]
