"""The similarity join and the components against brute force."""

from __future__ import annotations

import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from kilowise.llm import jaccard
from kilowise.llm.components import connected_components
from kilowise.plans.storage import materialize
from tests.llm.conftest import counted, edited, prose

COLUMNS = ("doc_id", "n_shingles", "component_id")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def by_hand(rows, percent=85, k=4):
    sets = [_set(r[1], k) for r in rows]
    least = [r[0] for r in rows]
    linked = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    moved = True
    while moved:
        moved = False
        for i, j in linked:
            both = [x for x in (least[i], least[j]) if x is not None]
            if both and (least[i] != min(both) or least[j] != min(both)):
                least[i] = least[j] = min(both)
                moved = True
    return sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets, least)), key=lambda r: [(x is not None, x) for x in r])


def test_near_sets_share_a_kept_key():
    """For sets at the threshold, whatever keys each leaves out, one that both keep is left."""
    draw = np.random.default_rng(4)
    for _ in range(300):
        percent = int(draw.choice([50, 70, 80, 85, 95]))
        n = int(draw.integers(1, 400))
        x = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        k = len(x) * percent // 100 if draw.random() < 0.5 else int(draw.integers(1, len(x) + 1))
        y = np.unique(np.concatenate((draw.choice(x, k, replace=False), draw.integers(0, 2**64, int(draw.integers(0, 1 + n // 6)), dtype=np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both):
            continue
        left = []
        for own in (x, y):
            left.append([(spare, set(keys.tolist())) for spare, keys in jaccard.segment_keys(own, percent)])
        best = max(len(a & b) - sa - sb for sa, a in left[0] for sb, b in left[1])
        assert best >= 1


def test_components_of_documents(wide, rows):
    want = by_hand(rows)
    assert sum(c is not None and d is not None and c < d for d, _, c in want) > 5
    assert counted(jaccard.jaccard_components(wide), *COLUMNS) == want


@pytest.mark.parametrize("block, percent", [(3, 85), (1024, 60)])
def test_blocks_and_thresholds(spark, block, percent, monkeypatch):
    """Chains of edits: links at and about the threshold, in groups of many blocks."""
    monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df: df)
    rows, text = [], prose(5, 90)
    for i in range(40):
        rows.append((1000 - i, text, "en", "s", 1))
        text = edited(text, i, 1 + i % 4)
    rows += [(i, edited(prose(6, 25), i, i % 3), "en", "s", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert counted(jaccard.jaccard_components(df, percent=percent, block=block), *COLUMNS) == by_hand(rows, percent)


def _work_tables(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), spark.sparkContext.applicationId)
    return {x.name for x in base.iterdir()} if base.exists() else set()


def test_sets_go_to_their_blocks_in_rounds(spark, monkeypatch):
    """A group of many blocks, whose sets are sent a few pairs at a time; what was counted on the way is deleted."""
    monkeypatch.setattr(jaccard, "SENT_PERCENT", 100)
    rows, text = [], prose(7, 90)
    for i in range(40):
        rows.append((500 - i, text, "en", "s", 1))
        text = edited(text, i, 1 + i % 4)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = _work_tables(spark)
    assert counted(jaccard.jaccard_components(df, block=4), *COLUMNS) == by_hand(rows)
    made = [x.rpartition("-")[0] for x in _work_tables(spark) - before]
    assert made.count("links") > 2
    assert not {"shared-keys", "keys", "least-keys", "frequent", "rarest"} & set(made)


def test_rare_shingles_stay_rare_among_many(spark, monkeypatch):
    """Neighbours share a third of their words, more shingles than the least filter has bits. Each has enough that no
    other has, so none of them are candidates."""
    monkeypatch.setattr(jaccard, "LEVEL_BITS", 1 << 16)
    n = 40
    passages = [" ".join(f"p{i}x{k}" for k in range(3300)) for i in range(n + 1)]
    texts = [f"{passages[i]} {' '.join(f'u{i}x{k}' for k in range(3300))} {passages[i + 1]}" for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = jaccard._sets(docs, 4).withColumnRenamed("doc_id", "node").select("node", "s1", "s2")
    found = jaccard._by_rarest(docs, materialize(members, "members"), 4, 85)
    assert jaccard._groups(found).count() == 0


def test_numbers_counted_over_ranges(monkeypatch):
    """However they come, numbers that occur more than once are counted, and no others."""
    draw = np.random.default_rng(8)
    numbers = draw.integers(0, 1 << 64, 700, dtype=np.uint64)
    numbers[:100] = numbers[0] + np.arange(100, dtype=np.uint64)  # many of a range
    drawn = numbers[draw.integers(0, 700, 1500)]
    for held in (5, 200, 1 << 19):
        monkeypatch.setattr(jaccard, "HELD", held)
        packed = [b for a in np.array_split(drawn, 3) for b in jaccard._packed(iter([*np.array_split(a, 40), a[:0]]))]
        rows = pa.Table.from_batches(packed).sort_by("range")
        found = pa.Table.from_batches(jaccard._unpacked(iter(rows.to_batches(max_chunksize=7))))
        values, n = np.unique(drawn & np.uint64((1 << 44) - 1), return_counts=True)
        assert sorted(zip(*(found[c].to_pylist() for c in ("key", "n")))) == list(zip(values[n > 1].tolist(), n[n > 1].tolist()))
    assert not list(jaccard._packed(iter([numbers[:0]])))


def test_stored_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_(\d+)_", disk.getAllFiles().mkString(" ")))

    before = shuffles()
    stored = materialize(spark.range(1000).repartition(3, "id").groupBy("id").count().repartition(2), "numbers")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and stored.count() == 1000


def test_one_of_each(docs, rows, none):
    found = sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect() if r["doc_id"] is not None)
    want = sorted(d for d, n, c in by_hand(rows, 80, 5) if d is not None and (n == 0 or d == c))
    assert found == want
    assert jaccard.one_of_each(docs).columns == docs.columns
    assert jaccard.one_of_each(none).count() == 0


def test_path_graph(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100), (200, 150), (150, 180), (180, 200)]
    found = dict(connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 150: 150, 180: 150, 200: 150}


@pytest.mark.parametrize("fragment", [7, 100, 1 << 19])
@pytest.mark.parametrize("half", [0, 9])
def test_overlaps_are_summed_over_fragments(monkeypatch, fragment, half):
    """However the order is cut, the links connect the sets that brute force connects."""
    monkeypatch.setattr(jaccard, "FRAGMENT", fragment)
    draw = np.random.default_rng(fragment + half)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    rows = []
    for i in range(25):
        own = base[draw.random(40) < 0.9] if i % 3 else draw.integers(0, 1 << 63, 20, dtype=np.uint64)
        rows.append((100 - i, np.unique(own)))
    sets = {node: set(own.tolist()) for node, own in rows}
    nodes = [node for node, _ in rows]
    pairs = [(a, b) for i, a in enumerate(nodes) for j, b in enumerate(nodes) if i < j and (not half or i < half <= j)]
    want = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 70 * len(sets[a] | sets[b])]
    found = list(jaccard._links_between(rows, half, 70))
    assert set(found) <= set(want) and len(want) > len(found) > 5

    def groups(links):
        label = {n: n for n in nodes}
        for _ in nodes:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert groups(found) == groups(want)
