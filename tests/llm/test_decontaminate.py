"""Benchmark windows in documents against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from kilowise.llm import decontaminate as d
from tests.llm.conftest import DOCUMENT, counted, prose

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def by_hand(rows, items, window=10):
    windows = {}
    for name, text in items:
        w = _words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(str(name) if name is not None else "null")
    out = []
    for r in rows:
        w, hit, found = _words(r[1]), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def _items(rows):
    passage = prose(1, 60)
    return [(1, passage), (2, passage[5:120]), (10, "two words"), (3, None), (4, " .,! "), (None, rows[3][1][:150]), (5, "ONE"),
            (6, "the the the the the the the the the the"), (6, prose(500, 30)), (7, "a a a a a a a a a a a a")]


def test_documents(spark, wide, rows, none):
    items = _items(rows)
    df = spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(rows, items)
    assert counted(d.find_contamination(wide, df), *COLUMNS) == want
    assert counted(d.find_contamination(wide, df, shard_words=20), *COLUMNS) == want
    assert d.find_contamination(none, df).count() == 0
    clean = d.find_contamination(wide, df.limit(0))
    assert clean.filter("contaminated or n_items > 0").count() == 0 and clean.count() == len(rows)


def test_random_words_of_a_small_vocabulary(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("ab") for _ in range(draw.randrange(60))), None, None, None) for i in range(60)]
    items = [(i, " ".join(draw.choice("ab") for _ in range(draw.randrange(1, 14)))) for i in range(6)]
    found = d.find_contamination(spark.createDataFrame(rows, DOCUMENT), spark.createDataFrame(items, "item_id long, text string"), 6)
    assert counted(found, *COLUMNS) == by_hand(rows, items, 6)


def test_cut(spark, wide):
    leak = prose(900, 14)
    rows = [(1, f"Before it. {leak} After it!"), (2, leak), (3, "Nothing here."), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "1 as n_words", "2 as spans", "doc_id", "3 as _kept")
    out = d.decontaminate(df, spark.createDataFrame([(1, leak)], "item_id long, text string"), max_coverage=0.8)
    assert out.columns == df.columns
    found = {r["doc_id"]: (r["text"], r["n_words"], r["spans"]) for r in out.collect()}
    assert found[3][0] == "Nothing here." and 2 not in found and found[4][0] == ""
    assert found[1][0].startswith("Before it.") and found[1][0].endswith("After it!") and leak[:40] not in found[1][0]
    assert all(v[1:] == (1, 2) for v in found.values())
    assert set(d.decontaminate(wide, df.selectExpr("doc_id as item_id", "text").limit(0)).columns) == set(wide.columns)
