"""Packing, sharding, archives, outliers, classifier and pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kilowise.llm import attention, outliers, packing, sharding, warc
from kilowise.llm.queries import tokenizer_path
from tests.llm.conftest import DOCUMENT, counted, prose


def test_ids_are_those_of_the_tokenizer(rows):
    from tokenizers import Tokenizer

    odd = ["a  b", "a \n b", " ", "\t a", "<|endoftext|> foo<|endoftext|>", "I'm 's  \n  q", "é　x\u0000y", "😀 " * 50, "\r\n\r\n x", "123 4567"]
    texts = [r[1] or "" for r in rows] + odd
    plain = Tokenizer.from_file(tokenizer_path())
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(packing.token_ids(texts, tokenizer_path())) == want


def test_packing(wide, rows, none):
    found = packing.pack_documents(wide, tokenizer_path(), limit=256, with_ids=True).collect()
    ids = list(packing.token_ids([r[1] or "" for r in rows], tokenizer_path()))
    want = Counter()
    for r, own in zip(rows, ids):
        own = np.append(np.frombuffer(own, "<u4"), 2).astype("<u4")
        first = (len(own) - 1) % 256 + 1
        for piece, at in enumerate([0, *range(first, len(own), 256)]):
            part = own[at : at + 256] if piece else own[:first]
            want[r[0], piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= 1.05 * sum(r["length"] for r in found) / 256 + 2
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_groups_are_packed_apart(docs):
    cut = packing.pieces(docs, tokenizer_path(), limit=256)
    found = packing.pack(cut, 256, group_pieces=40).collect()
    assert len({r["sequence_id"] >> 32 for r in found}) > 1
    load = Counter()
    for r in found:
        load[r["sequence_id"]] += r["length"]
    assert max(load.values()) <= 256 and len(found) == cut.count()


def test_sum_of_squares_rule():
    lengths = np.array([700, 600, 600, 424, 424, 324, 300, 100])
    bins, offsets = packing.place(lengths, 1024)
    for b in set(bins):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    assert bins.max() == 3


def test_sharding(wide, rows, none):
    found = sharding.assign_shards(wide).collect()
    assert len(found) == len(rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    by_id, slots = {}, defaultdict(list)
    for r in found:
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(none).count() == 0


def test_shards_by_weight(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = Counter(r["shard"] for r in sharding.assign_shards(df, weights=[1, 2, 0, 1]).collect())
    assert set(n) == {0, 1, 3} and abs(n[1] - 10_000) < 400 and abs(n[0] - 5_000) < 300
    grown = sharding.assign_shards(df).groupBy("shard", "grown_shard").count().collect()
    assert abs(sum(r["count"] for r in grown if r["grown_shard"] == 16) - 20_000 / 17) < 150
    sharding.write_shards(df, str(tmp_path / "shards"), 3)
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().count() == 3


PAGES = "page_id long, url string, html string"


def _pages():
    big = "<p>" + "é" * 700
    rows = [(i, f"http://www.Host{i % 5}.org:80/p/{i % 7}?q={i}#f", f"<html>{prose(i, 20 + i * 4)}</html>") for i in range(40)]
    rows += [(100 + i, "https://same.example.com/", big) for i in range(6)] + [(50 + i, f"http://b.com/{i}", "small") for i in range(3)]
    rows += [(60, None, None), (61, "", ""), (62, "no host", big + "x"), (None, "http://a b.com/ü\r\nX: y", big), (200, "http://c.com", big), (200, "http://c.com", big)]
    rows += [(63, "http://[bad", "x" * 1500), (64, "http://h.com:99999/", "x" * 1500), (65, "http://long.com", prose(9, 60_000)), (None, "z.com", "y" * 2000)]
    return rows


def test_archives(spark, tmp_path):
    rows = _pages()
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], PAGES + ", digest string, key string").repartition(3)
    found = warc.archive_and_read_back(df, str(tmp_path / "w"))
    keep = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 1000:
            keep[h] = max((x for x in (keep.get(h), p) if x is not None), default=None)
    want = []
    for p, _, h in rows:
        h = (h or "").encode()
        other = len(h) >= 1000 and keep[h] is not None and p != keep[h]
        want.append((p, len(h), hashlib.sha1(h).hexdigest(), "revisit" if other else "response", keep[h] if other else None))
    want.sort(key=lambda r: [(x is not None, x) for x in r])
    assert counted(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want
    assert warc.archive_and_read_back(df.limit(0), str(tmp_path / "none")).count() == 0


def test_index_blocks_and_lookup(spark, tmp_path):
    """Small blocks: a key over many blocks, keys that are not there, each found by binary search."""
    rows = [(i, "http://hot.com/" if i % 3 else f"http://h{i}.com/", f"page {i}") for i in range(120)]
    chosen = warc.choose_records(spark.createDataFrame(rows, PAGES).repartition(4))
    captures = warc.write_archives(chosen, str(tmp_path / "a"))
    directory = warc.write_index(captures, str(tmp_path / "i"), block_lines=5)
    assert directory.count() >= 24
    urls = spark.createDataFrame([("http://hot.com/",), ("http://h30.com",), ("http://nowhere.com/",), (None,)], "url string")
    records = warc.read_records(warc.look_up(spark, urls, directory, str(tmp_path / "i")), str(tmp_path / "a")).collect()
    assert sorted(r["page_id"] for r in records) == [i for i in range(120) if i % 3 or i == 30]
    assert all(bytes(r["payload"]).decode() == f"page {r['page_id']}" for r in records)


def test_surt():
    assert warc.surt("http://www.Example.org:8080/a b?x=1#f") == "org,example,www:8080)/a%20b?x=1"
    assert warc.surt(None) == warc.surt("") == "" and warc.surt("https://e.com:443") == "com,e)/"


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    many = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if many[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered)


def test_outlier_counts(wide, rows, none):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in rows:
        c = _counts(r[1])
        want.append((r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    want.sort(key=lambda r: [(x is not None, x) for x in r])
    found = outliers.judge(wide)
    assert counted(found, *columns) == want
    assert found.filter("base_failed and kept").count() == 0
    assert outliers.judge(none).count() == 0


def test_outliers_of_a_group(spark):
    """A tenth of junk in one group does not hide itself; small groups are judged together."""
    rows = [(i, prose(i, 60 + i % 90), "en" if i < 300 else "de", "s" if i < 300 else f"t{i % 9}", None) for i in range(420)]
    rows += [(1000 + i, prose(i, 100).replace(" ", " | "), "en", "s", None) for i in range(30)]
    rows += [(2000 + i, " ".join(w + "xxxxxxxxxxxx" for w in prose(i, 100).split()), "de", "t1", None) for i in range(5)]
    kept = {r["doc_id"]: r["kept"] for r in outliers.judge(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert all(kept[i] for i in range(420)) and not any(v for k, v in kept.items() if k >= 1000)


def _unrepeated(seed, n):
    return [f"{w}{k % 7}{chr(97 + k % 26)}" for k, w in enumerate(re.findall(r"\w+", prose(seed, n)))]


def _judged(spark, texts):
    rows = [(i, text, lang, source, None) for i, (text, lang, source) in texts.items()]
    found = {r["doc_id"]: r for r in outliers.judge(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert len(found) == len(texts) and not any(r["base_failed"] or r["d2"] is None for r in found.values())
    return {i for i, r in found.items() if not r["kept"]}


def test_every_row_is_judged(spark):
    """Junk of small groups is judged by its language or all rows, and of a table that is small itself."""
    large = {i: (" ".join(_unrepeated(i, 60 + i % 90)), "en", "s") for i in range(300)}
    small = {400 + i: (" ".join(_unrepeated(i, 80 + i)), ("en", "fr")[i % 2], f"rare{i % 7}") for i in range(40)}
    small |= {1000 + i: (" ".join(f"{w}xxxxxxxxxxxx" for w in _unrepeated(i, 100)), ("en", "fr")[i % 2], f"rare{i}") for i in range(4)}
    assert _judged(spark, large | small) == set(range(1000, 1004))
    assert _judged(spark, small) == set(range(1000, 1004))


def test_repeated_lines_and_words_are_outliers(spark):
    """In a group that has none of either."""
    texts = {i: (" ".join(_unrepeated(i, 100 + i % 90)), "en", "s") for i in range(200)}
    texts |= {1000 + i: ("\nonce\n".join([*_unrepeated(i, 29), " ".join(_unrepeated(i + 9, 100))]), "en", "s") for i in range(3)}
    texts |= {2000 + i: (" ".join([*_unrepeated(i, 44) * 2, *_unrepeated(i + 9, 160)[44:]]), "en", "s") for i in range(3)}
    assert _judged(spark, texts) == {*range(1000, 1003), *range(2000, 2003)}


def test_classifier_learns_passages(spark, none):
    """Bags are bad for one junk passage; half of the labels teach, the held-out ones are right."""
    bad = " ".join(w.upper() + "!!" for w in prose(77, 70).split())
    rows = [(i, f"{prose(i, 150)} {bad if i % 3 == 0 else prose(i + 5000, 70)} {prose(i + 900, 100)}", None, None, None) for i in range(240)]
    rows += [(500, None, None, None, None), (501, "", None, None, None), (None, "x", None, None, None)]
    labels = [(i, int(i % 3 != 0), 0) for i in range(240)] + [(5, None, 0), (None, 1, 0), (7, 1, 1), (9999, 0, 0)]
    df = spark.createDataFrame(rows, DOCUMENT).selectExpr("*", "1 as score", "2 as predicted", "3 as bag")
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in attention.classify(df, given).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i]["held_out"] == (i in held) for i in range(240))
    assert np.mean([found[i]["predicted"] == (i % 3 != 0) for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values()) and len(found) == 243
    assert attention.classify(none, given).count() == 0
    alone = attention.classify(df, given.limit(0)).select("score").distinct().collect()
    assert [r["score"] for r in alone] == [0.5]


def test_gradients():
    x, begins = attention.passages(pa.array([prose(1, 200), "", prose(2, 90), None]))
    y = np.array([1.0, 0.0, 0.0, 1.0])
    model = attention.Model(x.mean(0).astype(float), x.std(0) + 0.1, 0.5)

    def loss():
        p = model.forward(x.astype(float), begins)["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = model.gradients(model.forward(x.astype(float), begins), begins, y)
    for name, value in model.p.items():
        at = np.unravel_index(np.argmax(np.abs(found[name])), value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(found[name][at], rel=1e-3, abs=1e-8), name
