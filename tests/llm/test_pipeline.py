"""Every stage on planted cases, and all of them in a row."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import DOCUMENT, edited, prose

SECRET = "password = hunter2hunter2"


def _write(spark, folder):
    leak = prose(900, 40)
    good = [(i, prose(i, 150 + i), "en", "s", 1) for i in range(60)]
    planted = [(100, edited(good[3][1], 1, 2), "en", "s", 1), (101, good[4][1], "en", "s", 1), (102, f"{prose(70, 90)} {leak} {prose(71, 90)}", "en", "s", 1),
               (103, f"{prose(72, 90)} {SECRET} {prose(73, 60)}", "en", "s", 1), (104, leak, "en", "s", 1), (105, None, None, None, None)]
    junk = [(200 + i, " ".join(w.upper() + "!!" for w in prose(300 + i, 120).split()), "en", "s", 1) for i in range(40)]
    df = spark.createDataFrame(good + planted + junk, DOCUMENT)
    df.selectExpr("*", "1 as n", "2 as score").repartition(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return leak


def test_stages(spark, tmp_path):
    leak, folder = _write(spark, str(tmp_path)), str(tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = set(range(60))
    assert not any(k >= 200 for k in kept["quality"]) and clean | {100, 101, 102, 103} <= set(kept["quality"])
    assert clean <= set(kept["near_duplicates"]) and not {100, 101} & set(kept["near_duplicates"])
    assert clean | {102, 103} <= set(kept["decontamination"]) and 104 not in kept["decontamination"]
    assert leak[:50] not in kept["decontamination"][102] and prose(70, 90)[:60] in kept["decontamination"][102]
    assert set(kept["secrets"]) == set(kept["decontamination"]) and SECRET not in kept["secrets"][103]
    assert all(kept["secrets"][i] == prose(i, 150 + i) for i in range(60))
    found = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in found.collect()} == set(kept["secrets"])


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], DOCUMENT).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
