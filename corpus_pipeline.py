"""The corpus pipeline: stages over ``documents``, each one of the operators of kilowise.llm.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns is
stored before the next one reads it. All but the last return the columns of ``documents``.

Null, empty and very long texts, ties, repeated rows, empty tables and further columns have the results that the
docstring of a stage's operator states: ``attention.keep_good``, ``jaccard.one_of_each``, ``decontaminate.decontaminate``,
``secrets.redact`` and ``packing.pack_documents``. An empty table passes all stages and gives no sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowise.llm import attention, decontaminate, jaccard, packing, secrets
from kilowise.llm.queries import table, tokenizer_path
from kilowise.plans.storage import discard, materialize


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that were changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return attention.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents made of them for the most part go."""
    return _recounted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, give way to a mark; every document stays."""
    return _recounted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: where each piece of each document lies."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", good),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

# The classifier and the decoding of secrets have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder; an empty table gives no sequence."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)  # not the table itself, which is no work folder
    return STAGES[-1][1](spark, docs, sf_dir)
