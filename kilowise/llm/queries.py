"""The queries of this package, by name, and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowise.llm import (
    attention,
    cost_packing,
    decontaminate,
    jaccard,
    oracle,
    outliers,
    packing,
    prefix_trie,
    secrets,
    sharding,
    squares,
    substrings,
    suffix_array,
    warc,
)

BPE = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE)


def op1_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read_back(table(spark, folder, "pages")).drop("url_key")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_documents(table(spark, folder, "documents"))


def op4_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op5_attention(spark: SparkSession, folder: str) -> DataFrame:
    return attention.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def op7_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op8_shard(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"))


def op9_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judge(table(spark, folder, "documents"))


def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_passages(table(spark, folder, "documents")).drop("kept")


def op11_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    return cost_packing.pack_by_cost(table(spark, folder, "documents"), tokenizer_path())


def repeated_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the CRC of its id, goes on with one period from some word on."""
    g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
    n = len(words)
    if doc_id is None or chosen or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def op12_squares(spark: SparkSession, folder: str) -> DataFrame:
    found = squares.find_runs(table(spark, folder, "documents"), reword=repeated_words)
    # Greater exponents first, as fractions; the runs come by start, then period.
    best = F.expr(
        """element_at(array_sort(runs, (x, y) -> CASE WHEN x.length * y.period <> y.length * x.period
               THEN if(x.length * y.period > y.length * x.period, -1, 1)
               WHEN x.start <> y.start THEN if(x.start < y.start, -1, 1)
               ELSE CAST(x.period - y.period AS INT) END), 1)"""
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    digests = [F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    top = F.when(F.size("runs") > 0, best)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("r"), *digests)
    return rows.select(
        "doc_id", "n_runs", "r.start", "r.length", "r.period", F.expr("1000 * r.length div r.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def rebuilt(lists: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Each conversation begins with the first turns of the first one of its family, some by the CRC of its id."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    donors = lists.select(F.col("conv_id").alias("_donor"), F.col("keys").alias("_keys"), F.col("sizes").alias("_sizes"))
    joined = lists.join(donors, F.col("conv_id") - F.col("conv_id") % family == F.col("_donor"), "left")

    def spliced(own: str, head: str):
        empty = F.array().cast(lists.schema[own].dataType)
        return F.concat(F.coalesce(F.slice(head, F.lit(1), h), empty), F.slice(own, h + 1, F.size(own))).alias(own)

    return joined.select("conv_id", spliced("keys", "_keys"), spliced("sizes", "_sizes"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    trie = prefix_trie.build_trie(rebuilt(prefix_trie.digest_lists(table(spark, folder, "conversations"))))
    ends = prefix_trie.digest_of_ids(trie.members)
    nodes = trie.nodes.join(ends, "class_id", "left").drop("class_id")
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_index,
        op2_decontaminate,
        op3_secrets,
        op4_suffix_array,
        op5_attention,
        op6_ngram_jaccard,
        op7_pack,
        op8_shard,
        op9_outliers,
        op10_substrings,
        op11_cost_packing,
        op12_squares,
        op13_prefix_trie,
    )
}

# Decoding, learning, tokenising and robust estimates have no SQL form; tests hold the other queries
# against brute force.
ORACLE = {
    "op1_warc_index": oracle.WARC,
    "op2_decontaminate": oracle.DECONTAMINATE,
    "op4_suffix_array": oracle.SUFFIXES,
    "op6_ngram_jaccard": oracle.JACCARD,
    "op8_shard": oracle.SHARD,
    "op10_substrings": oracle.SUBSTRINGS,
    "op12_squares": oracle.SQUARES,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
