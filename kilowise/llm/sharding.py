"""Rendezvous hashing of record keys over weighted shards.

Each (key, shard) pair has a fixed pseudo-random number u in (0, 1); a key goes to the
shard with the largest -weight / ln(u). One more shard wins some keys and moves no other.
Everything is a column expression; the only shuffle is the one that numbers the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowise.plans.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below
_HEX = 12  # digits of the digest that are used: 48 bits, exact in a double


def _weight_of(key: Column, shard: int, weight: float) -> Column:
    digest = F.md5(F.concat(key, F.lit(f"#{shard}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double") + 0.5) / float(1 << 4 * _HEX)
    return F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("back"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard (0 ..) of a string key; null counts as the text "null"."""
    key = F.coalesce(key, F.lit("null"))
    best = F.array_max(F.array(*[_weight_of(key, i, w) for i, w in enumerate(weights) if w > 0]))
    return (-best["back"]).cast("int")


def number_rows(df: DataFrame, group: str, order: Sequence[str], out: str) -> DataFrame:
    """Add the 0-based place of each row in its group, without a window over the group.

    The rows are sorted by range over all tasks; each task's share of a group begins where
    the tasks before it ended. The stored table fixes the sort, so that a task that runs again
    sees the same places. Equal rows may take each other's place.
    """
    source = df.withColumn("_from", F.spark_partition_id())
    sort = [group, *order, "_from"]
    ranged = source.repartitionByRange(*sort).sortWithinPartitions(*sort)
    stored = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_id", _ROW_BITS), F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    placed = stored.withColumn("_part", part).withColumn("_row", row)
    # At most one row per group and one more per task: small at any size of the table.
    counts = placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = placed.join(F.broadcast(starts.drop("_n")), ["_part", group])
    return joined.withColumn(out, (F.col("_before") + F.col("_row") - F.col("_first")).cast("long")).drop(
        "_part", "_row", "_first", "_before", "_id", "_from"
    )


def assign_shards(docs: DataFrame, shards: int = 16, weights: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    size: bytes of the text plus 1 (null and empty: 1, their crc is 0). Rows with equal ids go to
    one shard; null ids share one key. An empty table gives an empty one; further columns are left out.
    """
    weights = list(weights or [1.0] * shards)
    key, text = F.col("doc_id").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, sum(weights) / len(weights)]).alias("grown_shard"),
    )
    return number_rows(rows, "shard", ["doc_id", "size", "text_crc32"], "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16, weights: Sequence[float] | None = None) -> None:
    """Store the documents by shard; AQE splits a shard over as many tasks as its size needs."""
    weights = list(weights or [1.0] * shards)
    dealt = docs.withColumn("shard", shard_of(F.col("doc_id").cast("string"), weights))
    dealt.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
