"""Running sums of a stream: each batch stores its own, readers add them up.

Sums do not depend on how the stream was cut into batches, nor on the order of its rows, so late rows
count like all others. A replayed batch replaces what it stored before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kilowise.plans.storage import committed, remove
from kilowise.streaming.sinks import archive_batch

AddUp = Callable[[DataFrame], DataFrame]


def history(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame | None:
    """Partial sums of all batches, or of those up to one: the newest base before it and the batches
    since. Only their folders are listed. None if nothing was stored."""
    batches = committed(spark, f"{root}/stats", "batch_id=")
    if upto is not None:
        batches = [b for b in batches if b <= upto]
    last = batches[-1] if batches else -1
    bases = [b for b in committed(spark, f"{root}/base", "upto=") if b < last]
    since = bases[-1] if bases else -1
    paths = [f"{root}/base/upto={since}"] * bool(bases) + [f"{root}/stats/batch_id={b}" for b in batches if b > since]
    return spark.read.parquet(*paths) if paths else None


def add_batch(sums: DataFrame, batch_id: int, root: str, add_up: AddUp, compact_every: int = 100) -> None:
    """Store the sums of a batch; every ``compact_every`` batches all are added up to a new base, and what
    the base before that one covers is deleted."""
    spark = sums.sparkSession
    archive_batch(sums, batch_id, f"{root}/stats")
    if not batch_id or batch_id % compact_every:
        return
    add_up(history(spark, root, batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{root}/base/upto={batch_id}"
    )
    earlier = [b for b in committed(spark, f"{root}/base", "upto=") if b < batch_id]
    for base in earlier[:-1]:
        remove(spark, f"{root}/base/upto={base}")
    for batch in committed(spark, f"{root}/stats", "batch_id=") if earlier else ():
        if batch <= earlier[-1]:
            remove(spark, f"{root}/stats/batch_id={batch}")
