"""Checks on each arriving reading: high usage and 3-sigma anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilowise.operators.enrich import high_usage_alert
from kilowise.operators.usage import anomaly_at_arrival, flag_3sigma, usage_stats
from kilowise.plans.storage import publish
from kilowise.streaming.sinks import archive_batch, foreach_batch
from kilowise.streaming.sums import add_batch, history

ARRIVAL = ("reading_id",)


def watch_high_usage(
    readings: DataFrame, path: str, checkpoint: str, trigger: dict, limit: float = 1000
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        archive_batch(high_usage_alert(batch, limit), batch_id, path)

    return foreach_batch(readings, handle, checkpoint, trigger)


def _add_up(stats: DataFrame) -> DataFrame:
    return stats.groupBy("customer_id").agg(
        F.sum("n").alias("n"),
        F.sum("s1").cast("decimal(30,4)").alias("s1"),
        F.sum("s2").cast("decimal(38,8)").alias("s2"),
    )


def customer_stats(spark, root: str, upto: int | None = None) -> DataFrame | None:
    """Sums per customer over all stored batches, or those up to one."""
    found = history(spark, root, upto)
    return None if found is None else _add_up(found)


def anomaly_batch(
    batch: DataFrame, batch_id: int, root: str, k: int = 3, compact_every: int = 100, order: Sequence[str] = ARRIVAL
) -> None:
    """Flag each reading of the batch against what had come of its customer by then, as a trigger per row
    would: all earlier batches, and the rows of this one up to and with itself in the ``order`` of arrival. So
    what is flagged does not depend on how the stream is cut.

    ``backfill_anomalies`` judges a whole history by its final statistics instead.
    """
    spark = batch.sparkSession
    earlier = history(spark, root, batch_id - 1)
    if earlier is not None:
        here = batch.select("customer_id").distinct()
        earlier = _stored(_add_up(earlier.join(here, "customer_id", "left_semi")), f"{root}/current", batch_id)
    flagged = anomaly_at_arrival(batch, [F.col(c) for c in order], k, earlier)
    archive_batch(flagged, batch_id, f"{root}/anomalies")
    add_batch(_add_up(usage_stats(batch)), batch_id, root, _add_up, compact_every)


def _stored(stats: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The statistics as a stored table, so that the join with the readings can be split at a
    customer with very many of them."""
    return publish(stats, path, batch_id)


def watch_anomalies(
    readings: DataFrame, root: str, checkpoint: str, trigger: dict, k: int = 3, compact_every: int = 100, order: Sequence[str] = ARRIVAL
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        anomaly_batch(batch, batch_id, root, k, compact_every, order)

    return foreach_batch(readings, handle, checkpoint, trigger)


def watch_statistics(
    readings: DataFrame, root: str, checkpoint: str, trigger: dict, compact_every: int = 100
) -> StreamingQuery:
    """Only keep the sums per customer."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        add_batch(_add_up(usage_stats(batch)), batch_id, root, _add_up, compact_every)

    return foreach_batch(readings, handle, checkpoint, trigger)


def backfill_anomalies(readings: DataFrame, root: str, trigger: dict, k: int = 3) -> None:
    """Two passes over a stored history: sums of all customers, then every reading against them.
    The result is that of one batch job, however the stream is cut."""
    spark = readings.sparkSession
    watch_statistics(readings, root, f"{root}/checkpoint_sums", trigger).awaitTermination()
    found = customer_stats(spark, root)
    if found is None:
        return
    stats = publish(found, f"{root}/final")

    def flag(batch: DataFrame, batch_id: int) -> None:
        archive_batch(flag_3sigma(batch, stats, k), batch_id, f"{root}/anomalies")

    foreach_batch(readings, flag, f"{root}/checkpoint_flags", trigger).awaitTermination()
