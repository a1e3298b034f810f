"""Streaming load: topic -> parse -> enrich -> readings store and lake archive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kilowise.functions.columns import VALID_VOLTAGES, DateLike
from kilowise.operators.changes import (
    READING_KEYS,
    UPDATED_ON_CONFLICT,
    register_new_meters,
)
from kilowise.operators.enrich import enrich, parse_json
from kilowise.plans.sizing import broadcast_if_small
from kilowise.schemas import STREAM_RECORD
from kilowise.streaming.sinks import HOUR_SLOTS, archive_batch, foreach_batch, upsert_batch

# Fixed value: time between micro-batches.
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


@dataclass(frozen=True)
class EtlPaths:
    """Folders of one load, below a root that all executors share."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def enriched_stream(
    raw: DataFrame, peak_rule: str = "evening", schema: T.StructType = STREAM_RECORD
) -> DataFrame:
    """Complete readings with all derived columns; ``arrival`` keeps their order. Offsets order the
    messages of one partition only, so the broker's time comes first and the partition decides ties."""
    placed = raw.withColumn("arrival", F.struct("timestamp", "partition", "offset"))
    return enrich(parse_json(placed, schema, keep=("arrival",)), peak_rule, with_processing_time=True)


FATES = ("kept", "quarantined", "dropped")


def with_fate(readings: DataFrame, customers: DataFrame) -> DataFrame:
    """Add ``fate``: readings of unknown customers are dropped, those that break a constraint of the store
    are quarantined, so that they do not hold up the batch, the others are kept."""
    known = broadcast_if_small(customers.select("customer_id").distinct()).withColumn("_known", F.lit(True))
    sound = F.coalesce(
        F.col("voltage").isin(*VALID_VOLTAGES) & F.col("kwh_usage").isNotNull() & F.col("region").isNotNull(),
        F.lit(False),
    )
    kept, quarantined, dropped = FATES
    fate = F.when(F.col("_known").isNull(), dropped).when(~sound, quarantined).otherwise(kept)
    return readings.join(known, "customer_id", "left").withColumn("fate", fate).drop("_known")


def observe_fates(readings: DataFrame, name: str = "fates") -> DataFrame:
    """Count the fates of each batch while it runs; a ``ProgressLog`` stores the counts."""
    return readings.observe(name, *(F.count_if(F.col("fate") == x).alias(x) for x in FATES))


def load_batch(
    batch: DataFrame,
    batch_id: int,
    customers: DataFrame,
    paths: EtlPaths,
    as_of: DateLike,
    keys: Sequence[str] = READING_KEYS,
    slot_format: str = HOUR_SLOTS,
) -> None:
    """Apply one batch to the store. New meters are registered before readings of unknown customers are dropped.

    A batch that comes without ``fate`` gets it here.
    """
    spark = batch.sparkSession
    judged = batch if "fate" in batch.columns else with_fate(batch, customers)
    meters = spark.read.parquet(paths.meters)
    new = register_new_meters(meters, batch, as_of)
    extra = {f.name: F.lit(None).cast(f.dataType) for f in meters.schema if f.name not in new.columns}
    new.withColumns(extra).select(*[F.col(f.name).cast(f.dataType) for f in meters.schema]).write.mode("append").parquet(
        paths.meters
    )

    def of(fate: str) -> DataFrame:
        return judged.filter(F.col("fate") == fate).drop("fate")

    kept, quarantined, dropped = map(of, FATES)
    archive_batch(dropped.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_rows")), batch_id, paths.dropped)
    archive_batch(quarantined, batch_id, paths.quarantine)
    upsert_batch(kept, batch_id, paths.readings, keys, UPDATED_ON_CONFLICT, slot_format=slot_format)


def run_stream_etl(
    raw: DataFrame,
    customers: DataFrame,
    paths: EtlPaths,
    as_of: DateLike,
    peak_rule: str = "evening",
    trigger: dict = DEFAULT_TRIGGER,
    slot_format: str = HOUR_SLOTS,
    isolated: bool = False,
) -> dict[str, StreamingQuery]:
    """Start the load. The meter table must exist at ``paths.meters``. Kept, quarantined and dropped rows are counted
    on the running batch, under the name "fates".

    One query feeds store and archive from one parsed batch; ``isolated`` starts one for each, with its
    own checkpoint, so that a sink that is down does not hold up the other, at the price of reading twice.
    """
    readings = enriched_stream(raw, peak_rule)
    judged = observe_fates(with_fate(readings, customers))

    def store(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, customers, paths, as_of, slot_format=slot_format)

    def archive(batch: DataFrame, batch_id: int) -> None:
        archive_batch(batch.drop("fate"), batch_id, paths.archive)

    def both(batch: DataFrame, batch_id: int) -> None:
        archive(batch, batch_id)
        store(batch, batch_id)

    handlers = {"store": store, "archive": archive} if isolated else {"load": both}
    return {
        name: foreach_batch(readings if name == "archive" else judged, handle, f"{paths.root}/checkpoint_{name}", trigger)
        for name, handle in handlers.items()
    }


def stop_all(queries: dict[str, StreamingQuery]) -> None:
    for query in queries.values():
        if query.isActive:
            query.stop()


def await_all(queries: dict[str, StreamingQuery]) -> None:
    """Wait until every query ends; if one fails, stop the others and raise."""
    try:
        for query in queries.values():
            query.awaitTermination()
    finally:
        stop_all(queries)
