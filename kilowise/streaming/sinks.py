"""Sinks of the streams. Every batch write is a replacement of what that batch
wrote before, so a replayed batch leaves the same files."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kilowise.operators.changes import READING_KEYS, UPDATED_ON_CONFLICT, upsert_readings
from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import (
    committed,
    materialize,
    path_exists,
    publish,
    read_file,
    read_published,
    refresh_mv,
    remove,
    replace_partitions,
    write_file,
)


def archive_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """The batch as Parquet under its own ``batch_id`` folder; an empty one leaves no rows."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "compression", "snappy"
    ).parquet(f"{path}/batch_id={batch_id}")


def read_archive(spark, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def append_lake_stream(
    df: DataFrame,
    path: str,
    fmt: str = "delta",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a lake table, checkpoint beside it unless given."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}/_checkpoints")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


SLOT = "slot"  # partition column of the readings store
HOUR_SLOTS = "yyyy-MM-dd-HH"


def _live_slots(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """slot, version: where the rows of each slot of the store lie."""
    return read_published(spark, f"{path}/slots", before)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The readings store in its last complete state."""
    live = _live_slots(spark, path)
    if live is None:
        raise FileNotFoundError(f"no readings store at {path}")
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    rows = rows.withColumns({SLOT: F.col(SLOT).cast("string"), "version": F.col("version").cast("bigint")})
    return rows.join(live, [SLOT, "version"], "left_semi").drop("version")


def upsert_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str] = READING_KEYS,
    updated_cols: Sequence[str] = UPDATED_ON_CONFLICT,
    order_col: str = "arrival",
    ts: str = "timestamp",
    slot_format: str = HOUR_SLOTS,
) -> None:
    """Merge a batch into a Parquet store, rewriting only the time slots it touches.

    The new state of a slot is written beside the old one, under the number of the batch; a small
    table of slots and versions then makes all of them visible at once. A driver that is lost before leaves
    the old state, and a replay starts from it again. What the batch before replaced is deleted.
    The key must determine the slot. Hour slots keep the rewrite of a short micro-batch small; day
    slots suit backfills.
    """
    spark = batch.sparkSession
    updates = batch.withColumn(SLOT, F.date_format(ts, slot_format))
    columns = [c for c in updates.columns if c != order_col]
    touched = updates.select(SLOT).distinct()
    live = _live_slots(spark, path, batch_id)
    target = updates.select(*columns).limit(0)
    if live is not None:
        schema = updates.select(*columns).schema.add("version", "long")
        stored = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(f"{path}/data")
        span = touched.agg(F.min(SLOT), F.max(SLOT)).first()  # prunes folders; the join below is exact
        stored = stored.filter(F.col(SLOT).between(*span)) if span[0] is not None else stored.limit(0)
        here = live.join(touched, SLOT, "left_semi")
        target = stored.join(here, [SLOT, "version"], "left_semi").select(*columns)
    merged = upsert_readings(target, updates, keys, updated_cols, order_col)
    replace_partitions(merged, f"{path}/data/version={batch_id}", SLOT, sort_by=keys)
    state = touched.withColumn("version", F.lit(batch_id).cast("bigint"))
    if live is not None:
        state = state.unionByName(live.join(touched, SLOT, "left_anti"))
    publish(state, f"{path}/slots", batch_id, keep=3)
    older = [v for v in committed(spark, f"{path}/slots", "v=") if v < batch_id][:-1]
    if older and live is not None:
        replaced = spark.read.parquet(f"{path}/slots/v={older[-1]}").join(live, [SLOT, "version"], "left_anti")
        for row in replaced.toLocalIterator():
            remove(spark, f"{path}/data/version={row['version']}/{SLOT}={row[SLOT]}")


NO_SLOT = "none"  # of rows without time
COMPACT_PARTS = 8


class SlotParts(NamedTuple):
    """Which parts of a slot hold its rows, by the batches that wrote them: after ``batch``, and ``before`` it."""

    batch: int
    parts: list[int]
    before: list[int]


def _slot_parts(spark: SparkSession, path: str, slot: str) -> SlotParts:
    text = read_file(spark, f"{path}/live/{slot}.json")
    if text is None:
        return SlotParts(-1, [], [])
    known = json.loads(text)
    return SlotParts(known["batch"], known["parts"], known["before"])


def append_new(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str],
    ts: str,
    slot_format: str = HOUR_SLOTS,
    order: Sequence[str] = (),
    compact_parts: int = COMPACT_PARTS,
) -> None:
    """Append the rows whose key is not stored yet, of each key the first by ``order`` (none: by all columns).

    The key must determine the time slot, null being a value like others. A key is looked up in its slot only,
    so the answer does not depend on how late a row comes or how the stream is cut, and a batch reads and lists the
    slots that it touches and nothing else: its cost does not grow with the number of batches before. A slot has a
    small file that names its parts; after ``compact_parts`` parts the next batch that adds to a slot writes it anew as one. A
    replayed batch starts from the parts before it. Parts that no slot file names any more are deleted a batch later.
    """
    spark = batch.sparkSession
    rows = batch.withColumn(SLOT, F.coalesce(F.date_format(ts, slot_format), F.lit(NO_SLOT)))
    columns = rows.columns
    whole = F.struct(*(order or columns), *columns) if order else F.struct(*columns)
    first = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min_by(F.struct(*columns), whole).alias("_row")).select("_row.*")
    # One row per slot of the batch.
    known = {r[SLOT]: _slot_parts(spark, path, r[SLOT]) for r in rows.select(SLOT).distinct().collect()}
    parts = {slot: x.before if x.batch == batch_id else x.parts for slot, x in known.items()}
    folders = [f"{path}/data/part={part}/{SLOT}={slot}" for slot, own in parts.items() for part in own]
    full = [slot for slot, own in parts.items() if len(own) >= compact_parts]
    if folders:
        stored = spark.read.schema(rows.schema).option("basePath", f"{path}/data").parquet(*folders).select(*columns)
        taken = stored.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
        first = first.join(taken, same, "left_anti")
        if full:
            # A full slot to which nothing is added stays as it is.
            grown = broadcast_if_small(materialize(first.filter(F.col(SLOT).isin(full)).select(SLOT).distinct(), "grown-slots"))
            first = first.unionByName(stored.filter(F.col(SLOT).isin(full)).join(grown, SLOT, "left_semi").select(*columns))
    replace_partitions(first, f"{path}/data/part={batch_id}", SLOT, sort_by=keys)
    for slot, own in parts.items():
        if not path_exists(spark, f"{path}/data/part={batch_id}/{SLOT}={slot}"):
            continue  # nothing new
        now = SlotParts(batch_id, [batch_id] if slot in full else [*own, batch_id], own)
        write_file(spark, f"{path}/live/{slot}.json", json.dumps({SLOT: slot, **now._asdict()}) + "\n")
        for part in set(known[slot].before) - {*now.parts, *now.before}:
            remove(spark, f"{path}/data/part={part}/{SLOT}={slot}")


def read_unique(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``append_new`` stored."""
    live = spark.read.schema(f"{SLOT} string, parts array<bigint>").json(f"{path}/live")
    named = live.select(SLOT, F.explode("parts").alias("part"))
    data = f"{path}/data"
    # Names of slots may look like numbers, which they are not.
    columns = [c for c in spark.read.parquet(data).schema if c.name not in (SLOT, "part")]
    rows = spark.read.schema(T.StructType(columns).add(SLOT, T.StringType()).add("part", T.LongType())).parquet(data)
    return rows.join(named, [SLOT, "part"], "left_semi").drop(SLOT, "part")


def foreach_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict,
    name: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands each batch to ``handle``; the batch is kept while it
    runs, so the source is read once however often the batch is used."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = (
        df.writeStream.foreachBatch(run)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    return (writer.queryName(name) if name else writer).start()


def refresh_on_arrival(
    arrivals: DataFrame, build: Callable[[], DataFrame], path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Recompute a stored view whenever a batch of new rows arrives."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            refresh_mv(build, path)

    return foreach_batch(arrivals, handle, checkpoint, trigger)
