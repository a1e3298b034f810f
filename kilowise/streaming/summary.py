"""Jobs over event time.

``watch_daily_summary`` counts every reading whenever it comes and shows open days too. The other
jobs keep their state in bounds by a watermark, for endless streams: a reading may come ``LATENESS`` late,
later ones are left out, so a history is to be read in event-time order or by the batch jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilowise.streaming.sinks import foreach_batch
from kilowise.streaming.sums import add_batch, history

LATENESS = "1 day"


_KEYS = ("window_start", "customer_id")


def _day_sums(enriched: DataFrame, ts: str) -> DataFrame:
    voltage = F.col("voltage")
    return enriched.groupBy(F.date_trunc("day", ts).alias("window_start"), "customer_id").agg(
        F.sum(F.col("kwh_usage").cast("decimal(12,4)")).cast("decimal(30,4)").alias("total_kwh"),
        F.sum(voltage).cast("bigint").alias("voltages"),
        F.count(voltage).alias("n_voltages"),
        F.sum(F.col("cost").cast("decimal(12,4)")).cast("decimal(30,4)").alias("total_cost"),
    )


def _add_up(sums: DataFrame) -> DataFrame:
    totals = [F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("total_kwh", "voltages", "n_voltages", "total_cost")]
    return sums.groupBy(*_KEYS).agg(*totals)


def watch_daily_summary(
    enriched: DataFrame, root: str, checkpoint: str, trigger: dict, ts: str = "timestamp", compact_every: int = 100
) -> StreamingQuery:
    """Keep the sums per customer and day of all readings that have arrived, however late."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        add_batch(_day_sums(batch, ts), batch_id, root, _add_up, compact_every)

    return foreach_batch(enriched, handle, checkpoint, trigger)


def read_daily_summary(spark: SparkSession, root: str) -> DataFrame:
    """Daily customer summary of everything stored so far, open days included."""
    found = history(spark, root)
    if found is None:
        raise FileNotFoundError(f"no daily sums at {root}")
    mean = F.try_divide(F.col("voltages").cast("double"), F.col("n_voltages")).alias("avg_voltage")
    return _add_up(found).select(*_KEYS, "total_kwh", mean, "total_cost")


def stream_daily_summary(
    enriched: DataFrame, delay: str = LATENESS, window: str = "1 day", ts: str = "timestamp"
) -> DataFrame:
    """Daily customer summary over event time; a day is emitted once, when no more
    readings of it are accepted."""
    voltage = F.col("voltage")
    return (
        enriched.withWatermark(ts, delay)
        .groupBy(F.window(ts, window).alias("w"), "customer_id")
        .agg(
            F.sum(F.col("kwh_usage").cast("decimal(12,4)")).alias("total_kwh"),
            F.try_divide(F.sum(voltage).cast("double"), F.count(voltage)).alias("avg_voltage"),
            F.sum(F.col("cost").cast("decimal(12,4)")).alias("total_cost"),
        )
        .select(F.col("w.start").alias("window_start"), "customer_id", "total_kwh", "avg_voltage", "total_cost")
    )


def drop_repeated_readings(
    s: DataFrame, keys: Sequence[str] = ("meter_id", "timestamp"), delay: str = LATENESS, ts: str = "timestamp"
) -> DataFrame:
    """First reading of each key, for append-only tables; keys are remembered for
    the lateness span only."""
    return s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def sliding_counts(
    s: DataFrame, width: str = "1 day", slide: str = "6 hours", delay: str = LATENESS, ts: str = "timestamp", key: str = "customer_id"
) -> DataFrame:
    """window_start, key, n_readings, total_kwh of each window of ``width`` that begins every ``slide``; a window
    is emitted once, when no more readings of it are accepted.

    A reading is added to the one pane (a window of ``slide``) that it lies in. Panes that are closed are added to the
    windows over them: so only panes, not readings, are copied into each of the width / slide windows.
    ``width`` must be a multiple of ``slide``.
    """
    panes = (
        s.withWatermark(ts, delay)
        .groupBy(F.window(ts, slide).alias("pane"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kwh_usage").cast("decimal(12,4)")).alias("kwh"))
    )
    return (
        panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("w"), key)
        .agg(F.sum("n").alias("n_readings"), F.sum("kwh").cast("decimal(30,4)").alias("total_kwh"))
        .select(F.col("w.start").alias("window_start"), key, "n_readings", "total_kwh")
    )


def reading_sessions(s: DataFrame, gap: str = "3 hours", delay: str = LATENESS, ts: str = "timestamp", key: str = "meter_id") -> DataFrame:
    """session_start, last_reading, key, n_readings, total_kwh: stretches of readings of a meter with less than ``gap``
    between them. The state of a session grows with each reading, and a late one that lies between two sessions
    merges their states; a session is emitted once, when no more readings of it are accepted."""
    return (
        s.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n_readings"), F.sum(F.col("kwh_usage").cast("decimal(12,4)")).cast("decimal(30,4)").alias("total_kwh"))
        .select(
            F.col("w.start").alias("session_start"),
            (F.col("w.end") - F.expr(f"interval {gap}")).alias("last_reading"),
            key, "n_readings", "total_kwh",
        )
    )
