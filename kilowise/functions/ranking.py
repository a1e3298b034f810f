"""Ranks over groups of any size.

A window ordered over one month, or over the whole table, would pull the group
into one task. Here the rows are sorted by range over all tasks instead, each
row gets its global position, and rank and ntile follow from positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowise.plans.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_position(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``_pos`` (0-based place in the order) and ``_total`` (rows in all).

    ``order`` must be total, so that no run of equal rows lands in one task.
    The sorted rows are stored once: the counts and the rows then come from the
    same sort even if tasks are run again.
    """
    ordered = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", _ROW_BITS)
    # One row per sort partition, so both the window and the broadcast are bounded
    # by the number of shuffle partitions.
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    by_part = Window.orderBy("_part")
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(by_part) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    row = F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_pos", F.col("_offset") + row)
        .drop("_id", "_part", "_offset")
    )


def add_rank_desc(df: DataFrame, group: str, value: str, tie_break: str, out: str) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY value DESC NULLS FIRST).

    Ranks are taken inside each task's stretch of a group and moved on by the rows of the group in
    earlier tasks. Only the first run of equal values of a stretch can have begun in an earlier one: it
    takes the place where its value began, from a table of the stretches' first and last values.
    """
    order = [F.col(group), F.desc_nulls_first(value), F.col(tie_break)]
    stored = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), f"rank-{out}")
    stretch = ["_part", group]
    here = Window.partitionBy(*stretch).orderBy(F.desc_nulls_first(value))
    ranked = stored.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn("_rank", F.rank().over(here))
    # One row per sort partition and one per group.
    ends = ranked.groupBy(*stretch).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("_rank").alias("_last_run"),
        F.min_by(F.struct(value), "_id")[value].alias("_first"),
        F.max_by(F.struct(value), "_id")[value].alias("_last"),
    )
    so_far = Window.partitionBy(group).orderBy("_part")
    ends = materialize(ends.withColumn("_before", F.sum("_n").over(so_far) - F.col("_n")), f"stretches-{out}")
    begun = ends.select(F.col(group).alias("_g"), F.col("_first").alias("_v"), (F.col("_before") + 1).alias("_at")).unionByName(
        ends.select(F.col(group).alias("_g"), F.col("_last").alias("_v"), (F.col("_before") + F.col("_last_run")).alias("_at"))
    )
    begun = begun.groupBy("_g", "_v").agg(F.min("_at").alias("_begun"))
    same_run = F.col(group).eqNullSafe(F.col("_g")) & F.col("_first").eqNullSafe(F.col("_v"))
    ends = ends.join(begun, same_run).select(F.col("_part").alias("_p"), "_g", "_before", "_begun")
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    rank = F.when(F.col("_rank") == 1, F.col("_begun")).otherwise(F.col("_before") + F.col("_rank"))
    return (
        ranked.join(F.broadcast(ends), same)
        .withColumn(out, rank.cast("bigint"))
        .drop("_id", "_part", "_rank", "_p", "_g", "_before", "_begun")
    )


def add_ntile(df: DataFrame, tiles: int, order: Sequence[Column], out: str) -> DataFrame:
    """NTILE(tiles) OVER (ORDER BY order): the first tiles get the extra rows."""
    placed = with_position(df, order, f"ntile-{out}")
    size = F.floor(F.col("_total") / tiles)
    extra = F.col("_total") % tiles
    long_part = extra * (size + 1)
    tile = F.when(
        F.col("_pos") < long_part, F.floor(F.col("_pos") / (size + 1)) + 1
    ).otherwise(extra + F.floor((F.col("_pos") - long_part) / F.greatest(size, F.lit(1))) + 1)
    return placed.withColumn(out, tile.cast("bigint")).drop("_pos", "_total")
