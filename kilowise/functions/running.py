"""Sums before given dates, without pairing every date with every day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sums_around(
    points: DataFrame, at: str, days: DataFrame, day: str, key: str, values: Sequence[str]
) -> DataFrame:
    """Add to each point, per value v of its key's days: ``v_before`` (days before
    the point), ``v_eve`` (the day just before) and ``v_all`` (all days).

    Points and days are merged and summed along the dates of a key, so the work is
    their number, not their product. A key holds at most one row per day and point.
    """
    marks = points.select(
        key, F.col(at).alias("_at"), F.struct(*[c for c in points.columns if c != key]).alias("_point")
    )
    rows = days.select(key, F.col(day).alias("_at"), *values)
    merged = rows.unionByName(marks, allowMissingColumns=True)
    of_key = Window.partitionBy(key)
    # On the same date the point comes first: all rows before it are earlier days.
    in_order = of_key.orderBy("_at", F.col("_point").isNull())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag(F.struct("_at", *values)).over(in_order)
    sums = {f"{v}_before": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}
    sums |= {f"{v}_all": F.coalesce(F.sum(v).over(of_key), F.lit(0)) for v in values}
    placed = merged.withColumns({**sums, "_previous": previous}).filter(F.col("_point").isNotNull())
    is_eve = F.col("_previous._at") == F.date_sub("_at", 1)
    eves = {
        f"{v}_eve": F.coalesce(F.when(is_eve, F.col(f"_previous.{v}")), F.lit(0)) for v in values
    }
    return placed.withColumns(eves).select(key, "_point.*", *sums, *eves)
