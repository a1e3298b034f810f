"""Running totals along an order, within groups of any size.

A window over a group would pull the group into one task. Here the rows are sorted by range over all
tasks, totals run within each task's stretch of a group, and what earlier tasks hold of the group is
added on. Only the first group of a task can have begun in an earlier one, so what is passed on is
at most one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowise.plans.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


# How a total is taken over rows, and how totals of two stretches go together.
_KINDS = {"sum": (F.sum, _added), "max": (F.max, F.greatest)}


def running(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], totals: Mapping[str, tuple[str, str]], name: str
) -> DataFrame:
    """Add, per name in ``totals``, the sum or max of a column over the rows of the group up to and with this one.

    ``totals`` maps new names to ("sum" or "max", column). ``order`` must be total within a group: rows that it does
    not tell apart are taken in any order. Nulls count as nothing; null is a group of its own. The
    sorted rows are stored once, so rows and totals come from the same sort even if tasks run again.
    """
    ordered = materialize(df.orderBy(*group, *order).withColumn("_id", F.monotonically_increasing_id()), name)
    rows = ordered.withColumn("_part", F.shiftright("_id", _ROW_BITS))
    stretch = ["_part", *group]
    so_far = Window.partitionBy(*stretch).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({out: _KINDS[kind][0](column).over(so_far) for out, (kind, column) in totals.items()})

    # One row per task and group; those of earlier tasks are left only where a group has such.
    held = rows.groupBy(*stretch).agg(*(_KINDS[kind][0](column).alias(out) for out, (kind, column) in totals.items()))
    held = materialize(held, f"{name}-stretches")
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select(
        F.col("_part").alias("_p"),
        *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)),
        F.count(F.lit(1)).over(before).alias("_tasks"),
        *(_KINDS[kind][0](out).over(before).alias(f"_c_{out}") for out, (kind, _) in totals.items()),
    ).filter("_tasks > 0")
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = local.join(F.broadcast(carried), same, "left")
    whole = {out: _KINDS[kind][1](F.col(out), F.col(f"_c_{out}")) for out, (kind, _) in totals.items()}
    return joined.select(*df.columns, *(c.alias(out) for out, c in whole.items()))
