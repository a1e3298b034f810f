"""Join of points with all intervals that they lie in, by a sweep.

A join on the key with a condition on the time would pair every point of a key with every interval of it.
Here points and borders of intervals are sorted together by range over all tasks. Points with no border between
them are a segment, and segments are numbered along the order. So a point has the number of its segment, and an
interval is the stretch of numbers between its borders; a segment has points, so an interval is paired with none that gives
no row. The work is in proportion to points, intervals and rows of the result, and no key is
gathered in a task: segments with very many points or intervals are split by the last join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilowise.plans.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def interval_join(points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, key: str) -> DataFrame:
    """Every point with each interval of its key for which start <= at < end; a null end is open.

    Rows as of an inner join: all columns of the points, then those of the intervals but the key. Points without time
    or key, and intervals without start or key, or that end before they begin, give no row. Repeated rows on both
    sides count as often as they are there. No other column may be in both frames. All columns of the points are
    sorted, stored and shuffled, so give it those that are needed.
    """
    kept = intervals.filter(F.col(start).isNotNull() & F.col(key).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    kept = materialize(kept.withColumn("_interval", F.monotonically_increasing_id()), "intervals")
    time = points.schema[at].dataType

    def border(column: str) -> DataFrame:
        return kept.select(key, F.col(column).cast(time).alias("_at"), "_interval")

    # An open end is the last border of its key. At the same time borders come first; the tie lets a range end between points.
    rest = [c for c in points.columns if c not in (key, at)]
    timed = points.filter(F.col(at).isNotNull() & F.col(key).isNotNull()).select(
        key, F.col(at).alias("_at"), F.monotonically_increasing_id().alias("_tie"), *rest
    )
    merged = timed.unionByName(border(start).unionByName(border(end)), allowMissingColumns=True)
    ordered = merged.orderBy(key, F.asc_nulls_last("_at"), F.asc_nulls_last("_interval"), "_tie").withColumn("_id", F.monotonically_increasing_id())

    # A point begins a segment unless the row before it is a point of the same key. A segment that goes on in a later
    # task is cut there; each part of it has points, so no pair is made that gives no row.
    along = Window.partitionBy("_part").orderBy("_id")
    is_point = F.col("_interval").isNull()
    begins = is_point & ~F.lag(F.when(is_point, F.col(key))).over(along).eqNullSafe(F.col(key))
    swept = ordered.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn("_begins", begins.cast("long"))
    swept = swept.withColumn("_number", F.sum("_begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # Stored once, so that numbers and totals are of the same sort even if tasks run again.
    swept = materialize(swept.drop("_tie", "_id", "_begins"), "sweep")

    # One row per task.
    totals = swept.groupBy("_part").agg(F.max("_number").alias("_n"))
    earlier = totals.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_earlier"))
    numbered = swept.join(F.broadcast(earlier), "_part").withColumn("_segment", F.col("_earlier") + F.col("_number"))
    inside = numbered.filter(is_point).select("_segment", *(F.col("_at").alias(at) if c == at else F.col(c) for c in points.columns))

    spans = numbered.filter(~is_point).groupBy("_interval").agg(F.min("_segment").alias("_before"), F.max("_segment").alias("_last"))
    carried = kept.select("_interval", *(c for c in intervals.columns if c != key))
    named = spans.filter("_before < _last").join(carried, "_interval")
    named = named.withColumn("_segment", F.explode(F.sequence(F.col("_before") + 1, F.col("_last"))))
    # Stored, so that the join with the points has plain shuffles on both sides and can be split.
    named = materialize(named.drop("_interval", "_before", "_last"), "intervals-by-segment")
    return inside.join(named, "_segment").drop("_segment")
