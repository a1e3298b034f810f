"""Meter fleet: hierarchy, health and benchmark reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.functions.columns import DateLike, day_of, mean_of, to_date_value
from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize


def meter_hierarchy(m: DataFrame) -> DataFrame:
    """Depth of every meter below a root (a meter without parent).

    Each round doubles the distance a meter looks up the tree, so a tree of depth d
    takes log2(d) joins. Meters whose chain ends nowhere or runs in a circle never
    reach a root and are left out.
    """
    # jump: ancestor looked at next; depth: steps made so far; jump NULL = at a root.
    state = m.select(
        "meter_id",
        F.col("parent_meter_id").alias("jump"),
        F.col("parent_meter_id").isNotNull().cast("bigint").alias("depth"),
    )
    state = materialize(state, "meter-tree")
    open_rows = state.filter("jump IS NOT NULL").count()
    while open_rows:
        up = state.select(
            F.col("meter_id").alias("jump"), F.col("jump").alias("_jump"), F.col("depth").alias("_depth")
        )
        done = state.filter("jump IS NULL")
        # The inner join drops meters whose ancestor does not exist.
        moved = (
            state.filter("jump IS NOT NULL")
            .join(up, "jump")
            .select("meter_id", F.col("_jump").alias("jump"), (F.col("depth") + F.col("_depth")).alias("depth"))
        )
        state = materialize(done.unionByName(moved), "meter-tree")
        left = state.filter("jump IS NOT NULL").count()
        if left == open_rows:
            break  # nothing moved to a root or fell off: only circles remain
        open_rows = left
    return state.filter("jump IS NULL").select("meter_id", "depth")


def meter_hierarchy_count(m: DataFrame) -> DataFrame:
    return meter_hierarchy(m).agg(F.count(F.lit(1)).alias("n_meters"))


def meter_health(m: DataFrame, r: DataFrame, as_of: DateLike) -> DataFrame:
    """State of each active meter; readings shrink to one row per meter first."""
    stats = r.groupBy("meter_id").agg(
        F.max(day_of("reading_ts")).alias("_last"),
        (mean_of(F.sum("kwh_usage"), F.count("kwh_usage")) * 24).alias("_daily"),
    )
    age = F.datediff(F.lit(to_date_value(as_of)), "_last")
    days = F.col("days_since_last_reading")
    status = (
        F.when(days.isNull(), "NO_READINGS")
        .when(days > 7, "INACTIVE")
        .when(F.col("_daily") < 0.5, "LOW_USAGE")
        .when(F.col("_daily") > 50, "HIGH_USAGE")
        .otherwise("HEALTHY")
    )
    severity = F.when(days.isNull(), 1).when(days > 7, 2).otherwise(3)
    return (
        m.filter("is_active")
        .select("meter_id", "customer_id")
        .join(stats, "meter_id", "left")
        .select(
            "meter_id",
            "customer_id",
            age.alias("days_since_last_reading"),
            F.round("_daily", 4).alias("avg_daily_consumption"),
            "_daily",
        )
        .withColumn("health_status", status)
        .orderBy(severity, days.desc_nulls_first(), "meter_id")
        .drop("_daily")
    )


def meter_type_benchmark(r: DataFrame, m: DataFrame) -> DataFrame:
    """Readings, customers and spread per meter type, with a total row.

    Means and deviation come from sums per meter. Distinct readings need the ids, so
    only (meter, reading id) goes through the join with the meter types.
    """
    x, pf = F.col("kwh_usage"), F.col("power_factor")
    per_meter = r.groupBy("meter_id").agg(
        F.count(x).alias("n"),
        F.sum(x).alias("s1"),
        F.sum(x * x).alias("s2"),
        F.count(pf).alias("n_pf"),
        F.sum(pf).alias("s_pf"),
    )
    kinds = m.select("meter_id", "meter_type", "customer_id")
    n, s1 = F.sum("n"), F.sum("s1").cast("double")
    variance = F.try_divide(F.sum("s2").cast("double") - F.try_divide(s1 * s1, n), n - 1)
    total = F.grouping("meter_type").alias("_total")
    stats = (
        per_meter.join(kinds, "meter_id")
        .rollup("meter_type")
        .agg(
            total,
            F.count_distinct("customer_id").alias("customers_served"),
            mean_of(F.sum("s1"), n).alias("avg_usage"),
            F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("usage_volatility"),
            mean_of(F.sum("s_pf"), F.sum("n_pf")).alias("avg_power_factor"),
        )
    )
    # Distinct readings of each type, and of all from what is left of them.
    typed = (
        r.select("meter_id", "reading_id")
        .join(broadcast_if_small(m.select("meter_id", "meter_type")), "meter_id")
        .filter("reading_id IS NOT NULL")
        .select("meter_type", "reading_id")
        .distinct()
    )
    counted = F.count(F.lit(1)).alias("readings_count")
    by_type = typed.groupBy("meter_type").agg(counted).withColumn("_total", F.lit(0))
    of_all = typed.select("reading_id").distinct().agg(counted)
    ids = by_type.unionByName(of_all.withColumns({"meter_type": F.lit(None).cast("string"), "_total": F.lit(1)}))
    same = stats["meter_type"].eqNullSafe(ids["meter_type"]) & (stats["_total"] == ids["_total"])
    return (
        stats.join(ids, same)
        .select(
            stats["meter_type"],
            "readings_count",
            "customers_served",
            "avg_usage",
            "usage_volatility",
            "avg_power_factor",
        )
        .orderBy(F.asc_nulls_last("meter_type"))
    )
