"""Weather reports. Readings and bills are reduced to region-day or region-month
before they meet the weather table, so the join itself is small whatever the
number of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.functions.columns import (
    TEMPERATURE_RANGES,
    DateLike,
    between_midnights,
    count_where,
    day_of,
    mean_of,
    month_of,
    temperature_range,
)
from kilowise.plans.sizing import broadcast_if_small


def usage_weather(r: DataFrame, w: DataFrame, n: int | None = None) -> DataFrame:
    """Readings with the weather of their region and day; ``n`` keeps a preview."""
    weather = w.select("region", F.col("observation_date").alias("_day"), "mean_temp_c", "rainfall_mm")
    out = (
        r.select("reading_ts", "region", "kwh_usage", day_of("reading_ts").alias("_day"))
        .join(broadcast_if_small(weather), ["region", "_day"])
        .drop("_day")
    )
    return out.orderBy("reading_ts", "region", "kwh_usage").limit(n) if n else out


def _join_weather(cells: DataFrame, w: DataFrame) -> DataFrame:
    weather = w.select("region", F.col("observation_date").alias("day"), "mean_temp_c", "rainfall_mm")
    return cells.join(weather, ["region", "day"])


def revenue_vs_weather(b: DataFrame, w: DataFrame) -> DataFrame:
    """Revenue of a month beside the weather of its first day."""
    revenue = b.groupBy("region", F.col("billing_month").alias("day")).agg(
        F.sum("amount_due").alias("_revenue")
    )
    return (
        _join_weather(revenue, w)
        .groupBy("region", F.col("day").alias("observation_date"), "mean_temp_c", "rainfall_mm")
        .agg(F.sum("_revenue").alias("total_revenue"))
        .orderBy("observation_date")
    )


def region_weather_total_usage(r: DataFrame, w: DataFrame, region: str | None = None) -> DataFrame:
    """Weather days with the usage of all regions on that date, NULL when none."""
    usage = r.groupBy(day_of("reading_ts").alias("observation_date")).agg(
        F.sum("kwh_usage").alias("total_usage")
    )
    columns = ["observation_date", "mean_temp_c", "total_usage"]
    days = w if region is None else w.filter(F.col("region") == region)
    if region is None:
        columns = ["region", *columns]
    return days.join(usage, "observation_date", "left").select(*columns)


def weather_impact(
    r: DataFrame,
    w: DataFrame,
    region: str | None = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> DataFrame:
    """Usage by temperature range; without ``region`` each region on its own."""
    rows = r.filter(between_midnights("reading_ts", start, end))
    if region is not None:
        rows = rows.filter(F.col("region") == region)
    cells = rows.groupBy("region", day_of("reading_ts").alias("day")).agg(
        F.sum("kwh_usage").alias("kwh"),
        F.count("kwh_usage").alias("n_kwh"),
        F.count(F.lit(1)).alias("n"),
        count_where(F.col("is_peak_hours")).alias("n_peak"),
    )
    keys = ["temperature_range"] if region is not None else ["region", "temperature_range"]
    share = F.round(F.sum("n_peak") * 100.0 / F.sum("n"), 2)
    avg = mean_of(F.sum("kwh"), F.sum("n_kwh"))
    position = F.array_position(F.array(*[F.lit(x) for x in TEMPERATURE_RANGES]), F.col("temperature_range"))
    return (
        _join_weather(cells, w)
        .withColumn("temperature_range", temperature_range("mean_temp_c"))
        .groupBy(*keys)
        .agg(avg.alias("avg_kwh_usage"), F.sum("n").alias("reading_count"), share.alias("peak_hours_ratio"))
        .withColumn("peak_contribution", F.round(F.col("avg_kwh_usage") * F.col("peak_hours_ratio") / 100, 2))
        .withColumn(
            "offpeak_contribution", F.round(F.col("avg_kwh_usage") * (100 - F.col("peak_hours_ratio")) / 100, 2)
        )
        .orderBy(*keys[:-1], position)
    )


def weather_correlation(r: DataFrame, w: DataFrame) -> DataFrame:
    """Pearson correlation of usage and temperature at reading grain, per region
    and month, from the sums of each region-day."""
    x = F.col("kwh_usage")
    cells = r.groupBy("region", day_of("reading_ts").alias("day")).agg(
        F.count(x).alias("n"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx")
    )
    t, n = F.col("mean_temp_c").cast("decimal(10,4)"), F.col("n")
    sx, sxx = F.col("sx").cast("double"), F.col("sxx").cast("double")
    known = t.isNotNull()
    sums = (
        _join_weather(cells, w)
        .groupBy("region", month_of("day").alias("month"))
        .agg(
            F.sum("sx").alias("all_x"),
            F.sum("n").alias("all_n"),
            F.sum(F.when(known, n)).alias("m"),
            F.sum(F.when(known, sx)).alias("x"),
            F.sum(F.when(known, sxx)).alias("xx"),
            F.sum(n * t).alias("y"),
            F.sum(n * (t * t).cast("double")).alias("yy"),
            F.sum(sx * t.cast("double")).alias("xy"),
        )
    )
    m, sx, sy = F.col("m"), F.col("x"), F.col("y").cast("double")
    cov = F.col("xy") - sx * sy / m
    var_x, var_y = F.col("xx") - sx * sx / m, F.col("yy") - sy * sy / m
    # What rounding leaves of a constant column counts as no variance.
    varies = (var_x > F.col("xx") * 1e-12) & (var_y > F.col("yy") * 1e-12)
    return sums.select(
        "region",
        "month",
        mean_of("all_x", "all_n").alias("avg_daily_usage"),
        F.try_divide(sy, m).alias("avg_temp"),
        F.when(varies, cov / F.sqrt(var_x * var_y)).alias("temp_usage_correlation"),
    ).orderBy(F.abs("temp_usage_correlation").desc_nulls_first())


def energy_weather_daily(r: DataFrame, w: DataFrame) -> DataFrame:
    """Usage per region, day and weather, with the number of customers.

    Customers are counted on one row per customer-day.
    """
    customers = r.groupBy("region", day_of("reading_ts").alias("day"), "customer_id").agg(
        F.sum("kwh_usage").alias("kwh")
    )
    cells = customers.groupBy("region", "day").agg(
        F.sum("kwh").alias("kwh"), F.count("customer_id").alias("customer_count")
    )
    # Two stations with the same weather repeat a region-day but not its customers.
    return (
        _join_weather(cells, w)
        .groupBy("region", "day", "mean_temp_c", "rainfall_mm")
        .agg(F.sum("kwh").alias("total_usage"), F.max("customer_count").alias("customer_count"))
        .withColumn(
            "usage_per_customer", F.try_divide(F.col("total_usage").cast("double"), F.col("customer_count"))
        )
    )


def weather_by_region(w: DataFrame) -> DataFrame:
    return w.groupBy("region").agg(
        F.round(F.avg("rainfall_mm"), 6).alias("avg_rainfall"),
        F.round(F.avg("max_temp_c"), 6).alias("avg_max_temp"),
        F.round(F.avg("min_temp_c"), 6).alias("avg_min_temp"),
    )
