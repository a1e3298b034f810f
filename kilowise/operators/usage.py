"""Usage reports over meter readings.

Every report first reduces the readings to the grain it needs (customer-day,
customer-month, region-day ...). That aggregation combines on the map side, so a
customer or region that holds a third of all readings still reaches the shuffle
as a few rows; joins and windows only see the reduced rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilowise.functions.columns import (
    DateLike,
    between_midnights,
    day_of,
    degree_band,
    hour_of,
    in_month,
    is_peak_reading,
    mean_of,
    month_floor,
    month_of,
    sum_where,
    temp_band,
    within,
)
from kilowise.functions.ranking import add_ntile, add_rank_desc
from kilowise.functions.scan import running
from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize


def usage_customer_profile(r: DataFrame, c: DataFrame, n: int | None = None) -> DataFrame:
    """Readings with the customer's address and tariff; ``n`` keeps a preview."""
    profile = broadcast_if_small(c.select("customer_id", "office_address", "tariff_type"))
    out = r.select("reading_ts", "kwh_usage", "customer_id").join(profile, "customer_id")
    return out.orderBy("reading_ts", "customer_id", "kwh_usage").limit(n) if n else out


def region_filter(r: DataFrame, regions: Sequence[str]) -> DataFrame:
    return r.filter(F.col("region").isin(*regions))


def peak_usage_by_temp_band(r: DataFrame) -> DataFrame:
    return (
        r.filter(is_peak_reading())
        .groupBy(hour_of("reading_ts").alias("hour"), "region", temp_band("temperature_c").alias("temp_band"))
        .agg(F.sum("kwh_usage").alias("total_kwh"))
        .orderBy("hour", "region")
    )


def monthly_usage(r: DataFrame) -> DataFrame:
    return r.groupBy("customer_id", month_of("reading_ts").alias("month")).agg(
        F.sum("kwh_usage").alias("monthly_usage")
    )


def monthly_running_total_rank(r: DataFrame) -> DataFrame:
    """Running total per customer (at most one row per month in a group) and the
    customer's rank among all customers of the month."""
    by_month = Window.partitionBy("customer_id").orderBy("month")
    running = monthly_usage(r).withColumn("running_total", F.sum("monthly_usage").over(by_month))
    return add_rank_desc(running, "month", "monthly_usage", "customer_id", "usage_rank")


def usage_vs_regional_avg(r: DataFrame) -> DataFrame:
    """A region-day may hold every customer, so its mean is aggregated and joined
    back instead of being a window over the group. It is stored, and broadcast if it is small, so that the
    customer-days do not move for the join."""
    daily = r.groupBy("customer_id", "region", day_of("reading_ts").alias("day")).agg(
        F.sum("kwh_usage").alias("daily_usage")
    )
    regional = daily.groupBy("region", "day").agg(
        mean_of(F.sum("daily_usage"), F.count("daily_usage")).alias("regional_avg")
    )
    regional = broadcast_if_small(materialize(regional, "regional-days"))
    return daily.join(regional, ["region", "day"]).select(
        "customer_id",
        "region",
        "day",
        "daily_usage",
        "regional_avg",
        (F.col("daily_usage").cast("double") - F.col("regional_avg")).alias("diff_from_avg"),
    )


def consecutive_month_usage(r: DataFrame, anchor: DateLike) -> DataFrame:
    """Months in an unbroken run from the anchor month on.

    In a run that starts at the anchor, the k-th active month is k-1 months after it.
    """
    first = month_floor(anchor)
    months = monthly_usage(r.filter(within("reading_ts", first)))
    nth = F.row_number().over(Window.partitionBy("customer_id").orderBy("month"))
    offset = F.months_between("month", F.lit(first)).cast("int")
    return (
        months.withColumn("nth", nth)
        .filter(offset == F.col("nth") - 1)
        .drop("nth")
        .orderBy("customer_id", "month")
    )


def anchor_month_usage(r: DataFrame, anchor: DateLike) -> DataFrame:
    return monthly_usage(r.filter(in_month("reading_ts", anchor)))


def number_series(spark: SparkSession, n: int = 5) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


def hourly_peak_by_temp_band(
    r: DataFrame,
    w: DataFrame,
    region: str | None = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> DataFrame:
    """Largest hourly total per temperature band; both dates belong to the span.

    Without ``region`` every region is reported on its own. Weather only decides
    which regions count, as a semi join.
    """
    observed = w.filter(between_midnights("observation_date", start, end)).select("region").distinct()
    span = within("reading_ts", start)
    if end is not None:
        span = span & (F.col("reading_ts") < F.date_add(F.lit(str(end)).cast("date"), 1))
    rows = r.filter(span)
    if region is not None:
        rows = rows.filter(F.col("region") == region)
    hourly = rows.groupBy(
        hour_of("reading_ts").alias("hour"), "region", F.round("temperature_c").alias("rounded_temp")
    ).agg(F.sum("kwh_usage").alias("total_kwh"))
    keys = ["hour", "temp_band"] if region is not None else ["region", "hour", "temp_band"]
    return (
        hourly.join(observed, "region", "left_semi")
        .withColumn("temp_band", degree_band("rounded_temp"))
        .groupBy(*keys)
        .agg(F.max("total_kwh").alias("peak_kwh"))
        .orderBy("hour")
    )


def customer_usage(r: DataFrame) -> DataFrame:
    return r.groupBy("customer_id").agg(F.sum("kwh_usage").alias("total_usage"))


def above_average_customers(r: DataFrame) -> DataFrame:
    """Customers whose total exceeds the mean customer-day."""
    daily = r.groupBy("customer_id", day_of("reading_ts").alias("day")).agg(
        F.sum("kwh_usage").alias("daily_usage")
    )
    mean_day = daily.agg(mean_of(F.sum("daily_usage"), F.count("daily_usage")).alias("m")).scalar()
    totals = daily.groupBy("customer_id").agg(F.sum("daily_usage").alias("total_usage"))
    return totals.filter(F.col("total_usage").cast("double") > mean_day)


def usage_spikes(r: DataFrame, factor: int = 3) -> DataFrame:
    """Readings above ``factor`` times their customer's mean.

    One stored row of sums per customer is joined back, so a large customer is
    never gathered in one task; kwh * n > factor * sum needs no division.
    """
    stats = materialize(
        r.groupBy("customer_id").agg(F.sum("kwh_usage").alias("_sum"), F.count("kwh_usage").alias("_n")),
        "usage-means",
    )
    return (
        r.join(stats, "customer_id")
        .filter(F.col("kwh_usage") * F.col("_n") > F.col("_sum") * factor)
        .select("customer_id", "reading_ts", "kwh_usage")
    )


def usage_stats(r: DataFrame) -> DataFrame:
    """Count, sum and sum of squares of each customer: what mean and standard
    deviation need, and addable over batches."""
    x = F.col("kwh_usage").cast("decimal(12,4)")
    return r.groupBy("customer_id").agg(
        F.count(x).alias("n"), F.sum(x).alias("s1"), F.sum(x * x).alias("s2")
    )


def _limits(n: Column, s1: Column, s2: Column) -> tuple[Column, Column]:
    """Mean and sample standard deviation, both rounded to two decimals; one reading has no deviation."""
    total = s1.cast("double")
    spread = F.try_divide(s2.cast("double") - F.try_divide(total * total, n), n - 1)
    deviation = F.when(n > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0))), 2))
    return F.round(F.try_divide(total, n), 2), deviation


def _above(k: int) -> Column:
    return F.col("kwh_usage").cast("double") > F.col("avg_usage") + k * F.col("_dev")


_FLAGGED = ("customer_id", "reading_id", "reading_ts", "kwh_usage", "avg_usage")


def flag_3sigma(r: DataFrame, stats: DataFrame, k: int = 3) -> DataFrame:
    """Readings above mean + k sample standard deviations of their customer, both
    rounded to two decimals first; a single reading has no deviation."""
    mean, deviation = _limits(F.col("n"), F.col("s1"), F.col("s2"))
    limits = stats.select("customer_id", mean.alias("avg_usage"), deviation.alias("_dev"))
    return r.join(limits, "customer_id").filter(_above(k)).select(*_FLAGGED)


def anomaly_at_arrival(r: DataFrame, order: Sequence[Column], k: int = 3, earlier: DataFrame | None = None) -> DataFrame:
    """Readings above mean + k standard deviations of what had come of their customer by then, themselves included.

    ``order`` is the total order in which readings arrive; ``earlier`` holds the sums (``usage_stats``) of readings
    that came before all of these. Sums run along a range sort, so a customer may hold any share of the readings.
    Readings without customer have no history and are not judged.
    """
    x = F.col("kwh_usage").cast("decimal(12,4)")
    parts = {"_n": x.isNotNull().cast("bigint"), "_s1": x, "_s2": x * x}
    sums = {"n": ("sum", "_n"), "s1": ("sum", "_s1"), "s2": ("sum", "_s2")}
    judged = running(r.filter("customer_id IS NOT NULL").withColumns(parts), ["customer_id"], order, sums, "arrivals")
    if earlier is not None:
        before = earlier.select("customer_id", *(F.col(c).alias(f"_before_{c}") for c in sums))
        judged = judged.join(before, "customer_id", "left")
        whole = {c: F.coalesce(F.col(c) + F.col(f"_before_{c}"), c, f"_before_{c}") for c in sums}
        judged = judged.withColumns(whole)
    mean, deviation = _limits(F.col("n"), F.col("s1"), F.col("s2"))
    return judged.withColumns({"avg_usage": mean, "_dev": deviation}).filter(_above(k)).select(*_FLAGGED)


def usage_anomaly_3sigma(r: DataFrame, k: int = 3) -> DataFrame:
    return flag_3sigma(r, materialize(usage_stats(r), "usage-stats"), k)


def daily_region_usage(r: DataFrame) -> DataFrame:
    return r.groupBy("region", day_of("reading_ts").alias("day")).agg(
        F.sum("kwh_usage").alias("total_usage")
    )


def top_days_per_region(r: DataFrame, k: int = 10) -> DataFrame:
    """The k highest days of each region, ties kept; a group holds one row per day."""
    order = Window.partitionBy("region").orderBy(F.desc_nulls_first("total_usage"))
    return (
        daily_region_usage(r)
        .withColumn("_rank", F.rank().over(order))
        .filter(F.col("_rank") <= k)
        .drop("_rank")
    )


def customer_share_of_region(r: DataFrame) -> DataFrame:
    usage = r.groupBy("customer_id", "region").agg(F.sum("kwh_usage").alias("customer_usage"))
    regions = usage.groupBy("region").agg(F.sum("customer_usage").alias("_region"))
    share = F.try_divide(F.col("customer_usage").cast("double"), F.col("_region").cast("double")) * 100
    # One row per region.
    return usage.join(broadcast_if_small(materialize(regions, "region-totals")), "region").select(
        "customer_id", "region", "customer_usage", share.alias("percent_of_region")
    )


def customers_with_peak_usage(r: DataFrame, c: DataFrame) -> DataFrame:
    """The customer list is made distinct before the join, so a heavy customer
    brings one row."""
    peak = r.filter(is_peak_reading()).select("customer_id").distinct()
    return c.select("customer_id", "office_address").join(peak, "customer_id", "left_semi").distinct()


def usage_for_tariffs(r: DataFrame, c: DataFrame, tariffs: Sequence[str]) -> DataFrame:
    chosen = c.filter(F.col("tariff_type").isin(*tariffs)).select("customer_id")
    return customer_usage(r).join(chosen, "customer_id", "left_semi")


def avg_daily_usage_by_region(r: DataFrame) -> DataFrame:
    return (
        daily_region_usage(r)
        .groupBy("region")
        .agg(mean_of(F.sum("total_usage"), F.count("total_usage")).alias("avg_daily_usage"))
    )


def top_usage_quartile(r: DataFrame) -> DataFrame:
    ranked = add_ntile(
        customer_usage(r), 4, [F.asc_nulls_last("total_usage"), F.col("customer_id")], "percentile"
    )
    return ranked.filter(F.col("percentile") == 4)


def year_over_year_region_avg(r: DataFrame, region: str | None = None) -> DataFrame:
    rows = r if region is None else r.filter(F.col("region") == region)
    yearly = rows.groupBy("region", F.year("reading_ts").alias("year")).agg(
        mean_of(F.sum("kwh_usage"), F.count("kwh_usage")).alias("avg_kwh")
    )
    previous = F.lag("avg_kwh").over(Window.partitionBy("region").orderBy("year"))
    return yearly.withColumn("prev_avg_kwh", previous)


def quarterly_consumption(r: DataFrame) -> DataFrame:
    """Quarter of the year and region; the same quarter of all years is one group."""
    keyed = r.select(F.quarter("reading_ts").alias("quarter"), "region", "kwh_usage")
    return keyed.groupingSets([["quarter", "region"]], "quarter", "region").agg(
        mean_of(F.sum("kwh_usage"), F.count("kwh_usage")).alias("avg_consumption")
    )


def _of_customer(r: DataFrame, customer: object | None) -> DataFrame:
    return r if customer is None else r.filter(F.col("customer_id") == customer)


def daily_consumption_trend(
    r: DataFrame,
    w: DataFrame,
    customer: object | None = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> DataFrame:
    """Usage and weather per customer and day; the span ends at midnight of ``end``.

    The weather mean counts every reading, hence the weights. Several weather rows
    for a region-day repeat the readings, as a join at reading grain would.
    """
    cells = (
        _of_customer(r, customer)
        .filter(between_midnights("reading_ts", start, end))
        .groupBy("customer_id", "region", day_of("reading_ts").alias("reading_date"))
        .agg(
            F.sum("kwh_usage").alias("kwh"),
            sum_where(is_peak_reading(), "kwh_usage").alias("peak"),
            sum_where(~is_peak_reading(), "kwh_usage").alias("off"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    weather = w.select(
        "region", F.col("observation_date").alias("reading_date"), "mean_temp_c", "rainfall_mm"
    )
    temp = F.col("mean_temp_c").cast("decimal(10,4)")
    return (
        cells.join(weather, ["region", "reading_date"], "left")
        .groupBy("customer_id", "reading_date")
        .agg(
            F.sum("kwh").alias("daily_consumption"),
            mean_of(F.sum(temp * F.col("n")), F.sum(F.when(temp.isNotNull(), F.col("n")))).alias("avg_temperature"),
            F.max("rainfall_mm").alias("daily_rainfall"),
            F.sum("peak").alias("peak_consumption"),
            F.sum("off").alias("offpeak_consumption"),
        )
    )


def monthly_consumption_trend(
    r: DataFrame,
    b: DataFrame,
    customer: object | None = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
) -> DataFrame:
    """Usage per customer and month next to what was billed for it."""
    usage = (
        _of_customer(r, customer)
        .filter(between_midnights("reading_ts", start, end))
        .groupBy("customer_id", month_of("reading_ts").alias("_month"))
        .agg(
            F.sum("kwh_usage").alias("monthly_consumption"),
            sum_where(is_peak_reading(), "kwh_usage").alias("peak_consumption"),
            sum_where(~is_peak_reading(), "kwh_usage").alias("offpeak_consumption"),
        )
    )
    billed = (
        _of_customer(b, customer)
        .groupBy("customer_id", F.col("billing_month").alias("_month"))
        .agg(F.sum("amount_due").alias("billed_amount"))
    )
    return usage.join(billed, ["customer_id", "_month"], "left").select(
        "customer_id",
        F.date_format("_month", "yyyy-MM").alias("month"),
        "monthly_consumption",
        "peak_consumption",
        "offpeak_consumption",
        "billed_amount",
    )


def as_json_rows(df: DataFrame, name: str = "row") -> DataFrame:
    """One JSON object per row, the form in which the trend reports are emitted."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def missing_days(r: DataFrame, m: DataFrame) -> DataFrame:
    """Days without a reading between a meter's first and last day.

    The distinct days of a meter, as many as the calendar has, are put in order; only where the
    next one is not the day after, the days between are made.
    """
    days = r.select("meter_id", day_of("reading_ts").alias("day")).filter("day IS NOT NULL").distinct()
    following = F.lead("day").over(Window.partitionBy("meter_id").orderBy("day"))
    gaps = days.withColumn("next", following).filter(F.datediff("next", "day") > 1)
    between = F.sequence(F.date_add("day", 1), F.date_sub("next", 1), F.expr("interval 1 day"))
    return (
        gaps.join(m.select("meter_id", "meter_type"), "meter_id", "left")
        .select("meter_id", F.explode(between).alias("missing_day"), "meter_type")
        .orderBy("meter_id", "missing_day")
    )


def daily_voltage_by_meter(r: DataFrame, ts: str = "reading_ts") -> DataFrame:
    return r.groupBy("meter_id", day_of(ts).alias("day")).agg(
        mean_of(F.sum("voltage"), F.count("voltage")).alias("avg_voltage")
    )


def daily_customer_summary(enriched: DataFrame) -> DataFrame:
    """Energy, voltage and cost of each customer-day, from enriched readings."""
    return enriched.groupBy("customer_id", "date").agg(
        F.sum(F.col("kwh_usage").cast("decimal(12,4)")).alias("total_kwh"),
        mean_of(F.sum("voltage"), F.count("voltage")).alias("avg_voltage"),
        F.sum(F.col("cost").cast("decimal(12,4)")).alias("total_cost"),
    )
