"""Customer reports: lookups, masking, payment risk, moves and tariff changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilowise.functions.columns import (
    DateLike,
    add_months,
    between_midnights,
    count_where,
    day_of,
    mask_email,
    mean_of,
    to_date_value,
)
from kilowise.functions.running import sums_around


def customers_by_region(c: DataFrame, region: str) -> DataFrame:
    return c.filter(F.col("region") == region)


def fetch_customer_info(c: DataFrame, t: DataFrame, ids: Sequence[object] | None = None) -> DataFrame:
    """Customer, address and tariff of the given customers, or of all."""
    rows = c if ids is None else c.filter(F.col("customer_id").isin(list(ids)))
    known = t.select(F.col("tariff_code").alias("tariff_type"))
    return rows.join(known, "tariff_type").select(
        "customer_id", F.col("office_address").alias("address"), "tariff_type"
    )


def customer_details(c: DataFrame, t: DataFrame, ids: Sequence[object] | None = None) -> DataFrame:
    """The same as one composite value per customer."""
    return fetch_customer_info(c, t, ids).select(
        F.struct("customer_id", "address", "tariff_type").alias("customer_details")
    )


def secure_customer_view(c: DataFrame, role: str | None = None) -> DataFrame:
    """Customers with the e-mail masked for analysts; role defaults to the user."""
    who = F.current_user() if role is None else F.lit(role)
    return c.select(
        "customer_id",
        F.col("office_address").alias("address"),
        "tariff_type",
        F.when(who == "data_analyst", mask_email("email")).otherwise(F.col("email")).alias("email"),
    )


def churn_risk(b: DataFrame, c: DataFrame) -> DataFrame:
    wait = F.datediff("payment_date", "billing_month")
    paid = b.groupBy("customer_id").agg(
        mean_of(F.sum(wait), F.count(wait)).alias("avg_days_to_pay"),
        count_where(F.col("payment_date").isNull()).alias("missed_payments"),
        F.count(F.lit(1)).alias("total_bills"),
    )
    days = F.col("avg_days_to_pay")
    risk = (
        F.when((F.col("missed_payments") > 0) | (days > 30), "High Risk")
        .when(days.between(15, 30), "Medium Risk")
        .otherwise("Low Risk")
    )
    return (
        c.select("customer_id", "tariff_type")
        .join(paid, "customer_id")
        .withColumn("churn_risk", risk)
        .orderBy("churn_risk", days.desc_nulls_first(), "customer_id")
    )


def tariff_history(addresses: DataFrame, meters: DataFrame) -> DataFrame:
    """Tariff of a customer at each address start and each meter installation."""
    moved = addresses.select("customer_id", "tariff_type", F.col("start_date").alias("effective_date"))
    installed = meters.select("customer_id", "tariff_type", F.col("installation_date").alias("effective_date"))
    return moved.unionByName(installed)


def tariff_migration(
    history: DataFrame, r: DataFrame, t: DataFrame, start: DateLike, end: DateLike
) -> DataFrame:
    """Usage and bill before and after tariff changes, per (from, to) tariff.

    A customer's first and last tariff in the span make the pair; each change date
    of the span splits the readings from three months before to three months after
    the span, and all splits count. A change takes effect at midnight, so readings
    are summed by customer and day before they meet the change dates.
    """
    start, end = to_date_value(start), to_date_value(end)
    changes = (
        history.filter(F.col("effective_date").between(F.lit(start), F.lit(end)))
        .select("customer_id", "tariff_type", "effective_date")
        .distinct()
    )
    at = F.struct("effective_date", "tariff_type")
    pairs = changes.groupBy("customer_id").agg(
        F.min_by("tariff_type", at).alias("from_tariff"), F.max_by("tariff_type", at).alias("to_tariff")
    )
    # Rows with the same date split alike: keep one row and its weight.
    dates = changes.groupBy("customer_id", "effective_date").agg(F.count(F.lit(1)).alias("w"))
    days = (
        r.filter(between_midnights("reading_ts", add_months(start, -3), add_months(end, 3)))
        .groupBy("customer_id", day_of("reading_ts").alias("day"))
        .agg(F.sum("kwh_usage").alias("kwh"), F.count("kwh_usage").alias("n"))
    )
    split = sums_around(dates, "effective_date", days, "day", "customer_id", ["kwh", "n"])

    def weighted(value: str) -> Column:
        return F.sum(F.expr(value) * F.col("w"))

    usage = (
        split.groupBy("customer_id")
        .agg(
            mean_of(weighted("kwh_before"), weighted("n_before")).alias("old_avg"),
            mean_of(weighted("kwh_all - kwh_before"), weighted("n_all - n_before")).alias("new_avg"),
            F.max("n_all").alias("_n"),
        )
        .filter("_n > 0")
        .join(pairs.filter("from_tariff <> to_tariff"), "customer_id")
    )
    rate = (
        F.col("peak_rate_per_kwh").cast("double") * 0.7 + F.col("offpeak_rate_per_kwh").cast("double") * 0.3
    )
    fixed = F.col("daily_fixed_charge").cast("double") * 30
    old = t.select(F.col("tariff_code").alias("from_tariff"), rate.alias("_old_rate"), fixed.alias("_old_fixed"))
    new = t.select(F.col("tariff_code").alias("to_tariff"), rate.alias("_new_rate"), fixed.alias("_new_fixed"))
    bill_change = (F.col("new_avg") * F.col("_new_rate") + F.col("_new_fixed")) - (
        F.col("old_avg") * F.col("_old_rate") + F.col("_old_fixed")
    )
    return (
        usage.join(old, "from_tariff")
        .join(new, "to_tariff")
        .groupBy("from_tariff", "to_tariff")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.avg(F.col("new_avg") - F.col("old_avg")), 2).alias("avg_consumption_change"),
            F.round(F.avg(bill_change), 2).alias("avg_bill_change"),
        )
        .orderBy(F.desc("customer_count"))
    )


def address_change_impact(history: DataFrame, r: DataFrame) -> DataFrame:
    """Usage at the old address against usage after the next move.

    Only the last address row of a date has a stay of its own; rows that start on
    the same day are ordered by address_id. So each customer shrinks to one row per
    start date, and readings to one row per day, before the two are joined.
    """
    dates = history.groupBy("customer_id", "start_date").agg(
        F.max_by("address", "address_id").alias("old_address"),
        F.min_by("address", "address_id").alias("first_address"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    # The stay ends at midnight of the day before the next move: "late" is what
    # comes after midnight.
    late = F.col("reading_ts") > day_of("reading_ts")
    days = r.groupBy("customer_id", day_of("reading_ts").alias("day")).agg(
        F.sum("kwh_usage").alias("kwh"),
        F.count("kwh_usage").alias("n"),
        F.sum(F.when(late, F.col("kwh_usage"))).alias("late_kwh"),
        F.count(F.when(late, F.col("kwh_usage"))).alias("late_n"),
    )
    sums = sums_around(dates, "start_date", days, "day", "customer_id", ["kwh", "n", "late_kwh", "late_n"])
    order = Window.partitionBy("customer_id").orderBy("start_date")

    def following(column: str, n: int = 1) -> Column:
        return F.lead(column, n).over(order)

    # The very last row of a customer has no next move and is not in the report, so
    # it is no new address either.
    last_is_next = following("start_date", 2).isNull() & (following("n_rows") == 1)
    usage = sums.select(
        "customer_id",
        "old_address",
        F.when(~last_is_next, following("first_address")).alias("new_address"),
        following("start_date").alias("next_move"),
        mean_of(
            following("kwh_before") - F.col("kwh_before") - following("late_kwh_eve"),
            following("n_before") - F.col("n_before") - following("late_n_eve"),
        ).alias("old_usage"),
        mean_of(F.col("kwh_all") - following("kwh_before"), F.col("n_all") - following("n_before")).alias("new_usage"),
    ).filter("next_move IS NOT NULL")
    change = F.col("new_usage") - F.col("old_usage")
    return (
        usage.filter((F.col("old_usage") > 0) & (F.col("new_usage") > 0))
        .select(
            "customer_id",
            "old_address",
            "new_address",
            "old_usage",
            "new_usage",
            (F.try_divide(change, "old_usage") * 100).alias("usage_change_percent"),
        )
        .orderBy(F.abs(F.col("new_usage") - F.col("old_usage")).desc(), "customer_id")
    )
