"""Billing jobs: set-based over all customers, usage aggregated before any join.

``month=None`` bills every month present in the readings; a month is turned into
a timestamp range, which the Parquet scan can use.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowise.functions.columns import (
    DateLike,
    in_month,
    is_peak_reading,
    lookup,
    mean_of,
    money,
    month_floor,
    month_of,
    sum_where,
    within,
)

from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize

# Flat price per kWh by meter class.
METER_CLASS_RATES = {"Commercial": "0.15", "Residential": "0.10"}


def monthly_split(r: DataFrame, month: DateLike | None = None) -> DataFrame:
    """Total, peak and off-peak energy per customer and month."""
    return (
        r.filter(in_month("reading_ts", month))
        .groupBy("customer_id", month_of("reading_ts").alias("billing_month"))
        .agg(
            F.sum("kwh_usage").alias("total_kwh"),
            sum_where(is_peak_reading(), "kwh_usage").alias("peak_kwh"),
            sum_where(~is_peak_reading(), "kwh_usage").alias("offpeak_kwh"),
        )
    )


def with_tariff(usage: DataFrame, c: DataFrame, t: DataFrame) -> DataFrame:
    """Add tariff columns by way of the customer's tariff code. The usage side is
    already spread by customer_id, so only the customer table moves."""
    return usage.join(c.select("customer_id", "tariff_type"), "customer_id").join(
        t.withColumnRenamed("tariff_code", "tariff_type"), "tariff_type"
    )


def every_customer(c: DataFrame, usage: DataFrame, t: DataFrame) -> DataFrame:
    """All customers with usage and tariff columns, NULL where there are none."""
    return (
        c.select("customer_id", "tariff_type")
        .join(usage, "customer_id", "left")
        .join(t.withColumnRenamed("tariff_code", "tariff_type"), "tariff_type", "left")
    )


def energy_cost() -> Column:
    return F.col("peak_kwh") * F.col("peak_rate_per_kwh") + F.col("offpeak_kwh") * F.col("offpeak_rate_per_kwh")


def monthly_billing(
    r: DataFrame, c: DataFrame, t: DataFrame, month: DateLike | None = None, region: str | None = None
) -> DataFrame:
    """Energy at split rates plus the fixed charge for each day of the month."""
    rows = r if region is None else r.filter(F.col("region") == region)
    days = F.dayofmonth(F.last_day("billing_month"))
    amount = energy_cost() + days * F.col("daily_fixed_charge")
    return with_tariff(monthly_split(rows, month), c, t.filter("is_current")).select(
        "customer_id", "billing_month", "total_kwh", "peak_kwh", "offpeak_kwh", money(amount).alias("amount_due")
    )


def tariff_unmatched(c: DataFrame, t: DataFrame) -> DataFrame:
    """Customers that an inner join with the tariffs would drop."""
    return c.join(t.select(F.col("tariff_code").alias("tariff_type")), "tariff_type", "left_anti").select(
        "customer_id", "tariff_type"
    )


def recompute_bills(
    b: DataFrame, r: DataFrame, c: DataFrame, t: DataFrame, month: DateLike | None = None
) -> DataFrame:
    """New amount of each bill of the month; NULL where nothing can be charged."""
    bills = b.filter(in_month("billing_month", month)).select("bill_id", "customer_id", "billing_month")
    charged = with_tariff(monthly_split(r, month), c, t).select(
        "customer_id", "billing_month", money(energy_cost()).alias("amount_due")
    )
    # Stored, so that the join can split a customer with very many bills.
    charged = materialize(charged, "charged-months")
    return bills.join(charged, ["customer_id", "billing_month"], "left").select("bill_id", "amount_due")


def customer_billing_detail(
    r: DataFrame,
    c: DataFrame,
    t: DataFrame,
    month: DateLike | None = None,
    customer: object | None = None,
) -> DataFrame:
    rows = r if customer is None else r.filter(F.col("customer_id") == customer)
    return with_tariff(monthly_split(rows, month), c, t).select(
        "customer_id",
        "billing_month",
        energy_cost().alias("total_cost"),
        "peak_kwh",
        "offpeak_kwh",
        "daily_fixed_charge",
        "tariff_name",
    )


def incremental_bill_usage(b: DataFrame, r: DataFrame, since: DateLike) -> DataFrame:
    """Add the readings since a date to the bills of their customer and month."""
    recent = (
        r.filter(within("reading_ts", since))
        .groupBy("customer_id", month_of("reading_ts").alias("billing_month"))
        .agg(F.sum("kwh_usage").alias("_new"))
    )
    recent = materialize(recent, "recent-usage")
    return b.join(recent, ["customer_id", "billing_month"], "left").select(
        "bill_id", (F.col("total_kwh") + F.coalesce("_new", F.lit(0))).alias("total_kwh")
    )


def with_charge(
    usage: DataFrame, m: DataFrame, rates: Mapping[str, str] = METER_CLASS_RATES, class_col: str = "meter_class"
) -> DataFrame:
    """All (meter_id, kwh) rows with their charge, and whether their meter's class has a rate."""
    classes = broadcast_if_small(m.select("meter_id", class_col))
    rate = lookup(class_col, rates, "decimal(8,4)")
    return usage.join(classes, "meter_id", "left").select(
        "meter_id", "kwh", class_col, (F.col("kwh") * rate).alias("charge"), rate.isNotNull().alias("rated")
    )


def meter_charge(
    usage: DataFrame, m: DataFrame, rates: Mapping[str, str] = METER_CLASS_RATES, class_col: str = "meter_class"
) -> tuple[DataFrame, DataFrame]:
    """Charge of each (meter_id, kwh) row by its meter's class, and the rows of
    unknown class, which are set aside."""
    both = with_charge(usage, m, rates, class_col)
    return both.filter("rated").select("meter_id", "charge"), both.filter("NOT rated").select("meter_id", "kwh", class_col)


def estimated_bill(r: DataFrame, c: DataFrame, t: DataFrame, b: DataFrame, month: DateLike) -> DataFrame:
    """Estimate for every customer: energy at split rates less the discount of the
    month's bill, if any; NULL without usage or tariff."""
    discount = (
        b.filter(in_month("billing_month", month))
        .groupBy("customer_id")
        .agg(F.max("discount_pct").alias("_discount"))
    )
    usage = monthly_split(r, month)
    bill = energy_cost() * (1 - F.coalesce("_discount", F.lit(0)) / 100)
    return (
        every_customer(c, usage, t)
        .join(discount, "customer_id", "left")
        .select("customer_id", money(bill).alias("estimated_bill"))
    )


def generate_monthly_bills(r: DataFrame, c: DataFrame, t: DataFrame, month: DateLike) -> DataFrame:
    """One bill row per customer, also for those without usage."""
    usage = monthly_split(r, month).drop("billing_month")
    discount = F.when(F.col("peak_rate_per_kwh").isNotNull(), F.coalesce("discount_pct", F.lit(0)))
    amount = energy_cost() * (1 - discount / 100)
    return every_customer(c, usage, t).select(
        F.lit(month_floor(month)).alias("billing_month"),
        "customer_id",
        "total_kwh",
        money(amount).alias("amount_due"),
        discount.alias("discount_applied"),
    )


def billing_customer(b: DataFrame, c: DataFrame, n: int | None = None) -> DataFrame:
    out = b.join(broadcast_if_small(c.select("customer_id", "tariff_type")), "customer_id").select(
        "billing_month", "customer_id", "tariff_type", "total_kwh", "amount_due", "discount_applied"
    )
    return out.orderBy("billing_month", "customer_id", "amount_due").limit(n) if n else out


def energy_profile(c: DataFrame, m: DataFrame, b: DataFrame, t: DataFrame, n: int | None = None) -> DataFrame:
    """Each customer's meters times bills, with the tariff name. Tariffs are joined
    to the customers first, before the rows multiply."""
    named = c.join(
        t.select(F.col("tariff_code").alias("tariff_type"), "tariff_name"), "tariff_type"
    ).select("customer_id", "tariff_name")
    out = (
        b.select("customer_id", "billing_month", "total_kwh", "amount_due")
        .join(named, "customer_id")
        .join(m.select("customer_id", "meter_id", "meter_type"), "customer_id")
        .select(
            "customer_id", "meter_id", "meter_type", "billing_month", "total_kwh", "amount_due", "tariff_name"
        )
    )
    return out.orderBy("customer_id", "meter_id", "billing_month", "amount_due").limit(n) if n else out


def billing_validation(b: DataFrame, r: DataFrame, tol: int = 5) -> DataFrame:
    """Billed against actual energy; identical bills of a month form one group and
    each of them brings the readings once more."""
    bills = b.groupBy(
        "customer_id",
        "billing_month",
        F.col("peak_kwh").alias("billed_peak"),
        F.col("offpeak_kwh").alias("billed_offpeak"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    usage = monthly_split(r).select("customer_id", "billing_month", "peak_kwh", "offpeak_kwh")
    usage = materialize(usage, "monthly-usage")
    actual = (
        bills.join(usage, ["customer_id", "billing_month"])
        .withColumn("actual_peak", F.col("peak_kwh") * F.col("_n"))
        .withColumn("actual_offpeak", F.col("offpeak_kwh") * F.col("_n"))
        .withColumn("peak_diff", F.col("billed_peak") - F.col("actual_peak"))
        .withColumn("offpeak_diff", F.col("billed_offpeak") - F.col("actual_offpeak"))
    )
    return actual.filter((F.abs("peak_diff") > tol) | (F.abs("offpeak_diff") > tol)).select(
        "customer_id",
        "billing_month",
        "billed_peak",
        "actual_peak",
        "billed_offpeak",
        "actual_offpeak",
        "peak_diff",
        "offpeak_diff",
    )


def billing_dashboard(b: DataFrame, w: DataFrame, repeat_by_weather: bool = True) -> DataFrame:
    """Customers, energy, revenue and fees per region and month, with the mean
    temperature.

    With ``repeat_by_weather`` the sums are those of a join of each bill with every
    weather row of its month, which counts a bill once per weather row; they are
    computed as sum times number of rows. Without it each bill counts once.
    """
    month = month_of("billing_month")
    customers = b.groupBy("region", month.alias("month"), "customer_id").agg(
        F.sum("total_kwh").alias("kwh"),
        F.sum("amount_due").alias("amount"),
        F.sum("late_fee").alias("fees"),
    )
    bills = customers.groupBy("region", "month").agg(
        F.count("customer_id").alias("active_customers"),
        F.sum("kwh").alias("kwh"),
        F.sum("amount").alias("amount"),
        F.sum("fees").alias("fees"),
    )
    weather = w.groupBy("region", month_of("observation_date").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        mean_of(F.sum(F.col("mean_temp_c").cast("decimal(10,4)")), F.count("mean_temp_c")).alias("avg_temp"),
    )
    times = F.coalesce("rows", F.lit(1)) if repeat_by_weather else F.lit(1)
    return bills.join(weather, ["region", "month"], "left").select(
        "region",
        "month",
        "active_customers",
        (F.col("kwh") * times).alias("total_kwh"),
        (F.col("amount") * times).alias("revenue"),
        (F.col("fees") * times).alias("late_fees_collected"),
        "avg_temp",
    )
