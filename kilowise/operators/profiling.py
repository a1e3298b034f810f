"""Counts, previews and column profiles of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Rows per table; names that are no table or view are left out."""
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
        if spark.catalog.tableExists(name)
    ]
    if not counts:
        raise ValueError("none of the tables exists")
    return reduce(DataFrame.unionByName, counts)


def list_columns(df: DataFrame) -> list[str]:
    return df.schema.fieldNames()


def preview_table(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """First rows; with an order the result is the same on every run."""
    return (df.orderBy(*order) if order else df).limit(n)


def hourly_record_counts(df: DataFrame, ts: str) -> DataFrame:
    """Records per hour from the first to the last hour; empty hours give 0."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    counts = df.filter(F.col(ts).isNotNull()).groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("_n"))
    hours = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour")
    )
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("_n", F.lit(0)).alias("n_rows"))


def value_histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty ones kept.

    A constant column gets a range of width 1 around its value.
    """
    value = F.col(col).cast("double")
    known = df.filter(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    limits = known.agg(F.min("v").alias("a"), F.max("v").alias("z"))
    half = F.when(F.col("a") == F.col("z"), 0.5).otherwise(0.0)
    # One row, read as a scalar by both the counting scan and the list of bins.
    limits = limits.select(F.struct((F.col("a") - half).alias("lo"), (F.col("z") + half).alias("hi")).alias("l"))
    at = limits.scalar()
    bin_no = F.least(F.floor(bins * (F.col("v") - at["lo"]) / (at["hi"] - at["lo"])) + 1, F.lit(bins))
    counts = known.groupBy(bin_no.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    width = (F.col("l.hi") - F.col("l.lo")) / bins
    edges = limits.filter("l.lo IS NOT NULL").select(
        "l", F.explode(F.sequence(F.lit(1), F.lit(bins)).cast("array<bigint>")).alias("bin")
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("l.lo") + (F.col("bin") - 1) * width).alias("lo"),
        (F.col("l.lo") + F.col("bin") * width).alias("hi"),
        F.coalesce("_n", F.lit(0)).alias("n_rows"),
    )


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one row per column."""
    parts = []
    for name in columns:
        x = F.col(name).cast("double")
        parts.append(
            F.struct(
                F.count(x).alias("n"),
                F.round(F.avg(x), 6).alias("mean"),
                F.round(F.stddev_samp(x), 6).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(name)
        )
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`.*")) for n in columns])
    return df.agg(*parts).select(F.inline(rows))


def column_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("max_value"))


def total_usage(df: DataFrame, col: str) -> DataFrame:
    """Sum of the numeric values of a text column and how many there were.

    Values are read as decimals, so the sum does not depend on their order.
    """
    value = F.col(col).try_cast("decimal(30,6)")
    return df.agg(F.sum(value).alias("total"), F.count(value).alias("n_used"))
