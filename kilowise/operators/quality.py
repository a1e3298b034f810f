"""Data-quality rules: each returns its name and the number of violations.

The rules of one table are computed in a single pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowise.functions.columns import VALID_VOLTAGES


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule; ``rules`` maps a name to the test of a bad row."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("n_violations")) for name in rules]
    return counted.select(F.inline(F.array(*pairs)))


def check_voltage_domain(df: DataFrame, allowed: Sequence[int] = VALID_VOLTAGES) -> DataFrame:
    return count_violations(df, {"voltage_domain": ~F.col("voltage").isin(*allowed)})


def check_hour_range(df: DataFrame) -> DataFrame:
    return count_violations(df, {"hour_range": ~F.col("hour_of_day").between(0, 23)})


def check_flag_domain(df: DataFrame) -> DataFrame:
    return count_violations(df, {"flag_domain": ~F.col("data_quality_flag").isin("VALID", "INVALID")})


def check_unique(df: DataFrame, key: Sequence[str], rule: str = "unique_meter_ts") -> DataFrame:
    """Number of keys that occur more than once."""
    repeated = df.groupBy(*key).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(rule).alias("rule"), "n_violations")


def check_foreign_key(df: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Rows whose key has no parent. Keys are counted first, so a frequent key
    crosses the join as one row."""
    keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).count()
    orphans = keys.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_violations")).select(
        F.lit(rule).alias("rule"), "n_violations"
    )


def check_foreign_keys(checks: Sequence[tuple[DataFrame, str, DataFrame, str, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check_foreign_key(*c) for c in checks])


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_violations(df, {f"not_null_{name}": F.col(name).isNull() for name in columns})
