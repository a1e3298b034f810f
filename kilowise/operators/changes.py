"""Row updates as set-based jobs: upsert, registration, audit log, e-mail update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilowise.functions.columns import DateLike, to_date_value
from kilowise.plans.sizing import broadcast_if_small

# Columns that a repeated reading replaces; the others keep the first value.
READING_KEYS = ("meter_id", "timestamp")
UPDATED_ON_CONFLICT = ("kwh_usage", "voltage", "cost", "data_quality_flag", "processing_time")


def upsert_readings(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = READING_KEYS,
    updated_cols: Sequence[str] = UPDATED_ON_CONFLICT,
    order_col: str = "arrival",
) -> DataFrame:
    """Target rows after applying the updates in order.

    On a key conflict the last row gives the updated columns and the first row (the
    stored one, if any) all others. One aggregation by key, combined on the map
    side; the target's rows come before every update.
    """
    columns = target.columns
    changed = [c for c in columns if c in updated_cols]
    kept = [c for c in columns if c not in changed and c not in keys]
    old = target.withColumns({"_late": F.lit(0), "_order": F.lit(None).cast(updates.schema[order_col].dataType)})
    new = updates.withColumns({"_late": F.lit(1), "_order": F.col(order_col)}).select(old.columns)
    at = F.struct("_late", "_order")
    picks = [F.min_by(F.struct(*kept), at).alias("_kept")] if kept else []
    picks += [F.max_by(F.struct(*changed), at).alias("_changed")] if changed else []
    merged = old.unionByName(new).groupBy(*keys).agg(*picks)
    source = {**{c: f"_kept.{c}" for c in kept}, **{c: f"_changed.{c}" for c in changed}}
    return merged.select(*[F.col(source.get(c, c)).alias(c) for c in columns])


def register_new_meters(m: DataFrame, s: DataFrame, as_of: DateLike) -> DataFrame:
    """Meters that send readings but are not in the meter table yet."""
    seen = s.select("meter_id").filter("meter_id IS NOT NULL").distinct()
    return seen.join(m.select("meter_id"), "meter_id", "left_anti").select(
        "meter_id", F.lit(to_date_value(as_of)).alias("installation_date"), F.lit(True).alias("is_active")
    )


def drop_unknown_customers(s: DataFrame, c: DataFrame) -> DataFrame:
    known = broadcast_if_small(c.select("customer_id"))
    return s.join(known, "customer_id", "left_semi")


def unknown_customers(s: DataFrame, c: DataFrame) -> DataFrame:
    """Readings dropped for want of a customer, counted by customer id."""
    counted = s.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(c.select("customer_id"), "customer_id", "left_anti")


def customer_audit_log(
    old: DataFrame, new: DataFrame, changed_at: DateLike, key: str = "customer_id"
) -> DataFrame:
    """Inserted, deleted and changed rows between two snapshots, with JSON images and the given day."""
    columns = [c for c in new.columns if c in old.columns]
    image = {"ignoreNullFields": "false"}

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.to_json(F.struct(*columns), image)
        return df.select(F.col(key).alias(f"{name}_key"), row.alias(f"{name}_value"))

    before, after = side(old, "old"), side(new, "new")
    joined = before.join(after, F.col("old_key") == F.col("new_key"), "full_outer")
    action = (
        F.when(F.col("old_key").isNull(), "INSERT").when(F.col("new_key").isNull(), "DELETE").otherwise("UPDATE")
    )
    return joined.filter(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(
        F.coalesce("new_key", "old_key").alias(key), action.alias("action_type"), "old_value", "new_value",
        F.lit(to_date_value(changed_at)).alias("changed_at"),
    )


def update_customer_email(
    c: DataFrame, updates: DataFrame, order_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Customers with new e-mails, and the updates that match no customer. Of several updates of a
    customer the last by ``order_col`` counts (by e-mail without one)."""
    at = F.struct(F.col(order_col), F.col("email")) if order_col else F.col("email")
    new = updates.groupBy("customer_id").agg(F.max_by("email", at).alias("_email"))
    changed = (
        c.join(new, "customer_id", "left")
        .withColumn("email", F.coalesce("_email", "email"))
        .select(*c.columns)
    )
    return changed, updates.join(c.select("customer_id"), "customer_id", "left_anti")
