"""Cleaning and enrichment of readings; every function works on a batch and on a
streaming DataFrame alike and uses native expressions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowise.functions.columns import (
    DEFAULT_REGION_RATE,
    REGION_RATES,
    DateLike,
    day_of,
    is_peak,
    region_rate,
    to_date_value,
    valid_kwh,
    valid_voltage,
    within,
)
from kilowise.plans.sizing import broadcast_if_small
from kilowise.schemas import STREAM_ALIASES, STREAM_RECORD


def parse_json(
    raw: DataFrame,
    schema: T.StructType = STREAM_RECORD,
    aliases: Mapping[str, Sequence[str]] = STREAM_ALIASES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Message body to columns; a body that is no JSON gives a row of NULLs.

    Integer fields are read as double and cast, since producers send 230.0; a field
    may come under one of its alias names. ``keep`` names topic columns to carry on.
    """
    wire = T.StructType()
    for field in schema.fields:
        kind = T.DoubleType() if isinstance(field.dataType, T.IntegerType) else field.dataType
        for name in (field.name, *aliases.get(field.name, ())):
            wire.add(name, kind)
    # As the output of a generator the body is parsed once per message; as a plain
    # column every later filter on one of its fields would parse it again.
    body = F.from_json(F.col("value").cast("string"), wire)
    read = {name: f"_json_{name}" for name in wire.fieldNames()}
    parsed = raw.select(*keep, F.inline(F.array(body)).alias(*read.values()))

    def pick(field: T.StructField) -> Column:
        names = (field.name, *aliases.get(field.name, ()))
        return F.coalesce(*[F.col(read[n]) for n in names]).cast(field.dataType).alias(field.name)

    return parsed.select(*keep, *[pick(f) for f in schema.fields])


def parse_json_tuple(raw: DataFrame) -> DataFrame:
    """Three fields as strings, without a schema; a missing key gives NULL."""
    return raw.select(
        F.json_tuple(F.col("value").cast("string"), "meter_id", "voltage", "timestamp").alias(
            "meter_id", "voltage", "timestamp"
        )
    )


def enrich_time(s: DataFrame, ts: str = "timestamp") -> DataFrame:
    return s.withColumns(
        {"date": day_of(ts), "hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts)}
    )


def region_cost(
    s: DataFrame, rates: Mapping[str, str] = REGION_RATES, default: str = DEFAULT_REGION_RATE
) -> DataFrame:
    return s.withColumn("cost", F.col("kwh_usage").cast("double") * region_rate("region", rates, default))


def peak_weekend_flags(s: DataFrame, rule: str, ts: str = "timestamp") -> DataFrame:
    return s.withColumns({"is_peak": is_peak(ts, rule), "is_weekend": F.dayofweek(ts).isin(1, 7)})


def quality_flag(s: DataFrame) -> DataFrame:
    return s.withColumns(
        {"is_valid_voltage": valid_voltage("voltage"), "is_valid_kwh": valid_kwh("kwh_usage")}
    ).withColumn(
        "data_quality_flag",
        F.when(F.col("is_valid_voltage") & F.col("is_valid_kwh"), "VALID").otherwise("INVALID"),
    )


def is_complete(columns: Sequence[str] = ("meter_id", "customer_id", "timestamp")) -> Column:
    """Whether a row has every required field."""
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
    return complete


def required_fields(
    s: DataFrame, columns: Sequence[str] = ("meter_id", "customer_id", "timestamp")
) -> tuple[DataFrame, DataFrame]:
    """Rows that have every required field, and the rest for quarantine. For both in one pass, mark the
    rows with ``is_complete`` instead."""
    return s.filter(is_complete(columns)), s.filter(~is_complete(columns))


def tag_source(s: DataFrame, name: str = "kafka_stream") -> DataFrame:
    return s.withColumn("source_system", F.lit(name))


def enrich(
    s: DataFrame,
    peak_rule: str = "evening",
    rates: Mapping[str, str] = REGION_RATES,
    ts: str = "timestamp",
    with_processing_time: bool = False,
) -> DataFrame:
    """All enrichment steps over complete rows, in one projection."""
    kept, _ = required_fields(s, ("meter_id", "customer_id", ts))
    out = enrich_time(kept, ts)
    out = region_cost(out, rates)
    out = peak_weekend_flags(out, peak_rule, ts)
    out = tag_source(quality_flag(out))
    return out.withColumn("processing_time", F.current_timestamp()) if with_processing_time else out


def voltage_anomaly(s: DataFrame, limit: int = 250) -> DataFrame:
    return s.withColumn("is_anomaly", F.when(F.col("voltage") > limit, True).otherwise(False))


def high_usage_alert(r: DataFrame, limit: float = 1000) -> DataFrame:
    return r.filter(F.col("kwh_usage") > limit)


def positive_cost(s: DataFrame, rate: str = "0.28") -> DataFrame:
    """All rows with their cost, NULL where the usage is not positive (missing usage is 0)."""
    positive = F.coalesce("kwh_usage", F.lit(0)) > 0
    return s.withColumn("cost", F.when(positive, F.col("kwh_usage").cast("double") * F.lit(rate).cast("double")))


def positive_reading_cost(s: DataFrame, rate: str = "0.28") -> tuple[DataFrame, DataFrame]:
    """Priced rows with positive usage, and the rejected rows, to be written apart."""
    both = positive_cost(s, rate)
    return both.filter("cost IS NOT NULL"), both.filter("cost IS NULL").drop("cost")


def clean_readings(
    staging: DataFrame, c: DataFrame, w: DataFrame, as_of: DateLike | None = None, peak_rule: str = "daytime"
) -> DataFrame:
    """Staged readings in fact form, for one day or for all; the region is the
    customer's.

    Negative or missing usage becomes 0, missing electrical values their defaults;
    the customer must exist, the weather of the region and day may be missing.
    """
    rows = staging.drop("region")
    if as_of is not None:
        day = to_date_value(as_of)
        rows = rows.filter(within("reading_ts", day) & (F.col("reading_ts") < F.date_add(F.lit(day), 1)))
    known = broadcast_if_small(c.select("customer_id", "region"))
    weather = w.select(
        "region", F.col("observation_date").alias("date"), "weather_condition", "temperature_c"
    )
    return (
        rows.withColumn("date", day_of("reading_ts"))
        .join(known, "customer_id")
        .join(broadcast_if_small(weather), ["region", "date"], "left")
        .select(
            "reading_id",
            "meter_id",
            "customer_id",
            "reading_ts",
            F.when(F.col("kwh_usage") > 0, F.col("kwh_usage")).otherwise(0).alias("kwh_usage"),
            F.coalesce("voltage", F.lit(0)).alias("voltage"),
            F.coalesce("current_amps", F.lit(0)).alias("current_amps"),
            F.coalesce("power_factor", F.lit(1)).alias("power_factor"),
            "region",
            is_peak("reading_ts", peak_rule).alias("is_peak_hours"),
            "weather_condition",
            "temperature_c",
            "date",
        )
    )
