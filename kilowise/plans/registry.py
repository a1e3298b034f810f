"""Every job bound to the tables of a folder, under its query name.

``show`` gives each result the plain types that a comparison across engines needs:
decimals as double, integers as bigint, timestamps without zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowise.functions import intervals
from kilowise.operators import billing, changes, customers, enrich, fleet, profiling, quality, usage, weather
from kilowise.plans import procedures, sql_surface, storage
from kilowise.plans.bindings import TOPIC_PARTITIONS, Tables
from kilowise.schemas import STREAM_RECORD
from kilowise.session import tune
from kilowise.sources import insert_dump, readers
from kilowise.streaming import alerts, etl, progress, sinks, summary

BILLING_MONTH = "1998-06-01"
AS_OF = "2001-11-10"
ONCE = {"availableNow": True}
# Bound of one micro-batch; results do not depend on it.
BATCH_SIZE = {"maxBytesPerTrigger": str(8 << 30)}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def show(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(job: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a job under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return show(job(Tables(tune(spark), folder)))

    QUERIES[job.__name__] = run
    return job


# Sources


@query
def kafka_topic_table(x: Tables) -> DataFrame:
    table = readers.kafka_topic_table(x.topic, STREAM_RECORD)
    kwh = F.col("kwh_usage").cast("decimal(18,6)")
    return table.groupBy("region", F.col("_partition_id").alias("partition")).agg(
        F.try_divide(F.sum(kwh).cast("double"), F.count(kwh)).alias("avg_kwh"),
        F.min("_offset").alias("first_offset"),
        F.max("_offset").alias("last_offset"),
    )


@query
def read_topic_batch(x: Tables) -> DataFrame:
    raw = readers.read_topic(x.spark, "parquet", streaming=False, path=x.stored_topic())
    body = F.col("value").cast("string")
    return raw.select(
        "topic", "partition", "offset", "timestamp", F.col("key").isNull().alias("no_key"),
        *(F.get_json_object(body, f"$.{c}").alias(c) for c in ("meter_id", "customer_id", "region", "voltage")),
        F.get_json_object(body, "$.kwh_usage").cast("double").alias("kwh_usage"),
    )


@query
def read_topic_stream(x: Tables) -> DataFrame:
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())
    out = storage.work_dir(x.spark, "topic-copy")
    sinks.append_lake_stream(raw.select("topic", "offset", "timestamp"), out, "parquet", trigger=ONCE).awaitTermination()
    return x.spark.read.parquet(out)


@query
def read_stored_table(x: Tables) -> DataFrame:
    path = storage.work_dir(x.spark, "weather-table")
    x.weather.select("region", "observation_date", "mean_temp_c").write.parquet(path)
    return readers.read_table(x.spark, "parquet", path, "region string, observation_date date, mean_temp_c double")


@query
def read_text_lines(x: Tables) -> DataFrame:
    path = storage.work_dir(x.spark, "messages")
    x.topic.select(F.col("value").cast("string")).write.text(path)
    lines = readers.read_text_lines(x.spark, path).withColumn("record", F.from_json("value", STREAM_RECORD.toDDL()))
    return lines.select("record.*")


@query
def read_whole_texts(x: Tables) -> DataFrame:
    """The messages as whole files: characters in all, and bytes as the listing of the files has them."""
    path = storage.work_dir(x.spark, "message-files")
    x.topic.select(F.col("value").cast("string")).write.text(path)
    characters = readers.read_text_lines(x.spark, path, whole=True).agg(F.sum(F.length("value")).alias("n_characters"))
    listed = readers.list_files(x.spark, path).filter("file_path LIKE '%.txt'").agg(F.sum("n_bytes").alias("n_bytes"))
    return characters.join(listed)  # one row each


@query
def read_insert_dump(x: Tables) -> DataFrame:
    path = storage.work_dir(x.spark, "dump")
    # Each customer as a statement in one of four layouts, between statements of another table.
    values = F.format_string(
        "(%d, '%s (%s, %s)', '%s', NULL)", "customer_id", "office_address", "region", "tariff_type", "email"
    )
    layouts = F.array(
        F.array(F.concat(F.lit("INSERT INTO dim_customer VALUES "), values, F.lit("; -- one"))),
        F.array(F.lit("insert into public.dim_customer (customer_id, office_address, email, created_at)"), F.lit("VALUES"), F.concat(values, F.lit(";"))),
        F.array(F.lit("INSERT INTO dim_customer"), F.concat(F.lit("VALUES "), values, F.lit(" /* (0, 'no', 'row', NULL) */;"))),
        F.array(F.lit("INSERT INTO dim_customer"), F.lit("(customer_id, office_address, email, created_at)"), F.lit("VALUES"), F.concat(values, F.lit(","), F.lit(" -- (0)")), F.lit("-- (1, 'a')")),
    )
    own = F.element_at(layouts, (F.pmod("customer_id", F.lit(4)) + 1).cast("int"))
    other = F.array(F.lit("INSERT INTO dim_other VALUES"), F.concat(values, F.lit(";")))
    x.customers.select(F.array_join(F.concat(other, own), "\n").alias("value")).write.text(path)
    schema = T.StructType.fromDDL("customer_id BIGINT, office_address STRING, email STRING, created_at TIMESTAMP")
    return insert_dump.read_insert_dump(x.spark, path, "dim_customer", schema).select(
        "customer_id", "office_address", "email", F.col("created_at").isNull().alias("no_date")
    )


@query
def read_multiline_dump(x: Tables) -> DataFrame:
    """Customers as statements of several tuples over many lines, with texts in either kind of quotes that hold
    line ends, quotes, marks of comments and of statements; statements of another table stand between them."""
    path = storage.work_dir(x.spark, "multiline-dump")
    odd = F.concat("office_address", F.lit("'s \"main\", (unit\n1); -- /* INSERT INTO dim_customer VALUES ("), "customer_id", F.lit(")"))

    def quoted(text, quote: str):
        return F.concat(F.lit(quote), F.replace(text, F.lit(quote), F.lit(quote * 2)), F.lit(quote))

    values = F.concat(
        F.lit("(\n  "), "customer_id", F.lit(" /* it's, */,\n  "), F.when(F.col("customer_id") % 2 == 0, quoted(odd, "'")).otherwise(quoted(odd, '"')),
        F.lit(",\n  "), quoted(F.col("email"), '"'), F.lit(", -- \"\n  NULL\n)"),
    )
    place = F.col("customer_id") % 4
    before = F.when(place == 0, F.lit("INSERT INTO\npublic.dim_customer\n(customer_id, office_address,\nemail, created_at)\nVALUES\n"))
    before = before.when(place == 1, F.lit("insert into dim_customer values ")).otherwise(F.lit("INSERT INTO dim_customer VALUES "))
    other = F.concat(F.lit("INSERT INTO dim_other VALUES\n"), values, F.lit(",\n"), values, F.lit("\n;"))
    x.customers.select(F.concat(before, values, F.lit("\n,\n"), F.replace(values, F.lit("NULL"), F.lit("DEFAULT")), F.lit(";\n"), other).alias("value")).write.text(path)
    schema = T.StructType.fromDDL("customer_id BIGINT, office_address STRING, email STRING, created_at TIMESTAMP")
    rows = insert_dump.read_insert_dump(x.spark, path, "dim_customer", schema)
    return rows.select("customer_id", "office_address", "email", F.col("created_at").isNull().alias("no_date"))


@query
def column_max(x: Tables) -> DataFrame:
    return profiling.column_max(x.readings, "kwh_usage")


@query
def customer_details(x: Tables) -> DataFrame:
    """The composite value of each customer, taken apart."""
    return customers.customer_details(x.customers, x.tariffs).select("customer_details.*")


@query
def preview_table(x: Tables) -> DataFrame:
    return profiling.preview_table(x.customers, 5, ["customer_id"])


@query
def federated_query(x: Tables) -> DataFrame:
    """Messages of a topic, an ORC table and a CSV export in one statement."""
    orc, csv = storage.work_dir(x.spark, "weather-orc"), storage.work_dir(x.spark, "customer-csv")
    x.weather.select("region", "observation_date").write.orc(orc)
    x.raw("customer").select("c_custkey", "c_mktsegment").write.csv(csv, header=True)
    frames = {
        "topic": readers.kafka_topic_table(readers.read_topic(x.spark, "parquet", streaming=False, path=x.stored_topic()), STREAM_RECORD),
        "weather": readers.read_table(x.spark, "orc", orc),
        "customer": readers.read_table(x.spark, "csv", csv, "c_custkey bigint, c_mktsegment string", {"header": "true"}),
    }
    return readers.federated_query(
        x.spark,
        frames,
        """
        SELECT c.c_mktsegment AS segment, count(*) AS n_messages, count(DISTINCT t.customer_id) AS n_customers,
               max(w.last_day) AS last_weather_day
        FROM {topic} t
        JOIN {customer} c ON CAST(t.customer_id AS BIGINT) = c.c_custkey
        JOIN (SELECT region, max(observation_date) AS last_day FROM {weather} GROUP BY region) w
          ON t.region = w.region
        GROUP BY c.c_mktsegment
        """,
    )


# Sinks


@query
def stream_archive(x: Tables) -> DataFrame:
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())
    paths = etl.EtlPaths(storage.work_dir(x.spark, "archive-load"))
    parsed = enrich.parse_json(raw)

    def archive(batch: DataFrame, batch_id: int) -> None:
        sinks.archive_batch(batch, batch_id, paths.archive)

    sinks.foreach_batch(parsed, archive, paths.checkpoint, ONCE).awaitTermination()
    return sinks.read_archive(x.spark, paths.archive).drop("batch_id")


@query
def append_lake_stream(x: Tables) -> DataFrame:
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())
    out = storage.work_dir(x.spark, "lake")
    sinks.append_lake_stream(enrich.parse_json(raw), out, "parquet", trigger=ONCE).awaitTermination()
    return x.spark.read.parquet(out)


def _hourly_keyed(x: Tables) -> DataFrame:
    """Enriched stream readings with the hour as part of the key, so that keys repeat."""
    readings = enrich.enrich(x.stream_readings.withColumnRenamed("reading_ts", "timestamp"))
    return readings.withColumn("reading_hour", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))


HOUR_KEY = ("meter_id", "reading_hour")


@query
def upsert_readings(x: Tables) -> DataFrame:
    """Readings of the first half of the month stand in the table, all come as updates."""
    rows = _hourly_keyed(x)
    middle = F.lit("2024-01-15").cast("date")
    stored = rows.filter(F.col("timestamp") < middle)
    empty = stored.drop("event_id").limit(0)
    target = changes.upsert_readings(empty, stored, HOUR_KEY, order_col="event_id")
    return changes.upsert_readings(target, rows, HOUR_KEY, order_col="event_id").select(
        "meter_id", "reading_hour", "timestamp", "kwh_usage", "voltage", "cost", "data_quality_flag", "is_weekend"
    )


@query
def register_new_meters(x: Tables) -> DataFrame:
    active = x.meters.filter("is_active")
    return changes.register_new_meters(active, x.stream_readings, AS_OF)


@query
def drop_unknown_customers(x: Tables) -> DataFrame:
    """Meters, of which some name a customer that does not exist."""
    return changes.drop_unknown_customers(x.meters, x.customers).select("meter_id", "customer_id", "meter_type")


@query
def unknown_customers(x: Tables) -> DataFrame:
    return changes.unknown_customers(x.meters, x.customers)


@query
def refresh_mv(x: Tables) -> DataFrame:
    path = storage.work_dir(x.spark, "mv-billing")
    return storage.refresh_mv(lambda: billing.billing_dashboard(x.bills, x.weather), path)


@query
def monthly_partitions(x: Tables) -> DataFrame:
    return storage.monthly_partitions(x.readings, storage.work_dir(x.spark, "by-month"))


@query
def month_store_by_quarter(x: Tables) -> DataFrame:
    """Usage in the months of one quarter, read from the store by a calendar that names them."""
    path = storage.work_dir(x.spark, "months")
    storage.monthly_partitions(x.readings, path)
    day = F.col("observation_date")
    quarter = F.concat(F.year(day), F.lit("-Q"), F.quarter(day)).alias("quarter")
    calendar = x.weather.select(F.date_format(day, "yyyy-MM").alias("year_month"), quarter).distinct()
    rows = storage.read_calendar_months(x.spark, path, calendar.filter("quarter = '1997-Q2'"))
    return rows.groupBy("quarter", "year_month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("kwh_usage").alias("kwh"))


# Enrichment


@query
def parse_json(x: Tables) -> DataFrame:
    return enrich.parse_json(x.topic)


@query
def parse_json_tuple(x: Tables) -> DataFrame:
    return enrich.parse_json_tuple(x.topic)


@query
def enrich_readings(x: Tables) -> DataFrame:
    rates = {"AFRICA": "0.25", "ASIA": "0.23"}
    readings = x.stream_readings.withColumnRenamed("reading_ts", "timestamp")
    return enrich.enrich(readings, "evening", rates).select(
        "event_id", "date", "hour_of_day", "day_of_week", "cost", "is_peak", "is_weekend", "is_valid_voltage",
        "is_valid_kwh", "data_quality_flag", "source_system",
    )


@query
def required_fields(x: Tables) -> DataFrame:
    """Kept and rejected rows when readings of inactive meters lack their meter."""
    active = x.meters.filter("is_active").select("meter_id", F.lit(True).alias("known"))
    rows = x.stream_readings.join(active, "meter_id", "left").withColumn("meter_id", F.expr("if(known, meter_id, NULL)"))
    complete = enrich.is_complete(("meter_id", "customer_id", "reading_ts"))
    return rows.select("event_id", "region", complete.alias("kept"))


@query
def voltage_anomaly(x: Tables) -> DataFrame:
    return enrich.voltage_anomaly(x.stream_readings).select("event_id", "voltage", "is_anomaly")


@query
def high_usage_alert(x: Tables) -> DataFrame:
    return enrich.high_usage_alert(x.stream_readings, 100).select("event_id", "customer_id", "kwh_usage")


@query
def positive_reading_cost(x: Tables) -> DataFrame:
    shifted = x.stream_readings.withColumn("kwh_usage", F.col("kwh_usage") - 5)
    return enrich.positive_cost(shifted).select("event_id", "kwh_usage", "cost")


@query
def clean_readings(x: Tables) -> DataFrame:
    """Weather is moved on in time so that it covers part of the stream's month."""
    staging = x.stream_readings.selectExpr(
        "event_id AS reading_id", "meter_id", "customer_id", "reading_ts",
        "CAST(kwh_usage - 5 AS DECIMAL(10,4)) AS kwh_usage",
        "if(voltage > 250, NULL, voltage) AS voltage",
        "CAST(NULL AS DECIMAL(6,2)) AS current_amps", "CAST(NULL AS DECIMAL(4,2)) AS power_factor",
    )
    moved = x.weather.selectExpr(
        "region", "date_add(observation_date, 8112) AS observation_date", "weather_condition",
        "mean_temp_c AS temperature_c",
    )
    return enrich.clean_readings(staging, x.customers, moved)


@query
def reload_clean_day(x: Tables) -> DataFrame:
    """One day of the fact table, replaced twice, as stored."""
    path, day = storage.work_dir(x.spark, "fact"), "2024-01-15"
    staging = x.loaded_stream.withColumns(
        {"current_amps": F.lit(None).cast("double"), "power_factor": F.lit(None).cast("double")}
    )
    days = x.weather.withColumnRenamed("mean_temp_c", "temperature_c")
    rows = enrich.clean_readings(staging, x.customers, days, day)
    for _ in range(2):
        storage.reload_partition(rows, path, "date", day)
    return x.spark.read.parquet(path).select("reading_id", "kwh_usage", "voltage", "is_peak_hours", "date")


@query
def usage_customer_profile(x: Tables) -> DataFrame:
    return usage.usage_customer_profile(x.readings, x.customers)


@query
def region_filter(x: Tables) -> DataFrame:
    return usage.region_filter(x.readings, ["AFRICA", "ASIA"]).select("reading_id", "meter_id", "region", "kwh_usage")


@query
def customers_by_region(x: Tables) -> DataFrame:
    return customers.customers_by_region(x.customers, "EUROPE")


@query
def fetch_customer_info(x: Tables) -> DataFrame:
    return customers.fetch_customer_info(x.customers, x.tariffs)


@query
def secure_customer_view(x: Tables) -> DataFrame:
    return customers.secure_customer_view(x.customers, "data_analyst")


# Joins


@query
def usage_weather(x: Tables) -> DataFrame:
    return weather.usage_weather(x.readings, x.weather)


@query
def billing_customer(x: Tables) -> DataFrame:
    return billing.billing_customer(x.bills, x.customers)


@query
def energy_profile(x: Tables) -> DataFrame:
    return billing.energy_profile(x.customers, x.meters, x.bills, x.tariffs)


# Usage


@query
def peak_usage_by_temp_band(x: Tables) -> DataFrame:
    return usage.peak_usage_by_temp_band(x.readings)


@query
def monthly_running_total_rank(x: Tables) -> DataFrame:
    return usage.monthly_running_total_rank(x.readings)


@query
def usage_vs_regional_avg(x: Tables) -> DataFrame:
    return usage.usage_vs_regional_avg(x.readings)


@query
def consecutive_month_usage(x: Tables) -> DataFrame:
    return usage.consecutive_month_usage(x.readings, BILLING_MONTH)


@query
def anchor_month_usage(x: Tables) -> DataFrame:
    return usage.anchor_month_usage(x.readings, BILLING_MONTH)


@query
def meter_hierarchy_count(x: Tables) -> DataFrame:
    return fleet.meter_hierarchy_count(x.meters)


@query
def meter_hierarchy_depth(x: Tables) -> DataFrame:
    return fleet.meter_hierarchy(x.meters)


@query
def hourly_peak_by_temp_band(x: Tables) -> DataFrame:
    return usage.hourly_peak_by_temp_band(x.readings, x.weather)


@query
def revenue_vs_weather(x: Tables) -> DataFrame:
    return weather.revenue_vs_weather(x.bills, x.weather)


@query
def above_average_customers(x: Tables) -> DataFrame:
    return usage.above_average_customers(x.readings)


@query
def usage_spikes(x: Tables) -> DataFrame:
    return usage.usage_spikes(x.loaded_stream)


@query
def top10_days_per_region(x: Tables) -> DataFrame:
    return usage.top_days_per_region(x.readings, 10)


@query
def customer_share_of_region(x: Tables) -> DataFrame:
    return usage.customer_share_of_region(x.readings)


@query
def customers_with_peak_usage(x: Tables) -> DataFrame:
    return usage.customers_with_peak_usage(x.readings, x.customers)


@query
def usage_for_tariffs(x: Tables) -> DataFrame:
    return usage.usage_for_tariffs(x.readings, x.customers, ["AUTOMOBILE", "BUILDING"])


@query
def region_weather_total_usage(x: Tables) -> DataFrame:
    return weather.region_weather_total_usage(x.readings, x.weather)


@query
def avg_daily_usage_by_region(x: Tables) -> DataFrame:
    return usage.avg_daily_usage_by_region(x.readings)


@query
def top_usage_quartile(x: Tables) -> DataFrame:
    return usage.top_usage_quartile(x.readings)


@query
def year_over_year_region_avg(x: Tables) -> DataFrame:
    return usage.year_over_year_region_avg(x.readings)


@query
def quarterly_consumption(x: Tables) -> DataFrame:
    return usage.quarterly_consumption(x.readings)


@query
def daily_consumption_trend(x: Tables) -> DataFrame:
    return usage.daily_consumption_trend(x.readings, x.weather)


@query
def monthly_consumption_trend(x: Tables) -> DataFrame:
    return usage.monthly_consumption_trend(x.readings, x.bills)


@query
def consumption_trend_rows(x: Tables) -> DataFrame:
    """The monthly trend as JSON objects, read back by key."""
    rows = usage.as_json_rows(usage.monthly_consumption_trend(x.readings, x.bills))
    parts = {"customer_id": "bigint", "month": "string", "peak_consumption": "double", "billed_amount": "double"}
    return rows.select(*(F.get_json_object("row", f"$.{c}").cast(kind).alias(c) for c, kind in parts.items()))


@query
def missing_days(x: Tables) -> DataFrame:
    return usage.missing_days(x.stream_readings, x.meters)


@query
def usage_anomaly_3sigma(x: Tables) -> DataFrame:
    return usage.usage_anomaly_3sigma(x.loaded_stream)


@query
def daily_voltage_by_meter(x: Tables) -> DataFrame:
    return usage.daily_voltage_by_meter(x.readings)


@query
def daily_customer_summary(x: Tables) -> DataFrame:
    return usage.daily_customer_summary(enrich.enrich(x.loaded_stream, ts="reading_ts"))


# Billing


@query
def monthly_billing(x: Tables) -> DataFrame:
    return billing.monthly_billing(x.readings, x.customers, x.tariffs, BILLING_MONTH)


@query
def monthly_billing_all_months(x: Tables) -> DataFrame:
    return billing.monthly_billing(x.readings, x.customers, x.tariffs)


@query
def tariff_unmatched(x: Tables) -> DataFrame:
    return billing.tariff_unmatched(x.customers, x.tariffs)


@query
def recompute_bills(x: Tables) -> DataFrame:
    return billing.recompute_bills(x.bills, x.readings, x.customers, x.tariffs)


@query
def customer_billing_detail(x: Tables) -> DataFrame:
    return billing.customer_billing_detail(x.readings, x.customers, x.tariffs)


@query
def incremental_bill_usage(x: Tables) -> DataFrame:
    return billing.incremental_bill_usage(x.bills, x.readings, "2001-06-01")


@query
def meter_charge(x: Tables) -> DataFrame:
    used = x.readings.select("meter_id", F.col("kwh_usage").alias("kwh"))
    rows = billing.with_charge(used, x.meters)
    return rows.groupBy("meter_id", "rated").agg(F.sum("charge").alias("charge"), F.count(F.lit(1)).alias("n_rows"))


@query
def estimated_bill(x: Tables) -> DataFrame:
    return billing.estimated_bill(x.readings, x.customers, x.tariffs, x.bills, BILLING_MONTH)


@query
def generate_monthly_bills(x: Tables) -> DataFrame:
    return billing.generate_monthly_bills(x.readings, x.customers, x.tariffs, BILLING_MONTH)


@query
def billing_validation(x: Tables) -> DataFrame:
    return billing.billing_validation(x.bills, x.readings)


@query
def billing_dashboard(x: Tables) -> DataFrame:
    return billing.billing_dashboard(x.bills, x.weather)


@query
def billing_dashboard_dedup(x: Tables) -> DataFrame:
    return billing.billing_dashboard(x.bills, x.weather, repeat_by_weather=False)


@query
def sql_monthly_billing(x: Tables) -> DataFrame:
    """The same bills by a call of the SQL table function."""
    return sql_surface.bound(x).sql(f"SELECT * FROM calculate_monthly_billing(DATE '{BILLING_MONTH}')")


@query
def sql_meter_health(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql(f"SELECT * FROM check_meter_health(DATE '{AS_OF}')")


@query
def sql_estimated_bill(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql(
        f"SELECT customer_id, calculate_estimated_bill(customer_id, DATE '{BILLING_MONTH}') AS estimated_bill FROM dim_customer"
    )


@query
def sql_calculate_billing(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql(f"SELECT * FROM calculate_billing(NULL, DATE '{BILLING_MONTH}')")


@query
def sql_tariff_migration(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql("SELECT * FROM analyze_tariff_migration(DATE '1997-01-01', DATE '1998-12-31')")


@query
def sql_customers_by_region(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql("SELECT * FROM get_customers_by_region('EUROPE')")


@query
def sql_mask_email(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql("SELECT customer_id, mask_email(email) AS email FROM dim_customer")


@query
def sql_calculate_charge(x: Tables) -> DataFrame:
    return sql_surface.bound(x).sql(
        """
        SELECT meter_id, calculate_charge(meter_class, kwh) AS charge
        FROM (SELECT meter_id, CAST(sum(kwh_usage) AS DECIMAL(20,4)) AS kwh FROM fact_meter_readings GROUP BY meter_id)
        JOIN dim_meter USING (meter_id) WHERE meter_class <> 'Unrated'
        """
    )


@query
def sql_meter_descendants(x: Tables) -> DataFrame:
    """Meters below each meter, and how deep they reach, by the recursive statement."""
    return sql_surface.bound(x).sql(
        "SELECT meter_id, count(*) - 1 AS n_descendants, max(distance) AS height FROM meter_descendants() GROUP BY meter_id"
    )


@query
def sql_region_filter(x: Tables) -> DataFrame:
    """Readings of a list of regions by a dynamic statement; one of them has a quote in its name and no readings."""
    found = sql_surface.readings_of_regions(sql_surface.bound(x), ["AFRICA", "ASIA", "') OR ('1' = '1"])
    return found.select("reading_id", "meter_id", "region", "kwh_usage")


@query
def sql_generate_monthly_bills(x: Tables) -> DataFrame:
    """Bills that a call of the procedure has stored."""
    target = storage.work_dir(x.spark, "called-bills")
    procedures.call(sql_surface.bound(x), "generate_monthly_bills", {"month": "1998-06-17"}, target)
    return procedures.read_result(x.spark, target)


@query
def sql_log_and_update(x: Tables) -> DataFrame:
    """Customers after two calls, of which the second fails, and what that one has logged."""
    spark = sql_surface.bound(x)
    target, log = storage.work_dir(x.spark, "called-customers"), storage.work_dir(x.spark, "called-log")
    for address, email in (("NATION_5", "office@example.com"), ("NATION_18", "nobody")):
        procedures.call(spark, "log_and_update", {"address": address, "email": email}, target, log)
    failed = x.spark.read.parquet(log).select("name", F.lit(None).cast("bigint").alias("customer_id"), "email")
    return failed.unionByName(procedures.read_result(x.spark, target).select(F.lit("customer").alias("name"), "customer_id", "email"))


# Weather, fleet and customers


@query
def weather_impact(x: Tables) -> DataFrame:
    return weather.weather_impact(x.readings, x.weather)


@query
def weather_correlation(x: Tables) -> DataFrame:
    out = weather.weather_correlation(x.readings, x.weather)
    return out.withColumn("temp_usage_correlation", F.round("temp_usage_correlation", 6))


@query
def energy_weather_daily(x: Tables) -> DataFrame:
    return weather.energy_weather_daily(x.readings, x.weather)


@query
def describe_weather(x: Tables) -> DataFrame:
    return profiling.describe_columns(x.weather, ["mean_temp_c", "rainfall_mm", "max_temp_c", "min_temp_c"])


@query
def weather_by_region(x: Tables) -> DataFrame:
    return weather.weather_by_region(x.weather)


@query
def meter_health(x: Tables) -> DataFrame:
    return fleet.meter_health(x.meters, x.readings, AS_OF)


@query
def meter_type_benchmark(x: Tables) -> DataFrame:
    return fleet.meter_type_benchmark(x.readings, x.meters).withColumn(
        "usage_volatility", F.round("usage_volatility", 6)
    )


@query
def churn_risk(x: Tables) -> DataFrame:
    return customers.churn_risk(x.bills, x.customers)


@query
def tariff_migration(x: Tables) -> DataFrame:
    history = customers.tariff_history(x.addresses, x.meters)
    return customers.tariff_migration(history, x.readings, x.tariffs, "1997-01-01", "1998-12-31")


@query
def address_change_impact(x: Tables) -> DataFrame:
    return customers.address_change_impact(x.addresses, x.readings)


# Profiles


@query
def table_counts(x: Tables) -> DataFrame:
    frames = {
        "dim_customer": x.customers,
        "dim_meter": x.meters,
        "fact_billing": x.bills,
        "fact_meter_readings": x.readings,
        "fact_weather_daily": x.weather,
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return profiling.table_counts(x.spark, [*frames, "dim_weather_station_missing"])


@query
def hourly_record_counts(x: Tables) -> DataFrame:
    return profiling.hourly_record_counts(x.stream_readings, "reading_ts")


@query
def value_histogram(x: Tables) -> DataFrame:
    return profiling.value_histogram(x.stream_readings, "kwh_usage", 30)


@query
def total_usage(x: Tables) -> DataFrame:
    text = x.raw("events").select(F.expr("if(event_type = 'error', 'n/a', CAST(value AS STRING))").alias("col_4"))
    return profiling.total_usage(text, "col_4")


# Changes


def _changed_customers(x: Tables) -> DataFrame:
    """A later snapshot: new e-mails, closed accounts, and suppliers as new customers."""
    stayed = x.customers.filter("NOT (region = 'AFRICA' AND tariff_type = 'FURNITURE')").withColumn(
        "email", F.expr("if(tariff_type = 'MACHINERY', concat('new-', email), email)")
    )
    joined = x.raw("supplier").selectExpr(
        "-1 - s_suppkey AS customer_id", "CAST(NULL AS STRING) AS office_address", "'BUILDING' AS tariff_type",
        "concat(s_name, '@example.com') AS email", "'EUROPE' AS region",
    )
    return stayed.unionByName(joined)


@query
def customer_audit_log(x: Tables) -> DataFrame:
    return changes.customer_audit_log(x.customers, _changed_customers(x), AS_OF)


def _email_updates(x: Tables) -> DataFrame:
    """Two updates for each second customer; the later one counts."""
    return x.raw("supplier").selectExpr(
        "CAST(floor(s_suppkey / 2) * 40 AS BIGINT) AS customer_id", "concat(s_name, '@mail.test') AS email", "-s_suppkey AS number"
    )


@query
def update_customer_email(x: Tables) -> DataFrame:
    updated, _ = changes.update_customer_email(x.customers, _email_updates(x), "number")
    return updated


@query
def update_customer_email_unmatched(x: Tables) -> DataFrame:
    _, unmatched = changes.update_customer_email(x.customers, _email_updates(x), "number")
    return unmatched


# Data quality


def _enriched(x: Tables) -> DataFrame:
    return enrich.enrich(x.loaded_stream, ts="reading_ts")


@query
def check_voltage_domain(x: Tables) -> DataFrame:
    return quality.check_voltage_domain(x.loaded_stream)


@query
def check_hour_range(x: Tables) -> DataFrame:
    return quality.check_hour_range(_enriched(x))


@query
def check_flag_domain(x: Tables) -> DataFrame:
    return quality.check_flag_domain(_enriched(x))


@query
def check_unique_meter_ts(x: Tables) -> DataFrame:
    hourly = x.stream_readings.select("meter_id", F.date_trunc("hour", "reading_ts").alias("reading_hour"))
    return quality.check_unique(hourly, ["meter_id", "reading_hour"])


@query
def check_foreign_keys(x: Tables) -> DataFrame:
    return quality.check_foreign_keys(
        [
            (x.readings, "customer_id", x.customers, "customer_id", "readings_customer"),
            (x.readings, "meter_id", x.meters, "meter_id", "readings_meter"),
            (x.bills, "customer_id", x.customers, "customer_id", "billing_customer"),
            (x.meters, "customer_id", x.customers, "customer_id", "meters_customer"),
            (x.customers, "tariff_type", x.tariffs, "tariff_code", "customers_tariff"),
            (x.weather, "region", x.customers.select("region").distinct(), "region", "weather_region"),
        ]
    )


@query
def check_not_null(x: Tables) -> DataFrame:
    return quality.check_not_null(x.bills, ["bill_id", "customer_id", "billing_month", "payment_date", "region"])


# Streaming


@query
def stream_etl_store(x: Tables) -> DataFrame:
    """The readings store after the streaming load of all messages."""
    paths, queries = _run_etl(x)
    etl.await_all(queries)
    return sinks.read_store(x.spark, paths.readings).select(
        "meter_id", "timestamp", "kwh_usage", "voltage", "customer_id", "region", "hour_of_day", "is_peak",
        "is_weekend", "date", "data_quality_flag", "source_system",
    )


def _run_etl(x: Tables):
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())
    paths = etl.EtlPaths(storage.work_dir(x.spark, "etl"))
    x.meters.filter("is_active").selectExpr(
        "CAST(meter_id AS STRING) AS meter_id", "installation_date", "is_active"
    ).write.parquet(paths.meters)
    known = x.customers.filter("tariff_type <> 'FURNITURE'").select(F.col("customer_id").cast("string"))
    return paths, etl.run_stream_etl(raw, known, paths, AS_OF, trigger=ONCE, slot_format="yyyy-MM-dd")


@query
def stream_etl_archive(x: Tables) -> DataFrame:
    """What the same load leaves beside the store: archive, quarantine, meters and dropped customers."""
    paths, queries = _run_etl(x)
    etl.await_all(queries)

    def counted(name: str, df: DataFrame, key: str, n: Column) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("key")).agg(n.alias("n_rows")).select(F.lit(name).alias("part"), "key", "n_rows")

    rows = F.count(F.lit(1))
    return (
        counted("archive", sinks.read_archive(x.spark, paths.archive), "date", rows)
        .unionByName(counted("quarantine", sinks.read_archive(x.spark, paths.quarantine), "voltage", rows))
        .unionByName(counted("meters", x.spark.read.parquet(paths.meters), "meter_id", rows))
        .unionByName(counted("dropped", sinks.read_archive(x.spark, paths.dropped), "customer_id", F.sum("n_rows")))
    )


@query
def stream_progress(x: Tables) -> DataFrame:
    """Input rows of the whole run, over however many batches."""
    paths = etl.EtlPaths(storage.work_dir(x.spark, "progress"))
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())

    def archive(batch: DataFrame, batch_id: int) -> None:
        sinks.archive_batch(batch, batch_id, paths.archive)

    with progress.ProgressLog(x.spark, paths.progress) as log:
        queries = {"archive": sinks.foreach_batch(etl.enriched_stream(raw), archive, paths.checkpoint, ONCE)}
        etl.await_all(queries)
        return log.read(queries).groupBy("query").agg(F.sum("n_input_rows").alias("n_input_rows"))


@query
def stream_row_fates(x: Tables) -> DataFrame:
    """Rows kept, quarantined and dropped by the load, as counted on its running batches."""
    with progress.ProgressLog(x.spark, storage.work_dir(x.spark, "fates")) as log:
        _, queries = _run_etl(x)
        etl.await_all(queries)
        counts = log.read_observed(queries).filter("observation = 'fates'")
        return counts.groupBy(F.col("metric").alias("fate")).agg(F.sum("value").alias("n_rows"))


@query
def stream_status(x: Tables) -> DataFrame:
    """Two queries over the messages, of which one stops with an error: their state, and the rows that the other read."""
    paths = etl.EtlPaths(storage.work_dir(x.spark, "status"))
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())

    def archive(batch: DataFrame, batch_id: int) -> None:
        sinks.archive_batch(batch, batch_id, paths.archive)

    def refuse(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError("sink is down")

    with progress.ProgressLog(x.spark, paths.progress) as log:
        parsed = enrich.parse_json(raw)
        queries = {"archive": sinks.foreach_batch(parsed, archive, paths.checkpoint_archive, ONCE)}
        queries["refused"] = sinks.foreach_batch(parsed, refuse, paths.checkpoint_refused, ONCE)
        for running in queries.values():
            try:
                running.awaitTermination()
            except StreamingQueryException:
                pass  # its error is what the status shows
        rows = log.read(queries).groupBy("query").agg(F.sum("n_input_rows").alias("n_input_rows"))
        state = progress.status_rows(x.spark, queries)
    return state.join(rows, "query", "left").select("query", "active", F.col("error").contains("sink is down").alias("sink_down"), "n_input_rows")


def _closed_stream(x: Tables, job: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """What a watermark job has emitted when all its windows are closed: the readings come as a stream, then one reading
    of no meter, so late that it closes every window. The delay covers the whole history, so none is late, however
    the stream is cut."""
    paths = etl.EtlPaths(storage.work_dir(x.spark, name))
    rows = x.loaded_stream.select("meter_id", "customer_id", F.col("reading_ts").alias("timestamp"), "kwh_usage")
    rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows.write.parquet(paths.readings)
    first, last = x.spark.read.parquet(paths.readings).agg(F.min("timestamp"), F.max("timestamp")).first()
    if first is None:
        first = last = dt.datetime(2000, 1, 1)
    span = (last - first).days + 2
    closing = x.spark.createDataFrame([(None, None, last + dt.timedelta(2 * span + 30), None)], rows.schema)

    def run() -> None:
        stream = x.spark.readStream.schema(rows.schema).options(**BATCH_SIZE).parquet(paths.readings)
        sinks.append_lake_stream(job(stream, f"{span} days"), paths.out, "parquet", paths.checkpoint, ONCE).awaitTermination()

    run()
    closing.write.mode("append").parquet(paths.readings)
    run()
    return x.spark.read.parquet(paths.out)


@query
def stream_sliding_counts(x: Tables) -> DataFrame:
    """Readings of each customer per day, a day beginning every six hours."""
    return _closed_stream(x, lambda s, delay: summary.sliding_counts(s, "1 day", "6 hours", delay), "sliding")


@query
def stream_reading_sessions(x: Tables) -> DataFrame:
    """Stretches of each meter's readings that are less than three hours apart."""
    return _closed_stream(x, lambda s, delay: summary.reading_sessions(s, "3 hours", delay), "sessions")


@query
def stream_closed_days(x: Tables) -> DataFrame:
    """The daily summary as its watermark form emits it."""
    priced = lambda s, delay: summary.stream_daily_summary(s.withColumns({"voltage": F.lit(230), "cost": F.col("kwh_usage") * 0.25}), delay)
    return _closed_stream(x, priced, "closed-days").drop("avg_voltage")


def _typed_stream(x: Tables) -> DataFrame:
    raw = readers.read_topic(x.spark, "parquet", BATCH_SIZE, path=x.stored_topic())
    numbered = raw.withColumn("reading_id", F.col("offset") * TOPIC_PARTITIONS + F.col("partition"))
    return enrich.parse_json(numbered, keep=("reading_id",)).withColumnRenamed("timestamp", "reading_ts")


@query
def stream_high_usage_alerts(x: Tables) -> DataFrame:
    paths = etl.EtlPaths(storage.work_dir(x.spark, "alerts"))
    alerts.watch_high_usage(_typed_stream(x), paths.alerts, paths.checkpoint, ONCE, 100).awaitTermination()
    return sinks.read_archive(x.spark, paths.alerts).select("reading_id", "customer_id", "kwh_usage")


@query
def stream_usage_anomalies(x: Tables) -> DataFrame:
    paths = etl.EtlPaths(storage.work_dir(x.spark, "anomalies"))
    readings = _typed_stream(x).withColumn("kwh_usage", F.col("kwh_usage").cast("decimal(10,4)"))
    alerts.backfill_anomalies(readings, paths.root, ONCE)
    return sinks.read_archive(x.spark, paths.anomalies).drop("batch_id")


@query
def anomaly_at_arrival(x: Tables) -> DataFrame:
    """Readings in the order of their numbers, each judged by what had come before it and itself."""
    return usage.anomaly_at_arrival(x.loaded_stream, [F.col("reading_id")])


@query
def stream_anomaly_at_arrival(x: Tables) -> DataFrame:
    """The same on a stream: what arrives in two steps, in the order of the numbers, is judged in two batches."""
    paths = etl.EtlPaths(storage.work_dir(x.spark, "arrivals"))
    rows = x.loaded_stream.select("customer_id", "reading_id", "reading_ts", "kwh_usage")
    middle = rows.agg(F.avg("reading_id").alias("m"))
    for later in (False, True):
        half = rows.join(F.broadcast(middle), (F.col("reading_id") > F.col("m")) == F.lit(later)).drop("m")
        half.write.mode("append").parquet(paths.readings)
        arrivals = x.spark.readStream.schema(rows.schema).parquet(paths.readings)
        alerts.watch_anomalies(arrivals, paths.root, paths.checkpoint, ONCE).awaitTermination()
    return sinks.read_archive(x.spark, paths.anomalies).drop("batch_id")


@query
def readings_with_address(x: Tables) -> DataFrame:
    """Every reading with each address that its customer had at that time; the times of addresses overlap, some are open."""
    until = F.when(F.col("address_id") % 7 == 0, None).otherwise(F.expr("date_add(start_date, CAST(address_id % 300 AS INT))"))
    periods = x.addresses.select("customer_id", "address_id", "address", "start_date", until.alias("end_date"))
    readings = x.readings.select("reading_id", "customer_id", "reading_ts", "kwh_usage")
    rows = intervals.interval_join(readings, "reading_ts", periods, "start_date", "end_date", "customer_id")
    return rows.select("reading_id", "customer_id", "reading_ts", "kwh_usage", "address_id", "address")


@query
def stream_refresh_mv(x: Tables) -> DataFrame:
    """A view that is recomputed when weather arrives on a stream."""
    paths = etl.EtlPaths(storage.work_dir(x.spark, "mv-energy"))
    x.weather.write.parquet(paths.weather)
    arrivals = x.spark.readStream.schema(x.weather.schema).parquet(paths.weather)

    def build() -> DataFrame:
        return weather.energy_weather_daily(x.readings, x.spark.read.parquet(paths.weather))

    sinks.refresh_on_arrival(arrivals, build, paths.view, paths.checkpoint, ONCE).awaitTermination()
    return x.spark.read.parquet(paths.view).drop("v")


@query
def stream_daily_summary(x: Tables) -> DataFrame:
    """All customer-days, open ones too."""
    readings = enrich.enrich(_typed_stream(x), ts="reading_ts")
    paths = etl.EtlPaths(storage.work_dir(x.spark, "daily-summary"))
    summary.watch_daily_summary(readings, paths.root, paths.checkpoint, ONCE, ts="reading_ts").awaitTermination()
    return summary.read_daily_summary(x.spark, paths.root)


@query
def stream_drop_duplicates(x: Tables) -> DataFrame:
    keyed = _typed_stream(x).withColumn("reading_hour", F.date_trunc("hour", "reading_ts"))
    paths = etl.EtlPaths(storage.work_dir(x.spark, "unique-readings"))

    def append(batch: DataFrame, batch_id: int) -> None:
        sinks.append_new(batch, batch_id, paths.rows, HOUR_KEY, "reading_ts", "yyyy-MM-dd", ["reading_id"])

    sinks.foreach_batch(keyed, append, paths.checkpoint, ONCE).awaitTermination()
    return sinks.read_unique(x.spark, paths.rows).select(*HOUR_KEY)
