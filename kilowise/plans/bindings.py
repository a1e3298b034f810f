"""The domain tables, bound to a folder of order, customer, part and event tables.

Joins run from the larger table to base tables, whose file sizes Spark knows; it
broadcasts those below its threshold and shuffles the others.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans import storage
from kilowise.sources.readers import topic_messages

TOPIC_PARTITIONS = 4

# The tariff table.
# code, name, peak rate, off-peak rate, daily charge, discount %, current
TARIFFS = (
    ("AUTOMOBILE", "Peak", "0.28", "0.18", "1.20", "0", "TRUE"),
    ("BUILDING", "OffPeak", "0.32", "0.15", "1.00", "5", "TRUE"),
    ("HOUSEHOLD", "TimeOfUse", "0.35", "0.12", "0.80", "10", "TRUE"),
    ("MACHINERY", "LowUser", "0.30", "0.20", "0.60", "0", "FALSE"),
)

TARIFF_SQL = """
SELECT tariff_code, tariff_name, CAST(p AS DECIMAL(8,4)) AS peak_rate_per_kwh,
       CAST(o AS DECIMAL(8,4)) AS offpeak_rate_per_kwh, CAST(f AS DECIMAL(8,2)) AS daily_fixed_charge,
       CAST(d AS DECIMAL(5,2)) AS discount_pct, is_current
FROM (VALUES {rows}) AS t(tariff_code, tariff_name, p, o, f, d, is_current)
""".format(rows=", ".join("('{}', '{}', '{}', '{}', '{}', '{}', {})".format(*row) for row in TARIFFS))


class Tables:
    """Domain tables over the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _with_region(self, df: DataFrame) -> DataFrame:
        return df.join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._with_region(self.raw("customer")).selectExpr(
            "c_custkey AS customer_id",
            "n_name AS office_address",
            "c_mktsegment AS tariff_type",
            "concat(c_name, '@example.com') AS email",
            "r_name AS region",
        )

    @cached_property
    def tariffs(self) -> DataFrame:
        return self.spark.sql(TARIFF_SQL)

    @cached_property
    def meters(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS meter_id",
            "p_partkey AS customer_id",
            "p_type AS meter_type",
            "p_brand AS manufacturer",
            "p_size % 5 <> 0 AS is_active",
            "CASE WHEN p_partkey = 0 THEN NULL ELSE CAST(floor((p_partkey - 1) / 2.0) AS BIGINT) END"
            " AS parent_meter_id",
            "CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'PROMO') THEN 'Commercial'"
            " WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Residential' ELSE 'Unrated' END AS meter_class",
            "date_add(DATE '1996-01-01', CAST(p_partkey % 1000 AS INT)) AS installation_date",
            "CASE p_size % 4 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'HOUSEHOLD'"
            " ELSE 'MACHINERY' END AS tariff_type",
        )

    @cached_property
    def readings(self) -> DataFrame:
        # Orders find their customer and region first, so that the lines, by far the
        # larger table, move once at most.
        orders = self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        owners = self._with_region(orders).select("o_orderkey", "o_custkey", "r_name")
        owners = broadcast_if_small(owners)
        return self.raw("lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "l_orderkey * 10 + l_linenumber AS reading_id",
            "l_partkey AS meter_id",
            "o_custkey AS customer_id",
            "l_shipdate AS reading_ts",
            "CAST(l_quantity AS DECIMAL(10,4)) AS kwh_usage",
            "220 + l_linenumber * 5 AS voltage",
            "CAST(1 - l_discount AS DECIMAL(4,2)) AS power_factor",
            "r_name AS region",
            "l_returnflag = 'R' AS is_peak_hours",
            "l_linestatus AS weather_condition",
            "round(l_discount * 100) * 3 AS temperature_c",
        )

    @cached_property
    def weather(self) -> DataFrame:
        days = self.raw("lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
        # Every region observes every day: five region rows in an array, no join.
        regions = self.raw("region").agg(F.collect_list(F.struct("r_regionkey", "r_name"))).scalar()
        return days.select("d", F.inline(regions)).selectExpr(
            "r_name AS region",
            "d AS observation_date",
            "CAST((dayofyear(d) * 7 + r_regionkey * 11) % 350 AS DOUBLE) / 10 AS mean_temp_c",
            "CAST((dayofyear(d) * 13 + r_regionkey * 5) % 150 AS DOUBLE) / 10 AS rainfall_mm",
            "CAST((dayofyear(d) * 7 + r_regionkey * 11) % 350 AS DOUBLE) / 10 + dayofyear(d) % 7 AS max_temp_c",
            "CAST((dayofyear(d) * 7 + r_regionkey * 11) % 350 AS DOUBLE) / 10 - dayofyear(d) % 5 AS min_temp_c",
            "CASE WHEN dayofyear(d) % 3 = 0 THEN 'Rainy' ELSE 'Sunny' END AS weather_condition",
        )

    @cached_property
    def bills(self) -> DataFrame:
        rows = self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return self._with_region(rows).selectExpr(
            "o_orderkey AS bill_id",
            "o_custkey AS customer_id",
            "CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_month",
            "CAST(CAST(floor((round(o_totalprice * 100) + 500) / 1000) AS DECIMAL(12,0))"
            " * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS total_kwh",
            "CAST(CAST(floor((round(o_totalprice * 100) + 1250) / 2500) AS DECIMAL(12,0))"
            " * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS peak_kwh",
            "CAST(CAST(floor((round(o_totalprice * 100) + 1250) / 2500) AS DECIMAL(12,0))"
            " * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS offpeak_kwh",
            "CAST(o_totalprice AS DECIMAL(12,2)) AS amount_due",
            "CASE WHEN o_orderstatus = 'P' THEN NULL"
            " ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 45 AS INT)) END AS payment_date",
            "CASE WHEN o_orderstatus = 'O' THEN 10 ELSE 0 END AS late_fee",
            "CAST(o_orderkey % 4 * 5 AS DECIMAL(5,2)) AS discount_pct",
            "CAST(o_orderkey % 4 AS DECIMAL(10,2)) AS discount_applied",
            "r_name AS region",
        )

    @cached_property
    def addresses(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS address_id",
            "o_custkey AS customer_id",
            "o_orderpriority AS address",
            "CAST(o_orderdate AS DATE) AS start_date",
            "CASE o_orderkey % 3 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' ELSE 'HOUSEHOLD' END AS tariff_type",
        )

    @cached_property
    def stream_readings(self) -> DataFrame:
        return (
            self.raw("events")
            .join(self.raw("region"), F.expr("user_id % 5 = r_regionkey"))
            .selectExpr(
                "event_id",
                "user_id AS meter_id",
                "user_id AS customer_id",
                "ts AS reading_ts",
                "value AS kwh_usage",
                "CAST(220 + 5 * (event_id % 8) AS INT) AS voltage",
                "r_name AS region",
            )
        )

    @cached_property
    def loaded_stream(self) -> DataFrame:
        """Stream readings in fact form."""
        return self.stream_readings.withColumn("kwh_usage", F.col("kwh_usage").cast("decimal(10,4)")).withColumn(
            "reading_id", F.col("event_id")
        )

    @cached_property
    def topic(self) -> DataFrame:
        """Stream readings as messages of a topic."""
        when = F.date_format("reading_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        fields = [
            F.col("meter_id").cast("string").alias("meter_id"),
            when.alias("timestamp"),
            "kwh_usage",
            "voltage",
            F.col("customer_id").cast("string").alias("customer_id"),
            "region",
        ]
        return topic_messages(self.stream_readings, "smart_meter_data", "event_id", "reading_ts", fields, TOPIC_PARTITIONS)

    def stored_topic(self) -> str:
        """The messages as files, for a file stream; written once per application and folder."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in storage._TOPICS:
            path = storage.work_dir(self.spark, "topic")
            # Several files in the order of the event times, as a topic is filled.
            self.topic.repartitionByRange("timestamp", "offset").write.parquet(path)
            storage._TOPICS[key] = path
        return storage._TOPICS[key]
