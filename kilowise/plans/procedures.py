"""Procedures: SQL scripts with variables, dynamic statements and condition handlers.

Spark has scripts, but no statement that stores them under a name, so they are stored here and called by name. What a
script changes it writes aside; it becomes visible when the script has come to its end, so a call that fails
leaves the tables as they were and its handler leaves a row in the log.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from kilowise.plans.storage import publish_view, remove, work_dir

# Parameters are named markers; ``target`` and ``log`` are folders. A script ends with one row: whether it was done.
PROCEDURES = {
    "generate_monthly_bills": """
    BEGIN
        DECLARE first_day DATE DEFAULT trunc(CAST(:month AS DATE), 'MM');
        DECLARE folder STRING DEFAULT :target;
        EXECUTE IMMEDIATE 'INSERT OVERWRITE DIRECTORY \\'' || folder || '\\' USING parquet
            WITH used AS (
                SELECT customer_id, sum(kwh_usage) AS kwh, sum(kwh_usage) FILTER (WHERE is_peak_hours) AS high, sum(kwh_usage) FILTER (WHERE NOT is_peak_hours) AS low
                FROM fact_meter_readings WHERE reading_ts >= :first_day AND reading_ts < add_months(:first_day, 1) GROUP BY customer_id)
            SELECT :first_day AS billing_month, c.customer_id, CAST(kwh AS DECIMAL(20,4)) AS total_kwh,
                   CAST(if(kwh IS NULL, NULL, coalesce(high, 0) * peak_rate_per_kwh + coalesce(low, 0) * offpeak_rate_per_kwh)
                        * (1 - discount_pct / 100) AS DECIMAL(20,2)) AS amount_due, discount_pct AS discount_applied
            FROM dim_customer c LEFT JOIN used USING (customer_id) LEFT JOIN dim_tariff ON tariff_type = tariff_code'
            USING first_day AS first_day;
        SELECT true AS done;
    END
    """,
    "log_and_update": """
    BEGIN
        DECLARE folder STRING DEFAULT :target;
        DECLARE log_folder STRING DEFAULT :log;
        DECLARE address STRING DEFAULT :address;
        DECLARE email STRING DEFAULT :email;
        DECLARE EXIT HANDLER FOR SQLEXCEPTION
        BEGIN
            EXECUTE IMMEDIATE 'INSERT OVERWRITE DIRECTORY \\'' || log_folder || '\\' USING parquet
                SELECT \\'log_and_update\\' AS name, :address AS address, :email AS email' USING address AS address, email AS email;
            SELECT false AS done;
        END;
        EXECUTE IMMEDIATE 'INSERT OVERWRITE DIRECTORY \\'' || folder || '\\' USING parquet
            SELECT customer_id, office_address, tariff_type, region,
                   if(office_address <=> :address, if(:email LIKE \\'%_@_%\\', :email, raise_error(\\'not an e-mail\\')), email) AS email
            FROM dim_customer' USING address AS address, email AS email;
        SELECT true AS done;
    END
    """,
}


def call(spark: SparkSession, name: str, args: Mapping[str, object], target: str, log: str | None = None) -> bool:
    """Run a procedure over the tables that are bound as views, and replace the view folder ``target`` by what it wrote.
    False if its handler took an error: then ``target`` is as before and ``log`` holds a row of the call."""
    aside, call_log = work_dir(spark, name), f"{log}/call={uuid.uuid4().hex}"
    for path in (aside, call_log):
        if "'" in path or "\\" in path:
            raise ValueError(f"a folder's name with quotes or backslashes: {path}")
    folders = {"target": aside} if log is None else {"target": aside, "log": call_log}
    done = spark.sql(PROCEDURES[name], args={**args, **folders}).first()["done"]
    if done:
        publish_view(spark.read.parquet(aside), target)
    remove(spark, aside)
    return done


def read_result(spark: SparkSession, target: str) -> DataFrame:
    """What the calls so far have left in a view folder."""
    return spark.read.parquet(target).drop("v")
