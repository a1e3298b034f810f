"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES a
comma-separated choice ("all" for every query).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from kilowise.plans.registry import QUERIES
from kilowise.plans.storage import clean_up
from kilowise.session import build_session

HEADLINE = (
    "monthly_billing", "monthly_billing_all_months", "recompute_bills", "billing_validation", "billing_dashboard",
    "monthly_running_total_rank", "usage_vs_regional_avg", "consecutive_month_usage", "top10_days_per_region",
    "customer_share_of_region", "top_usage_quartile", "hourly_peak_by_temp_band", "above_average_customers",
    "usage_anomaly_3sigma", "daily_consumption_trend", "weather_impact", "weather_correlation",
    "energy_weather_daily", "usage_weather", "usage_customer_profile", "energy_profile", "meter_health",
    "meter_type_benchmark", "meter_hierarchy_count", "churn_risk", "tariff_migration", "address_change_impact",
    "missing_days", "enrich_readings", "upsert_readings", "customer_audit_log", "check_foreign_keys",
    "stream_etl_store", "stream_usage_anomalies", "stream_daily_summary",
    "anomaly_at_arrival", "readings_with_address", "read_multiline_dump", "stream_sliding_counts", "sql_meter_descendants",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["check_not_null"](spark, folder).collect()  # start the JVM's machinery
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": f"total seconds of {len(seconds)} queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    clean_up(spark)
    spark.stop()


if __name__ == "__main__":
    main()
