"""Branches of the reports that the shared tables do not reach."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kilowise.operators import billing, customers, fleet, profiling, quality, weather
from tests.test_usage import readings

D = dt.date


def tariffs(spark):
    rows = [
        ("PEAK", "Peak", "0.28", "0.18", "1.20", "0", True),
        ("OFFPEAK", "OffPeak", "0.32", "0.15", "1.00", "10", True),
        ("OLD", "Old", "1", "1", "1", "0", False),
    ]
    names = "tariff_code tariff_name peak_rate_per_kwh offpeak_rate_per_kwh daily_fixed_charge discount_pct is_current".split()
    df = spark.createDataFrame(rows, names)
    return df.withColumns({c: F.col(c).cast("decimal(8,4)") for c in names[2:6]})


def people(spark, **tariff_of):
    rows = [(c, f"{c} street", t, f"{c}@mail.org", "North") for c, t in tariff_of.items()]
    return spark.createDataFrame(rows, "customer_id string, office_address string, tariff_type string, email string, region string")


def split_readings(spark):
    r = readings(
        spark,
        [("a", "2023-02-01", "10"), ("a", "2023-02-28 23:59", "5"), ("a", "2023-03-01", "99"), ("b", "2023-02-02", "7"),
         ("lost", "2023-02-02", "7"), ("old", "2023-02-02", "7")],
    )
    return r.withColumn("is_peak_hours", F.col("kwh_usage") >= 7)


def test_monthly_billing(spark):
    c = people(spark, a="PEAK", b="TIME_OF_USE", old="OLD", idle="PEAK")
    rows = billing.monthly_billing(split_readings(spark), c, tariffs(spark), "2023-02-14").collect()
    assert len(rows) == 1
    row = rows[0].asDict()
    # 10 * 0.28 + 5 * 0.18 + 28 days * 1.20
    assert row == {
        "customer_id": "a", "billing_month": D(2023, 2, 1), "total_kwh": Decimal("15.0000"), "peak_kwh": Decimal("10.0000"),
        "offpeak_kwh": Decimal("5.0000"), "amount_due": Decimal("37.30"),
    }
    assert billing.monthly_billing(split_readings(spark), c, tariffs(spark), "2023-02-14", "South").count() == 0
    assert [r["customer_id"] for r in billing.tariff_unmatched(c, tariffs(spark)).collect()] == ["b"]


def test_generated_and_estimated_bills_cover_idle_customers(spark):
    c = people(spark, a="OFFPEAK", b="TIME_OF_USE", idle="PEAK")
    made = {r["customer_id"]: r for r in billing.generate_monthly_bills(split_readings(spark), c, tariffs(spark), "2023-02-01").collect()}
    assert set(made) == {"a", "b", "idle"}
    assert made["a"]["amount_due"] == Decimal("3.56")  # (10 * 0.32 + 5 * 0.15) less 10 %, half up
    assert made["idle"]["total_kwh"] is None and made["idle"]["amount_due"] is None and made["idle"]["discount_applied"] == 0
    assert made["b"]["amount_due"] is None and made["b"]["discount_applied"] is None
    b = spark.createDataFrame([("a", D(2023, 2, 1), Decimal("50"))], "customer_id string, billing_month date, discount_pct decimal(5,2)")
    got = {r["customer_id"]: r["estimated_bill"] for r in billing.estimated_bill(split_readings(spark), c, tariffs(spark), b, "2023-02-01").collect()}
    assert got == {"a": Decimal("1.98"), "b": None, "idle": None}


def test_recomputed_bill_is_null_without_usage(spark):
    c = people(spark, a="PEAK", idle="PEAK")
    b = spark.createDataFrame([(1, "a", D(2023, 2, 1)), (2, "idle", D(2023, 2, 1)), (3, "a", D(2023, 3, 1))], "bill_id int, customer_id string, billing_month date")
    got = {r["bill_id"]: r["amount_due"] for r in billing.recompute_bills(b, split_readings(spark), c, tariffs(spark), "2023-02-01").collect()}
    assert got == {1: Decimal("3.70"), 2: None}


def test_meter_charge_sets_unknown_classes_aside(spark):
    used = spark.createDataFrame([("m1", Decimal("10")), ("m2", Decimal("10")), ("m3", Decimal("1")), ("m9", Decimal("1"))], "meter_id string, kwh decimal(10,4)")
    m = spark.createDataFrame([("m1", "Commercial"), ("m2", "Residential"), ("m3", "Industrial")], "meter_id string, meter_class string")
    charged, rest = billing.meter_charge(used, m)
    assert {r["meter_id"]: float(r["charge"]) for r in charged.collect()} == {"m1": 1.5, "m2": 1.0}
    assert {r["meter_id"] for r in rest.collect()} == {"m3", "m9"}


def test_identical_bills_repeat_the_readings(spark):
    b = spark.createDataFrame([("a", D(2023, 2, 1), Decimal("10"), Decimal("5"))] * 2, "customer_id string, billing_month date, peak_kwh decimal(10,2), offpeak_kwh decimal(10,2)")
    row = billing.billing_validation(b, split_readings(spark)).first()
    assert (row["actual_peak"], row["peak_diff"]) == (20, -10)
    assert billing.billing_validation(b.limit(1), split_readings(spark)).count() == 0


def test_dashboard_repeats_bills_by_weather_row(spark):
    b = spark.createDataFrame([("a", D(2023, 2, 1), 10, 100, 1, "N"), ("b", D(2023, 2, 1), 5, 50, 0, "N"), ("a", D(2023, 3, 1), 7, 70, 0, "N")],
                              "customer_id string, billing_month date, total_kwh int, amount_due int, late_fee int, region string")
    w = spark.createDataFrame([("N", D(2023, 2, d), float(d)) for d in (1, 2, 6)], "region string, observation_date date, mean_temp_c double")
    got = {r["month"].month: tuple(r)[2:] for r in billing.billing_dashboard(b, w).collect()}
    assert got == {2: (2, 45, 450, 3, 3.0), 3: (1, 7, 70, 0, None)}
    once = {r["month"].month: tuple(r)[2:] for r in billing.billing_dashboard(b, w, False).collect()}
    assert once[2] == (2, 15, 150, 1, 3.0)


def test_meter_health_states(spark):
    m = spark.createDataFrame([(i, f"c{i}", i != "off") for i in ("none", "old", "low", "high", "fine", "off", "edge")], "meter_id string, customer_id string, is_active boolean")
    rows = [("old", "2023-01-01", "1"), ("low", "2023-01-09", "0.02"), ("high", "2023-01-10", "3"), ("fine", "2023-01-10", "1"), ("edge", "2023-01-03", "1")]
    r = readings(spark, rows).withColumn("meter_id", F.col("customer_id"))
    out = fleet.meter_health(m, r, "2023-01-10").collect()
    assert [x["meter_id"] for x in out][:3] == ["none", "old", "edge"]
    assert {x["meter_id"]: x["health_status"] for x in out} == {
        "none": "NO_READINGS", "old": "INACTIVE", "low": "LOW_USAGE", "high": "HIGH_USAGE", "fine": "HEALTHY", "edge": "HEALTHY",
    }


def test_hierarchy_leaves_out_circles_and_orphans(spark):
    chain = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(37)]
    odd = [("x", "y"), ("y", "z"), ("z", "x"), ("tail", "x"), ("orphan", "gone"), ("below", "orphan")]
    m = spark.createDataFrame(chain + odd, "meter_id string, parent_meter_id string")
    got = {r["meter_id"]: r["depth"] for r in fleet.meter_hierarchy(m).collect()}
    assert got == {f"n{i}": i for i in range(37)}
    assert fleet.meter_hierarchy_count(m).first()["n_meters"] == 37


def test_benchmark_counts_a_shared_reading_once(spark):
    r = readings(spark, [("a", "2023-01-01", "1"), ("b", "2023-01-01", "3"), ("b", "2023-01-02", "5")]).withColumns(
        {"reading_id": F.lit(1) + F.dayofmonth("reading_ts"), "power_factor": F.lit("0.90").cast("decimal(4,2)")})
    m = spark.createDataFrame([("m-a", "OLD", "ca"), ("m-b", "NEW", "cb")], "meter_id string, meter_type string, customer_id string")
    rows = {x["meter_type"]: x for x in fleet.meter_type_benchmark(r, m).collect()}
    assert rows["OLD"]["readings_count"] == 1 and rows["OLD"]["usage_volatility"] is None
    assert rows["NEW"]["readings_count"] == 2 and rows["NEW"]["usage_volatility"] == pytest.approx(2**0.5)
    assert rows[None]["readings_count"] == 2 and rows[None]["customers_served"] == 2 and rows[None]["avg_usage"] == 3.0


def test_churn_levels(spark):
    rows = [("high", None), ("slow", D(2023, 2, 5)), ("mid", D(2023, 1, 16)), ("low", D(2023, 1, 15)), ("edge", D(2023, 1, 31))]
    b = spark.createDataFrame([(c, D(2023, 1, 1), p) for c, p in rows], "customer_id string, billing_month date, payment_date date")
    c = people(spark, high="P", slow="P", mid="P", low="P", edge="P", none="P")
    got = {r["customer_id"]: r["churn_risk"] for r in customers.churn_risk(b, c).collect()}
    assert got == {"high": "High Risk", "slow": "High Risk", "mid": "Medium Risk", "edge": "Medium Risk", "low": "Low Risk"}


def test_move_report_with_ties_and_late_readings(spark):
    history = spark.createDataFrame(
        [(1, "a", "first", D(2023, 1, 1)), (2, "a", "second", D(2023, 1, 10)), (3, "a", "also", D(2023, 1, 10)), (4, "a", "last", D(2023, 2, 1)),
         (5, "b", "home", D(2023, 1, 1)), (6, "b", "new", D(2023, 1, 10))],
        "address_id int, customer_id string, address string, start_date date",
    )
    # 09 00:00 is inside the first stay, 09 12:00 is not.
    r = readings(spark, [("a", "2023-01-02", "2"), ("a", "2023-01-09", "4"), ("a", "2023-01-09 12:00", "100"), ("a", "2023-01-20", "6"), ("a", "2023-02-03", "8"),
                         ("b", "2023-01-01", "1"), ("b", "2023-01-10", "3")])
    rows = {(x["customer_id"], x["old_address"]): tuple(x)[2:] for x in customers.address_change_impact(history, r).collect()}
    assert rows == {
        ("a", "first"): ("second", 3.0, 7.0, pytest.approx(400 / 3)),
        ("a", "also"): (None, 6.0, 8.0, pytest.approx(100 / 3)),
        ("b", "home"): (None, 1.0, 3.0, 200.0),
    }


def test_tariff_migration_splits_at_every_change(spark):
    history = spark.createDataFrame([("a", "PEAK", D(2023, 1, 10)), ("a", "OFFPEAK", D(2023, 1, 20)), ("b", "PEAK", D(2023, 1, 5))],
                                    "customer_id string, tariff_type string, effective_date date")
    r = readings(spark, [("a", "2023-01-01", "1"), ("a", "2023-01-15", "2"), ("a", "2023-01-25", "4"), ("b", "2023-01-01", "1")])
    row = customers.tariff_migration(history, r, tariffs(spark), "2023-01-01", "2023-01-31").collect()
    # before: 1 | 1, 2; after: 2, 4 | 4
    old, new = 4 / 3, 10 / 3
    assert len(row) == 1
    bill = new * (0.32 * 0.7 + 0.15 * 0.3) + 30 - (old * (0.28 * 0.7 + 0.18 * 0.3) + 36)
    assert tuple(row[0]) == ("PEAK", "OFFPEAK", 1, round(new - old, 2), pytest.approx(bill, abs=0.005))


def test_masking_depends_on_role(spark):
    c = people(spark, a="PEAK").withColumn("email", F.lit("a.b@c.d"))
    assert customers.secure_customer_view(c, "data_analyst").first()["email"] == "****@****"
    assert customers.secure_customer_view(c, "admin").first()["email"] == "a.b@c.d"
    assert customers.secure_customer_view(c).first()["email"] == "a.b@c.d"
    info = customers.customer_details(c, tariffs(spark), ["a"]).first()[0]
    assert tuple(info) == ("a", "a street", "PEAK")


def test_weather_reports_with_two_stations(spark):
    r = readings(spark, [("a", "2023-01-01", "1"), ("b", "2023-01-01", "3"), ("a", "2023-01-02", "5")]).withColumn("is_peak_hours", F.lit(True))
    w = spark.createDataFrame([("North", D(2023, 1, 1), 5.0, 0.0), ("North", D(2023, 1, 1), 5.0, 0.0), ("North", D(2023, 1, 2), 15.0, 1.0)],
                              "region string, observation_date date, mean_temp_c double, rainfall_mm double")
    day = {x["day"].day: tuple(x)[4:] for x in weather.energy_weather_daily(r, w).collect()}
    assert day == {1: (8, 2, 4.0), 2: (5, 1, 5.0)}
    ranges = {x["temperature_range"]: (x["reading_count"], x["avg_kwh_usage"]) for x in weather.weather_impact(r, w, "North").collect()}
    assert ranges == {"0-10°C": (4, 2.0), "10-20°C": (1, 5.0)}
    joined = r.join(w, F.to_date("reading_ts") == F.col("observation_date"))
    want = joined.agg(F.corr(F.col("kwh_usage").cast("double"), "mean_temp_c")).first()[0]
    assert weather.weather_correlation(r, w).first()["temp_usage_correlation"] == pytest.approx(want)


def test_quality_rules(spark):
    df = spark.createDataFrame([("m", 230, 5, "VALID"), ("m", 250, 24, "ODD"), (None, None, None, None)], "meter_id string, voltage int, hour_of_day int, data_quality_flag string")
    count = lambda x: {r["rule"]: r["n_violations"] for r in x.collect()}
    assert count(quality.check_voltage_domain(df)) == {"voltage_domain": 1}
    assert count(quality.check_hour_range(df)) == {"hour_range": 1}
    assert count(quality.check_flag_domain(df)) == {"flag_domain": 1}
    assert count(quality.check_unique(df, ["meter_id"])) == {"unique_meter_ts": 1}
    assert count(quality.check_not_null(df, ["meter_id", "voltage"])) == {"not_null_meter_id": 1, "not_null_voltage": 1}
    parent = spark.createDataFrame([("x",)], "id string")
    assert count(quality.check_foreign_key(df, "meter_id", parent, "id", "fk")) == {"fk": 2}


def test_profiles(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("2",)], "col_4 string")
    assert tuple(profiling.total_usage(df, "col_4").first()) == (Decimal("3.500000"), 2)
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    bins = profiling.value_histogram(same, "v", 4).orderBy("bin").collect()
    assert [(b["bin"], b["n_rows"]) for b in bins] == [(1, 0), (2, 0), (3, 2), (4, 0)] and bins[0]["lo"] == 2.5
    hours = spark.createDataFrame([(dt.datetime(2023, 1, 1, 0, 5),), (dt.datetime(2023, 1, 1, 3),)], "ts timestamp")
    assert [r["n_rows"] for r in profiling.hourly_record_counts(hours, "ts").orderBy("hour").collect()] == [1, 0, 0, 1]
    same.createOrReplaceTempView("only_table")
    assert [tuple(r) for r in profiling.table_counts(spark, ["only_table", "nowhere"]).collect()] == [("only_table", 2)]
    with pytest.raises(ValueError):
        profiling.table_counts(spark, ["nowhere"])
    assert profiling.list_columns(df) == ["col_4"] and profiling.column_max(same, "v").first()[0] == 3.0
