from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilowise.functions.columns import PEAK_RULES, is_peak, temp_band, temperature_range
from kilowise.operators import enrich
from tests.conftest import topic


@pytest.mark.parametrize("voltage,expected", [(240, False), (250, False), (251, True), (300, True), (None, False)])
def test_voltage_limit(spark, voltage, expected):
    df = spark.createDataFrame([("x", voltage)], "meter_id string, voltage int")
    assert enrich.voltage_anomaly(df).first()["is_anomaly"] is expected


def test_voltage_anomaly_keeps_rows_and_column(spark):
    rows = [("q1", 244), ("q2", 287), ("q3", 250)]
    df = spark.createDataFrame(rows, "meter_id string, voltage int")
    flagged = {r["meter_id"]: r["is_anomaly"] for r in enrich.voltage_anomaly(df).collect()}
    assert flagged == {"q1": False, "q2": True, "q3": False}
    empty = enrich.voltage_anomaly(df.limit(0))
    assert empty.count() == 0 and "is_anomaly" in empty.columns


def test_parse_json(messages):
    rows = enrich.parse_json(messages, keep=("offset",)).orderBy("offset").collect()
    assert [r["meter_id"] for r in rows] == ["k-17", "k-18", "k-19", "k-20", None]
    assert rows[4]["timestamp"] is None and rows[4]["region"] is None
    assert rows[0]["timestamp"] == dt.datetime(2021, 3, 4, 6, 30)


def test_parse_json_aliases_and_float_voltage(spark):
    body = {"meter_id": "m", "timestamp": "2022-09-30T23:59:58.000321Z", "energy_consumption": 1.25, "voltage": 230.0}
    row = enrich.parse_json(topic(spark, [body])).first()
    assert row["kwh_usage"] == 1.25 and row["voltage"] == 230 and row["customer_id"] is None
    assert row["timestamp"] == dt.datetime(2022, 9, 30, 23, 59, 58, 321)


def test_parse_json_tuple(spark):
    bodies = [{"meter_id": "a", "voltage": 230, "timestamp": "t"}, {"meter_id": "b", "kwh_usage": 6.5}]
    rows = enrich.parse_json_tuple(topic(spark, bodies)).collect()
    assert [tuple(r) for r in rows] == [("a", "230", "t"), ("b", None, None)]


def test_required_fields(parsed):
    kept, rejected = enrich.required_fields(parsed)
    assert kept.count() == parsed.count() - 1 and rejected.count() == 1


def test_enrich(parsed):
    rows = {r["meter_id"]: r for r in enrich.enrich(parsed).collect()}
    assert set(rows) == {"k-17", "k-18", "k-19", "k-20"}
    assert rows["k-17"]["cost"] == pytest.approx(2.75 * 0.23)
    assert rows["k-18"]["cost"] == pytest.approx(0.8 * 0.25)
    assert rows["k-19"]["cost"] == pytest.approx(-0.4 * 0.20)
    assert not rows["k-20"]["is_valid_voltage"] and not rows["k-19"]["is_valid_kwh"]
    assert rows["k-17"]["data_quality_flag"] == "VALID" and rows["k-20"]["data_quality_flag"] == "INVALID"
    first = rows["k-17"]
    assert (first["date"], first["hour_of_day"], first["day_of_week"]) == (dt.date(2021, 3, 4), 6, 5)
    assert not first["is_weekend"] and not first["is_peak"] and first["source_system"] == "kafka_stream"


def test_missing_region_uses_default_rate(spark):
    df = spark.createDataFrame([(None, 10.0)], "region string, kwh_usage double")
    assert enrich.region_cost(df).first()["cost"] == pytest.approx(2.0)


@pytest.mark.parametrize("voltage,valid", [(230, True), (240, True), (250, False), (0, False), (None, False)])
def test_valid_voltage(spark, voltage, valid):
    df = spark.createDataFrame([(voltage, 1.0)], "voltage int, kwh_usage double")
    assert enrich.quality_flag(df).first()["is_valid_voltage"] is valid


@pytest.mark.parametrize(
    "kwh,valid", [(0.0, True), (10.0, True), (20.0, True), (-1.0, False), (21.0, False), (None, False)]
)
def test_valid_kwh(spark, kwh, valid):
    df = spark.createDataFrame([(230, kwh)], "voltage int, kwh_usage double")
    row = enrich.quality_flag(df).first()
    assert row["is_valid_kwh"] is valid and row["data_quality_flag"] == ("VALID" if valid else "INVALID")


def test_peak_rules(spark):
    # 2023-01-02 is a Monday, 2023-01-01 a Sunday.
    hours = spark.range(24).select(
        F.col("id"),
        F.make_timestamp(*[F.lit(x) for x in (2023, 1, 2)], F.col("id"), F.lit(30), F.lit(0)).alias("mon"),
        F.make_timestamp(*[F.lit(x) for x in (2023, 1, 1)], F.col("id"), F.lit(30), F.lit(0)).alias("sun"),
    )

    def peak(rule, day):
        return {r["id"] for r in hours.filter(is_peak(day, rule)).collect()}

    assert set(PEAK_RULES) == {"evening", "daytime", "weekday_rush"}
    assert peak("evening", "sun") == set(range(17, 22))
    assert peak("daytime", "sun") == set(range(7, 22))
    assert peak("weekday_rush", "mon") == {7, 8, 17, 18, 19, 20} and peak("weekday_rush", "sun") == set()


def test_temperature_bands(spark):
    temps = [-0.1, 0.0, 9.9, 10.0, 20.0, 20.1, 30.0, 30.1, None]
    df = spark.createDataFrame([(t,) for t in temps], "t double")
    rows = df.select(temperature_range("t").alias("r"), temp_band("t").alias("b")).collect()
    assert [r["r"] for r in rows] == [
        "Below 0°C", "0-10°C", "0-10°C", "0-10°C", "10-20°C", "20-30°C", "20-30°C", "Above 30°C", "Above 30°C",
    ]
    assert [r["b"] for r in rows] == ["Cold"] * 3 + ["Mild"] * 2 + ["Hot"] * 4


def test_high_usage_and_positive_cost(spark):
    df = spark.createDataFrame([("a", 1000.0), ("b", 1000.5), ("c", 4.5), ("d", -1.0), ("e", None)], "id string, kwh_usage double")
    assert [r["id"] for r in enrich.high_usage_alert(df).collect()] == ["b"]
    priced, rejected = enrich.positive_reading_cost(df)
    assert {r["id"]: r["cost"] for r in priced.collect()}["c"] == pytest.approx(4.5 * 0.28)
    assert {r["id"] for r in rejected.collect()} == {"d", "e"}


def test_clean_readings(spark):
    staging = spark.createDataFrame(
        [
            (1, "m", "c1", dt.datetime(2023, 5, 1, 7), None, None, None, None),
            (2, "m", "c1", dt.datetime(2023, 5, 1, 22), -3.0, 230.0, 1.0, 0.9),
            (3, "m", "zz", dt.datetime(2023, 5, 1, 8), 1.0, 230.0, 1.0, 0.9),
            (4, "m", "c1", dt.datetime(2023, 5, 2, 8), 1.0, 230.0, 1.0, 0.9),
        ],
        "reading_id int, meter_id string, customer_id string, reading_ts timestamp, kwh_usage double,"
        " voltage double, current_amps double, power_factor double",
    )
    c = spark.createDataFrame([("c1", "North")], "customer_id string, region string")
    w = spark.createDataFrame(
        [], "region string, observation_date date, weather_condition string, temperature_c double"
    )
    rows = {r["reading_id"]: r for r in enrich.clean_readings(staging, c, w, "2023-05-01").collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["kwh_usage"], rows[1]["voltage"], rows[1]["current_amps"], rows[1]["power_factor"]) == (0, 0, 0, 1)
    assert rows[1]["is_peak_hours"] and not rows[2]["is_peak_hours"] and rows[2]["kwh_usage"] == 0
    assert rows[1]["region"] == "North" and rows[1]["temperature_c"] is None
