from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kilowise.functions.ranking import add_ntile, add_rank_desc
from kilowise.functions.running import sums_around
from kilowise.operators import usage

SCHEMA = "customer_id string, meter_id string, region string, reading_id long, reading_ts timestamp, kwh_usage decimal(10,4)"


def readings(spark, rows):
    full = [(c, f"m-{c}", "North", i, dt.datetime.fromisoformat(t), Decimal(k)) for i, (c, t, k) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def test_rank_keeps_ties_and_restarts_per_group(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.randint(0, 4), i) for i in range(300)]
    # One value holds a third of a group.
    rows += [("a", 2, 1000 + i) for i in range(150)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    got = {r["id"]: r["rk"] for r in add_rank_desc(df, "g", "v", "id", "rk").collect()}
    want = {i: 1 + sum(1 for g2, v2, _ in rows if g2 == g and v2 > v) for g, v, i in rows}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 103])
def test_ntile(spark, n):
    df = spark.range(n).withColumn("v", (F.col("id") * 7) % 11)
    got = {r["id"]: r["t"] for r in add_ntile(df, 4, [F.col("v"), F.col("id")], "t").collect()}
    order = sorted(range(n), key=lambda i: ((i * 7) % 11, i))
    size, extra = divmod(n, 4)
    want, start = {}, 0
    for tile in range(1, 5):
        stop = start + size + (tile <= extra)
        want |= {i: tile for i in order[start:stop]}
        start = stop
    assert got == want


def test_sums_around(spark):
    rng = random.Random(3)
    day0 = dt.date(2023, 1, 1)
    days = sorted({(rng.choice("xy"), rng.randint(0, 40)) for _ in range(40)})
    values = {k: rng.randint(1, 9) for k in days}
    points = sorted({(rng.choice("xyz"), rng.randint(0, 42)) for _ in range(30)})
    d = spark.createDataFrame([(k, day0 + dt.timedelta(n), values[k, n]) for k, n in days], "k string, d date, v int")
    p = spark.createDataFrame([(k, day0 + dt.timedelta(n), f"{k}{n}") for k, n in points], "k string, at date, name string")
    got = {r["name"]: (r["v_before"], r["v_eve"], r["v_all"]) for r in sums_around(p, "at", d, "d", "k", ["v"]).collect()}
    want = {
        f"{k}{n}": (
            sum(v for (k2, m), v in values.items() if k2 == k and m < n),
            values.get((k, n - 1), 0),
            sum(v for (k2, _), v in values.items() if k2 == k),
        )
        for k, n in points
    }
    assert got == want


def test_consecutive_months_stop_at_gap(spark):
    r = readings(
        spark,
        [
            ("a", "2023-01-05", "1"), ("a", "2023-01-09", "2"), ("a", "2023-02-01", "4"), ("a", "2023-04-01", "8"),
            ("b", "2023-02-01", "1"), ("b", "2022-12-01", "1"), ("c", "2022-12-31", "1"), ("c", "2023-01-31", "5"),
        ],
    )
    rows = [tuple(x) for x in usage.consecutive_month_usage(r, "2023-01-15").collect()]
    assert rows == [
        ("a", dt.date(2023, 1, 1), Decimal("3.0000")),
        ("a", dt.date(2023, 2, 1), Decimal("4.0000")),
        ("c", dt.date(2023, 1, 1), Decimal("5.0000")),
    ]


def test_single_reading_is_no_anomaly(spark):
    rows = [("one", "2023-01-01", "9999")] + [("many", f"2023-01-{d:02d}", "1") for d in range(1, 20)]
    rows.append(("many", "2023-02-01", "100"))
    found = usage.usage_anomaly_3sigma(readings(spark, rows)).collect()
    assert [(r["customer_id"], r["kwh_usage"], r["avg_usage"]) for r in found] == [("many", Decimal("100.0000"), 5.95)]


def test_spikes_use_strict_limit(spark):
    r = readings(spark, [("a", "2023-01-01", "1"), ("a", "2023-01-02", "1"), ("a", "2023-01-03", "1"), ("b", "2023-01-01", "5")])
    assert usage.usage_spikes(r).count() == 0
    assert usage.usage_spikes(r, 0).count() == 4


def test_missing_days(spark):
    r = readings(spark, [("a", "2023-01-30 23:00", "1"), ("a", "2023-02-02 01:00", "1"), ("b", "2023-01-01", "1")])
    m = spark.createDataFrame([("m-a", "LEGACY")], "meter_id string, meter_type string")
    rows = [tuple(x) for x in usage.missing_days(r, m).collect()]
    assert rows == [("m-a", dt.date(2023, 1, 31), "LEGACY"), ("m-a", dt.date(2023, 2, 1), "LEGACY")]


def test_number_series_and_json_rows(spark):
    assert [r["n"] for r in usage.number_series(spark, 5).collect()] == [1, 2, 3, 4, 5]
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert usage.as_json_rows(df).first()[0] == '{"a":1,"b":null}'


def test_previews_have_total_order(spark):
    r = readings(spark, [("a", "2023-01-02", "1"), ("a", "2023-01-01", "1"), ("b", "2023-01-03", "2")])
    c = spark.createDataFrame([("a", "x", "PEAK"), ("b", "y", "PEAK")], "customer_id string, office_address string, tariff_type string")
    assert [x["reading_ts"].day for x in usage.usage_customer_profile(r, c, 2).collect()] == [1, 2]


def test_region_filter_takes_a_list(spark):
    df = spark.createDataFrame([("Auckland",), ("Dunedin",), ("Hamilton",), (None,)], "region string")
    assert usage.region_filter(df, ["Auckland", "Dunedin"]).count() == 2


def test_quarter_mixes_years(spark):
    r = readings(spark, [("a", "2022-01-02", "1"), ("a", "2023-02-01", "3"), ("a", "2023-04-01", "5")])
    rows = {(x["quarter"], x["region"]): x["avg_consumption"] for x in usage.quarterly_consumption(r).collect()}
    assert rows == {(1, "North"): 2.0, (2, "North"): 5.0}


def test_rank_over_runs_that_span_tasks(spark):
    """Few values, many rows: runs of equal values begin in one task and end in others."""
    from pyspark.sql import Window

    from kilowise.functions.ranking import add_rank_desc

    rows = [(i, None if i % 11 == 0 else f"g{i % 3}", None if i % 7 == 0 else (i * i) % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["id"]: r["r"] for r in add_rank_desc(df, "g", "v", "id", "r").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    window = Window.partitionBy("g").orderBy(F.desc_nulls_first("v"))
    assert found == {r["id"]: r["r"] for r in df.withColumn("r", F.rank().over(window)).collect()}
