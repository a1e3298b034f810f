from __future__ import annotations

import datetime as dt
import json

from kilowise.operators import changes

KEY = ("meter_id", "at")
SCHEMA = "meter_id string, at int, kwh_usage double, voltage int, cost double, data_quality_flag string, customer_id string, region string"


def test_upsert_keeps_first_and_updates_last(spark):
    target = spark.createDataFrame([("m", 1, 1.0, 230, 0.1, "VALID", "c-old", "r-old"), ("m", 2, 5.0, 230, 0.5, "VALID", "c", "r")], SCHEMA)
    updates = spark.createDataFrame(
        [("m", 1, 2.0, 240, 0.2, "VALID", "c-new", "r-new", 10), ("m", 1, 3.0, 0, 0.3, "INVALID", "c-x", "r-x", 11),
         ("n", 1, 7.0, 230, 0.7, "VALID", "first", "r1", 20), ("n", 1, 8.0, 240, 0.8, "VALID", "second", "r2", 21)],
        SCHEMA + ", arrival long",
    )
    got = {(r["meter_id"], r["at"]): tuple(r)[2:] for r in changes.upsert_readings(target, updates, KEY).collect()}
    want = {
        ("m", 1): (3.0, 0, 0.3, "INVALID", "c-old", "r-old"),
        ("m", 2): (5.0, 230, 0.5, "VALID", "c", "r"),
        ("n", 1): (8.0, 240, 0.8, "VALID", "first", "r1"),
    }
    assert got == want
    again = changes.upsert_readings(changes.upsert_readings(target, updates, KEY), updates, KEY)
    assert {(r["meter_id"], r["at"]): tuple(r)[2:] for r in again.collect()} == want


def test_upsert_takes_a_null_update(spark):
    target = spark.createDataFrame([("m", 1, 1.0, 230, 0.1, "VALID", "c", "r")], SCHEMA)
    updates = spark.createDataFrame([("m", 1, None, None, None, "INVALID", "c", "r", 1)], SCHEMA + ", arrival long")
    row = changes.upsert_readings(target, updates, KEY).first()
    assert row["kwh_usage"] is None and row["data_quality_flag"] == "INVALID" and row["customer_id"] == "c"


def test_new_meters_and_customers(spark):
    s = spark.createDataFrame([("m1", "c1"), ("m2", "zz"), ("m2", "zz"), (None, "c1")], "meter_id string, customer_id string")
    m = spark.createDataFrame([("m1",)], "meter_id string")
    c = spark.createDataFrame([("c1",)], "customer_id string")
    assert [tuple(r) for r in changes.register_new_meters(m, s, "2024-05-01").collect()] == [("m2", dt.date(2024, 5, 1), True)]
    assert changes.drop_unknown_customers(s, c).count() == 2
    assert [tuple(r) for r in changes.unknown_customers(s, c).collect()] == [("zz", 2)]


def test_audit_log(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "customer_id int, email string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "customer_id int, email string")
    rows = {r["customer_id"]: r for r in changes.customer_audit_log(old, new, "2024-02-03").collect()}
    assert {k: r["action_type"] for k, r in rows.items()} == {2: "UPDATE", 3: "DELETE", 4: "INSERT"}
    assert {r["changed_at"] for r in rows.values()} == {dt.date(2024, 2, 3)}
    assert json.loads(rows[2]["old_value"]) == {"customer_id": 2, "email": None} and rows[3]["new_value"] is None


def test_email_update(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id int, email string")
    u = spark.createDataFrame([(2, "new"), (9, "lost")], "customer_id int, email string")
    updated, unmatched = changes.update_customer_email(c, u)
    assert {tuple(r) for r in updated.collect()} == {(1, "a"), (2, "new")}
    assert [tuple(r) for r in unmatched.collect()] == [(9, "lost")]


def test_last_email_update_of_a_customer_counts(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id int, email string")
    u = spark.createDataFrame([(2, "second", 5), (2, "first", 4), (2, "zero", None)], "customer_id int, email string, n int")
    updated, _ = changes.update_customer_email(c, u, "n")
    assert sorted(tuple(r) for r in updated.collect()) == [(1, "a"), (2, "second")]
