"""Running totals and the interval sweep against plain loops, with a key that holds most rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kilowise.functions import ranking, scan
from kilowise.functions.intervals import interval_join
from kilowise.functions.scan import running


def test_running_totals(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "a", "a", "b", None]), i, draw.choice([None, 1, 2, -7]), draw.randint(0, 9)) for i in range(400)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "g string, i int, v int, w int")
    found = running(frame, ["g"], [F.col("i")], {"s": ("sum", "v"), "m": ("max", "w")}, "totals").collect()
    want, sums, tops = {}, {}, {}
    for g, i, v, w in sorted(rows, key=lambda r: r[1]):
        if v is not None:
            sums[g] = (sums.get(g) or 0) + v
        tops[g] = max(tops.get(g, 0), w)
        want[i] = (g, v, sums.get(g), tops[g])
    assert {r["i"]: (r["g"], r["v"], r["s"], r["m"]) for r in found} == want
    overall = {r["i"]: r["s"] for r in running(frame, [], [F.col("i")], {"s": ("sum", "w")}, "totals").collect()}
    at, expected = 0, {}
    for g, i, v, w in sorted(rows, key=lambda r: r[1]):
        at += w
        expected[i] = at
    assert overall == expected
    assert running(frame.limit(0), ["g"], [F.col("i")], {"s": ("sum", "w")}, "totals").count() == 0


def test_no_task_holds_the_group(spark, monkeypatch):
    """One customer with nearly all rows is sorted over all tasks, and each takes its own stretch of it."""
    kept = {}
    store = scan.materialize

    def spy(df, name):
        kept[name] = store(df, name)
        return kept[name]

    monkeypatch.setattr(scan, "materialize", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(-1).alias("g"), "id", F.lit(1).alias("one"))
        found = running(frame, ["g"], [F.col("id")], {"n": ("sum", "one")}, "hot")
        assert found.filter("g = -1").agg(F.max("n"), F.count("n"), F.countDistinct("n")).first() == (19_800, 19_800, 19_800)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    held = kept["hot-stretches"].filter("g = -1").collect()
    assert len(held) >= 4 and max(r["n"] for r in held) < 8_000
    # What is passed on is at most a row per task.
    assert kept["hot-stretches"].groupBy("g").count().filter("count > 1").count() <= 4


def random_intervals(draw, keys, n, days):
    out = []
    for i in range(n):
        start = draw.choice([None, *range(days)]) if draw.random() < 0.1 else draw.randrange(days)
        end = None if start is None or draw.random() < 0.2 else start + draw.randint(-2, days // 3)
        out.append((draw.choice(keys), start, end, i))
    return out


@pytest.mark.parametrize("points,spans", [(300, 60), (5, 200), (200, 0), (0, 20)])
def test_interval_join(spark, points, spans):
    draw = random.Random(points + spans)
    day0 = dt.date(2024, 1, 1)
    day = lambda n: None if n is None else day0 + dt.timedelta(n)
    time = lambda h: None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    keys = ["a", "a", "a", "b", "c", None]
    p = [(draw.choice(keys), draw.choice([None, draw.randrange(40 * 24), 24 * draw.randrange(40)]), i) for i in range(points)]
    p += p[:3]
    v = random_intervals(draw, keys, spans, 40)
    v += v[:2]
    left = spark.createDataFrame([(k, time(h), i) for k, h, i in p], "k string, at timestamp, p int")
    right = spark.createDataFrame([(k, day(s), day(e), i) for k, s, e, i in v], "k string, start date, stop date, v int")
    want = sorted(
        (k, i, j) for k, h, i in p for k2, s, e, j in v
        if k is not None and k == k2 and h is not None and s is not None and s * 24 <= h and (e is None or h < e * 24)
    )
    found = interval_join(left, "at", right, "start", "stop", "k")
    assert found.columns == ["k", "at", "p", "start", "stop", "v"]
    assert sorted((r["k"], r["p"], r["v"]) for r in found.collect()) == want


def test_interval_join_pairs_no_more_than_it_gives(spark, monkeypatch):
    """Intervals over many borders without points cost nothing: one key, 300 nested intervals, 3 points."""
    from kilowise.functions import intervals

    kept = {}
    store = intervals.materialize

    def spy(df, name):
        kept[name] = store(df, name)
        return kept[name]

    monkeypatch.setattr(intervals, "materialize", spy)
    left = spark.createDataFrame([(1, float(x)) for x in (1, 150, 301)], "k int, at double")
    right = spark.range(300).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("s"), (600 - F.col("id")).cast("double").alias("e"))
    assert interval_join(left, "at", right, "s", "e", "k").count() == 2 + 151 + 299
    assert kept["intervals-by-segment"].count() == 2 + 151 + 299


def test_interval_join_stores_the_points_once(spark, monkeypatch):
    """Points are stored once, in the order of the sweep, with the columns that the query gives back."""
    from kilowise.functions import intervals
    from kilowise.plans.registry import QUERIES

    kept = {}
    store = intervals.materialize

    def spy(df, name):
        kept[name] = store(df, name)
        return kept[name]

    for module in (intervals, scan, ranking):
        monkeypatch.setattr(module, "materialize", spy)
    QUERIES["readings_with_address"](spark, "/root/testdata/sf0.001")
    with_points = {n: set(t.columns) for n, t in kept.items() if {"kwh_usage", "_point"} & set(t.columns)}
    assert list(with_points) == ["sweep"]
    assert with_points["sweep"] == {"reading_id", "customer_id", "kwh_usage", "_at", "_interval", "_part", "_number"}


def test_a_segment_goes_on_in_later_tasks(spark, monkeypatch):
    """Most points of the one key lie at the same time, between the same two borders."""
    from kilowise.functions import intervals

    kept = {}
    store = intervals.materialize

    def spy(df, name):
        kept[name] = store(df, name)
        return kept[name]

    monkeypatch.setattr(intervals, "materialize", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(20_000).select(F.lit("a").alias("k"), F.when(F.col("id") < 50, F.col("id").cast("double")).otherwise(60.0).alias("at"), "id")
        right = spark.createDataFrame([("a", 10.0, 60.0, 1), ("a", 20.0, None, 2), ("a", 60.0, 61.0, 3), ("a", 61.0, None, 4), ("b", 0.0, None, 5)], "k string, s double, e double, v int")
        found = interval_join(left, "at", right, "s", "e", "k").groupBy("v").agg(F.count("id"), F.countDistinct("id")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, found)) == [(1, 40, 40), (2, 19_980, 19_980), (3, 19_950, 19_950)]
    sizes = [r["count"] for r in kept["sweep"].groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 8_000
