from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import defaultdict
from decimal import Decimal
import json

import pytest
from pyspark.sql import functions as F

from kilowise.operators import enrich, usage
from kilowise.plans import storage
from kilowise.schemas import TOPIC_RECORD
from kilowise.streaming import alerts, etl, progress, sinks, summary
from tests.conftest import topic

ONCE = {"availableNow": True}
FIXTURE = [
    {"meter_id": "k-31", "kwh_usage": 0.62, "voltage": 236, "timestamp": "2022-11-05T04:00:01.250000Z"},
    {"meter_id": "k-32", "kwh_usage": 7.1, "voltage": 271, "timestamp": "2022-11-05T04:00:09.000003Z"},
]


def message(meter, ts, kwh, voltage=230, customer="c1", region="Auckland"):
    return {"meter_id": meter, "timestamp": ts, "kwh_usage": kwh, "voltage": voltage, "customer_id": customer, "region": region}


def test_tuple_stream_to_memory(spark, as_stream):
    stream = enrich.parse_json_tuple(as_stream(topic(spark, FIXTURE)))
    assert stream.isStreaming and {"meter_id", "voltage", "timestamp"} <= set(stream.columns)
    q = stream.writeStream.format("memory").queryName("tuple_out").trigger(**ONCE).start()
    q.awaitTermination()
    assert {r["meter_id"] for r in spark.table("tuple_out").collect()} == {"k-31", "k-32"}


def test_lake_append_and_empty_stream(spark, as_stream, tmp_path):
    out = str(tmp_path / "lake")
    stream = enrich.parse_json(as_stream(topic(spark, FIXTURE)))
    sinks.append_lake_stream(stream, out, "parquet", trigger=ONCE).awaitTermination()
    assert spark.read.parquet(out).count() == 2 and (tmp_path / "lake" / "_checkpoints").is_dir()
    empty = enrich.parse_json(as_stream(topic(spark, []), "empty"))
    target = str(tmp_path / "none")
    sinks.append_lake_stream(empty, target, "parquet", trigger=ONCE).awaitTermination()
    assert spark.read.schema(empty.schema).parquet(target).count() == 0


def test_archive_replay_replaces_and_empty_is_skipped(spark, tmp_path):
    path = str(tmp_path / "archive")
    sinks.archive_batch(spark.range(3), 7, path)
    sinks.archive_batch(spark.range(3), 7, path)
    sinks.archive_batch(spark.range(0), 8, path)
    rows = sinks.read_archive(spark, path)
    assert rows.count() == 3 and {r["batch_id"] for r in rows.collect()} == {7}


@pytest.mark.parametrize("isolated", [False, True])
def test_etl_over_two_runs(spark, as_stream, tmp_path, isolated):
    paths = etl.EtlPaths(str(tmp_path / "etl"))
    spark.createDataFrame([("m1", None, True)], "meter_id string, installation_date date, is_active boolean").write.parquet(paths.meters)
    known = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    first = [
        message("m1", "2024-01-01T10:00:00Z", 1.0),
        message("m1", "2024-01-01T10:00:00Z", 2.0, 240, customer="c2", region="Wellington"),
        message("m2", "2024-01-01T23:30:00Z", 3.0, customer="stranger"),
        message("m3", "2024-01-02T18:00:00Z", 30.0),
        message("m3", "2024-01-02T18:01:00Z", 3.0, voltage=250),
        "no json",
    ]
    second = [message("m1", "2024-01-01T10:00:00Z", 9.0), message("m1", "2024-01-01T11:00:00Z", 4.0)]

    def run(bodies, start):
        raw = as_stream(topic(spark, bodies, start))
        queries = etl.run_stream_etl(raw, known, paths, "2024-01-03", trigger=ONCE, isolated=isolated)
        etl.await_all(queries)
        return queries

    run(first, 0)
    queries = run(second, 100)
    rows = {(r["meter_id"], r["timestamp"].hour): r for r in sinks.read_store(spark, paths.readings).collect()}
    assert set(rows) == {("m1", 10), ("m1", 11), ("m3", 18)}
    merged = rows["m1", 10]
    assert (merged["kwh_usage"], merged["voltage"], merged["customer_id"], merged["region"]) == (9.0, 230, "c1", "Auckland")
    assert rows["m3", 18]["data_quality_flag"] == "INVALID" and rows["m3", 18]["is_peak"]
    meters = {r["meter_id"]: r["installation_date"] for r in spark.read.parquet(paths.meters).collect()}
    assert meters == {"m1": None, "m2": dt.date(2024, 1, 3), "m3": dt.date(2024, 1, 3)}
    assert sinks.read_archive(spark, paths.quarantine).count() == 1
    assert [tuple(r)[:2] for r in sinks.read_archive(spark, paths.dropped).collect()] == [("stranger", 1)]
    assert sinks.read_archive(spark, paths.archive).count() == 7
    last = {r["query"]: r["n_input_rows"] for r in progress.stream_progress(spark, queries, 1).collect()}
    assert last == ({"store": 2, "archive": 2} if isolated else {"load": 2})
    assert all(x["error"] is None for x in progress.stream_status(queries).values())


def test_progress_of_every_batch(spark, tmp_path):
    """More batches than Spark keeps records of."""
    for i in range(5):
        spark.range(i + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "2")
    try:
        with progress.ProgressLog(spark, str(tmp_path / "log")) as log:
            rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            queries = {"q": sinks.foreach_batch(rows, lambda batch, _: batch.count(), str(tmp_path / "cp"), ONCE)}
            etl.await_all(queries)
            found = log.read(queries).collect()
        assert len(queries["q"].recentProgress) < 5
    finally:
        spark.conf.unset(kept)
    assert sorted(r["batch_id"] for r in found) == list(range(5)) and sum(r["n_input_rows"] for r in found) == 15


def test_replayed_batch_changes_nothing(spark, tmp_path, messages):
    paths = etl.EtlPaths(str(tmp_path / "replay"))
    spark.createDataFrame([("k-17",)], "meter_id string").write.parquet(paths.meters)
    known = spark.createDataFrame([(f"p-{i}",) for i in range(4, 8)], "customer_id string")
    batch = etl.enriched_stream(messages)
    states = []
    for _ in range(2):
        etl.load_batch(batch, 0, known, paths, "2021-03-05")
        stored = sinks.read_store(spark, paths.readings).drop("processing_time", "slot")
        states.append((sorted(map(str, stored.collect())), spark.read.parquet(paths.meters).count(),
                       sinks.read_archive(spark, paths.quarantine).count()))
    assert states[0] == states[1] and states[0][1:] == (4, 2)


def test_failing_handler_fails_the_query(spark, as_stream, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    q = sinks.foreach_batch(as_stream(topic(spark, FIXTURE)), broken, str(tmp_path / "cp"), ONCE)
    with pytest.raises(Exception, match="sink is down"):
        etl.await_all({"q": q})
    assert "sink is down" in progress.stream_status({"q": q})["q"]["error"]


def test_anomalies_are_those_of_a_trigger_per_row(spark, tmp_path):
    """Whatever the batches: a reading is judged by those before it and itself, also inside of its own batch."""
    schema = "customer_id string, reading_id long, reading_ts timestamp, kwh_usage decimal(10,4)"
    t = dt.datetime(2024, 1, 1)
    draw = random.Random(2)
    values = [("a", 1), ("a", 1), ("b", 5), *[("a", 1)] * 12, ("a", 50), ("b", 5), ("a", 1), ("c", 900), ("a", 60), (None, 4), ("a", None)]
    values += [(draw.choice(["a", "b", None]), 1 if draw.random() < 0.8 else 200 * i) for i in range(40)]
    rows = [(c, i, t, None if v is None else Decimal(v)) for i, (c, v) in enumerate(values)]
    want, seen = {}, defaultdict(list)
    for c, i, _, v in rows:
        own = seen[c]
        own += [] if v is None else [float(v)]
        if c and v is not None and len(own) > 1 and float(v) > round(statistics.mean(own), 2) + 3 * round(statistics.stdev(own), 2):
            want[i] = round(statistics.mean(own), 2)
    assert 15 in want and len(want) > 3
    frame = spark.createDataFrame(rows, schema)
    whole = usage.anomaly_at_arrival(frame, [F.col("reading_id")]).collect()
    assert {r["reading_id"]: r["avg_usage"] for r in whole} == want
    for cuts in ([0, 4, 15, 16, 40], [0]):
        root = str(tmp_path / f"watch{len(cuts)}")
        for batch_id, (start, stop) in enumerate(zip(cuts, [*cuts[1:], len(rows)])):
            batch = spark.createDataFrame(rows[start:stop], schema)
            for _ in range(2 if batch_id == 2 else 1):  # a replay
                alerts.anomaly_batch(batch, batch_id, root, compact_every=2)
        got = {r["reading_id"]: r["avg_usage"] for r in sinks.read_archive(spark, f"{root}/anomalies").collect()}
        assert got == want
        if len(cuts) > 1:
            assert {r[0] for r in spark.read.parquet(f"{root}/base").select("upto").distinct().collect()} == {2, 4}


def test_backfill_judges_by_final_statistics(spark, as_stream, tmp_path):
    """One file per batch, the history in two passes: as one batch job would say."""
    bodies = [message("m", f"2024-01-01T{i:02}:00:00Z", 100.0 if i == 3 else 1.0) for i in range(20)]
    stream = enrich.parse_json(as_stream(topic(spark, bodies).repartition(6), "many", maxFilesPerTrigger=1))
    stream = stream.selectExpr("customer_id", "timestamp AS reading_ts", "hour(timestamp) AS reading_id", "CAST(kwh_usage AS DECIMAL(10,4)) AS kwh_usage")
    root = str(tmp_path / "backfill")
    alerts.backfill_anomalies(stream, root, ONCE)
    assert [r["reading_id"] for r in sinks.read_archive(spark, f"{root}/anomalies").collect()] == [3]
    assert float(alerts.customer_stats(spark, root).first()["s1"]) == 119.0


def _store_rows(spark, path):
    return sorted((r["meter_id"], r["timestamp"].hour, r["kwh_usage"]) for r in sinks.read_store(spark, path).collect())


def test_store_survives_a_lost_driver(spark, tmp_path, monkeypatch):
    """A driver lost between writing the slots and making them visible leaves the old rows; the replay
    of the batch starts from them."""
    path = str(tmp_path / "store")
    schema = "meter_id string, timestamp timestamp, kwh_usage double, customer_id string, arrival long"
    at = dt.datetime(2024, 1, 1, 5)
    first = spark.createDataFrame([("a", at, 1.0, "c", 1), ("b", at, 2.0, "c", 2), ("c", at.replace(hour=9), 3.0, "c", 3)], schema)
    second = spark.createDataFrame([("a", at, 7.0, "d", 4), ("d", at, 8.0, "c", 5)], schema)
    sinks.upsert_batch(first, 0, path)
    old = _store_rows(spark, path)

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "publish", lost)
        with pytest.raises(RuntimeError):
            sinks.upsert_batch(second, 1, path)
    assert _store_rows(spark, path) == old == [("a", 5, 1.0), ("b", 5, 2.0), ("c", 9, 3.0)]
    new = [("a", 5, 7.0), ("b", 5, 2.0), ("c", 9, 3.0), ("d", 5, 8.0)]
    for _ in range(2):
        sinks.upsert_batch(second, 1, path)
        assert _store_rows(spark, path) == new
    for batch in range(2, 6):
        sinks.upsert_batch(second, batch, path)
    assert _store_rows(spark, path) == new
    folders = {f.parent.name for f in (tmp_path / "store" / "data").glob("version=*/slot=2024-01-01-05")}
    assert folders == {"version=4", "version=5"}  # what older batches replaced is gone


def test_order_over_topic_partitions(spark, as_stream, tmp_path):
    """Offsets of different partitions say nothing about order; the broker's time does."""
    from kilowise.schemas import TOPIC_RECORD as record

    body = lambda kwh: json.dumps(message("m", "2024-01-01T10:00:00Z", kwh)).encode()
    at = dt.datetime(2024, 1, 1, 10)
    rows = [(None, body(1.0), "t", 0, 900, at, 0), (None, body(2.0), "t", 1, 3, at.replace(minute=1), 0), (None, body(3.0), "t", 0, 901, at.replace(second=5), 0)]
    paths = etl.EtlPaths(str(tmp_path / "etl"))
    spark.createDataFrame([("m",)], "meter_id string").write.parquet(paths.meters)
    known = spark.createDataFrame([("c1",)], "customer_id string")
    etl.load_batch(etl.enriched_stream(spark.createDataFrame(rows, record)), 0, known, paths, "2024-01-03")
    assert [r["kwh_usage"] for r in sinks.read_store(spark, paths.readings).collect()] == [2.0]


def test_high_usage_watch(spark, as_stream, tmp_path):
    bodies = [message("m", "2024-01-01T10:00:00Z", 1000.0), message("m", "2024-01-01T11:00:00Z", 1000.1)]
    out = str(tmp_path / "alerts")
    stream = enrich.parse_json(as_stream(topic(spark, bodies)))
    alerts.watch_high_usage(stream, out, str(tmp_path / "cp"), ONCE).awaitTermination()
    assert [r["kwh_usage"] for r in sinks.read_archive(spark, out).collect()] == [1000.1]


def test_daily_summary_shows_open_days_and_late_readings(spark, as_stream, tmp_path):
    root, cp = str(tmp_path / "daily"), str(tmp_path / "cp")

    def run(bodies, start):
        stream = etl.enriched_stream(as_stream(topic(spark, bodies, start)))
        summary.watch_daily_summary(stream, root, cp, ONCE, compact_every=1).awaitTermination()
        return {(r["window_start"].day, r["customer_id"]): float(r["total_kwh"]) for r in summary.read_daily_summary(spark, root).collect()}

    assert run([message("m", "2024-01-09T10:00:00Z", 1.0), message("m", "2024-01-10T09:00:00Z", 2.0)], 0) == {(9, "c1"): 1.0, (10, "c1"): 2.0}
    assert run([message("m", "2024-01-01T23:00:00Z", 4.0), message("m", "2024-01-10T10:00:00Z", 8.0)], 10) == {(1, "c1"): 4.0, (9, "c1"): 1.0, (10, "c1"): 10.0}
    assert run([message("m", "2024-01-09T23:00:00Z", 0.5)], 20)[9, "c1"] == 1.5


def test_daily_summary_waits_for_late_readings(spark, as_stream, tmp_path):
    out, cp = str(tmp_path / "daily"), str(tmp_path / "cp")

    def run(bodies, start):
        stream = etl.enriched_stream(as_stream(topic(spark, bodies, start)))
        daily = summary.stream_daily_summary(stream)
        sinks.append_lake_stream(daily, out, "parquet", cp, ONCE).awaitTermination()
        return {(r["window_start"].day, r["customer_id"]): float(r["total_kwh"]) for r in spark.read.schema(daily.schema).parquet(out).collect()}

    assert run([message("m", "2024-01-01T10:00:00Z", 1.0), message("m", "2024-01-02T09:00:00Z", 2.0)], 0) == {}
    # A reading of the first day comes a day late and still counts.
    assert run([message("m", "2024-01-01T23:00:00Z", 4.0), message("m", "2024-01-03T01:00:00Z", 8.0)], 10) == {(1, "c1"): 5.0}


def test_repeated_readings_are_dropped(spark, as_stream, tmp_path):
    bodies = [message("m", "2024-01-01T10:00:00Z", 1.0)] * 3 + [message("n", "2024-01-01T10:00:00Z", 1.0)]
    stream = summary.drop_repeated_readings(enrich.parse_json(as_stream(topic(spark, bodies))))
    out = str(tmp_path / "unique")
    sinks.append_lake_stream(stream, out, "parquet", trigger=ONCE).awaitTermination()
    assert spark.read.parquet(out).groupBy("meter_id").count().filter("count > 1").count() == 0
    assert spark.read.parquet(out).count() == 2


def test_view_refresh_on_arrival(spark, tmp_path):
    """A plain reader of the folder and ``read_published`` both find the last state, and only that."""
    source, view = str(tmp_path / "weather"), str(tmp_path / "view")
    spark.range(3).write.parquet(source)
    arrivals = spark.readStream.schema("id long").parquet(source)
    build = lambda: spark.read.schema("id long").parquet(source).agg(F.count("*").alias("n"))
    for expected in (3, 5, 7):
        sinks.refresh_on_arrival(arrivals, build, view, str(tmp_path / "cp"), ONCE).awaitTermination()
        assert [r["n"] for r in spark.read.parquet(view).collect()] == [expected]
        assert [r["n"] for r in storage.read_published(spark, view).collect()] == [expected]
        spark.range(2).write.mode("append").parquet(source)


def test_view_after_a_lost_driver(spark, tmp_path, monkeypatch):
    """Lost before, between and after the two moves: readers find the old rows, and the next refresh works."""
    view = str(tmp_path / "view")
    storage.publish_view(spark.range(1), view)
    move = storage.move
    for lost_at in (0, 1):
        calls = []

        def failing(*args):
            calls.append(args)
            if len(calls) > lost_at:  # noqa: B023
                raise OSError("driver lost")
            move(*args)

        with monkeypatch.context() as m:
            m.setattr(storage, "move", failing)
            with pytest.raises(OSError):
                storage.publish_view(spark.range(9), view)
        assert storage.read_published(spark, view).count() == 1
    for n in (2, 3, 4):
        storage.publish_view(spark.range(n), view)
        assert spark.read.parquet(view).count() == n == storage.read_published(spark, view).count()
    assert len(list((tmp_path / "view" / "_old").iterdir())) == 1


KEYED = "meter_id string, hour timestamp, v int, arrival int"


def keyed_rows(n, seed):
    draw = random.Random(seed)
    t = dt.datetime(2024, 1, 1)
    return [(draw.choice(["a", "b", "c", None]), t + dt.timedelta(hours=draw.choice([0, 1, i // 20])), i * 7 % 11, i) for i in range(n)]


@pytest.mark.parametrize("cuts", [[0], [0, 30, 31, 90], list(range(0, 120, 12))])
def test_append_new_keeps_the_first_of_each_key(spark, tmp_path, cuts):
    """Late rows, null keys, repeated keys inside of a batch and over batches, replays, compaction."""
    path, rows = str(tmp_path / "rows"), keyed_rows(120, 3)
    want = {}
    for m, h, v, i in rows:
        want.setdefault((m, h), (v, i))
    for batch_id, (start, stop) in enumerate(zip(cuts, [*cuts[1:], len(rows)])):
        batch = spark.createDataFrame(rows[start:stop], KEYED)
        for _ in range(2 if batch_id % 4 == 1 else 1):
            sinks.append_new(batch, batch_id, path, ["meter_id", "hour"], "hour", "yyyy-MM-dd-HH", ["arrival"], compact_parts=3)
    found = sinks.read_unique(spark, path).collect()
    assert len(found) == len(want) and {(r["meter_id"], r["hour"]): (r["v"], r["arrival"]) for r in found} == want


def test_append_new_survives_a_lost_driver(spark, tmp_path, monkeypatch):
    """Lost while the slots' files are written: the replay starts from the parts before the batch."""
    path = str(tmp_path / "rows")
    at = dt.datetime(2024, 1, 1)
    first = [("a", at, 1, 1), ("a", at.replace(hour=5), 2, 2)]
    second = [("a", at, 9, 3), ("b", at, 3, 4), ("b", at.replace(hour=5), 4, 5)]
    add = lambda rows, n: sinks.append_new(spark.createDataFrame(rows, KEYED), n, path, ["meter_id", "hour"], "hour", "HH", compact_parts=1)
    add(first, 0)
    write, calls = sinks.write_file, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("driver lost")
        write(*args)

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_file", failing)
        with pytest.raises(OSError):
            add(second, 1)
    add(second, 1)
    assert sorted(r["v"] for r in sinks.read_unique(spark, path).collect()) == [1, 2, 3, 4]


def test_append_new_does_not_slow_down(spark, tmp_path, monkeypatch):
    """Batch n opens the parts of the slots it touches, however many batches and slots there were before."""
    path, opened, read = str(tmp_path / "rows"), [], sinks.read_file
    monkeypatch.setattr(sinks, "read_file", lambda s, p: opened.append(p) or read(s, p))
    at = dt.datetime(2024, 1, 1)
    for n in range(14):
        opened.clear()
        rows = [(f"m{n}", at + dt.timedelta(hours=n + i), n, n) for i in (0, 1)]
        sinks.append_new(spark.createDataFrame(rows, KEYED), n, path, ["meter_id", "hour"], "hour", compact_parts=4)
        assert len(opened) == 2
    for n in range(14, 24):  # all into one slot
        sinks.append_new(spark.createDataFrame([(f"x{n}", at, n, n)], KEYED), n, path, ["meter_id", "hour"], "hour", compact_parts=4)
        assert len(sinks._slot_parts(spark, path, "2024-01-01-00").parts) <= 5
    assert sinks.read_unique(spark, path).count() == 28 + 10
    held = [p for p in (tmp_path / "rows" / "data").glob("part=*/slot=2024-01-01-00")]
    assert len(held) <= 10  # parts now and before the last batch, no more


def micro_batches(spark, tmp_path, job, batches, rest="kwh_usage double, customer_id string, meter_id string"):
    """Rows that a job has emitted, each list being a batch of (hour or ISO time, id)."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = f"timestamp timestamp, {rest}"
    for i, rows in enumerate(batches):
        spark.createDataFrame([(dt.datetime.fromisoformat(t), 1.5, k, k) for t, k in rows], schema).coalesce(1).write.mode("append").parquet(source)
        stream = job(spark.readStream.schema(schema).parquet(source))
        sinks.append_lake_stream(stream, out, "parquet", str(tmp_path / "cp"), ONCE).awaitTermination()
    return spark.read.parquet(out).collect()


END = [("2024-03-01T00:00:00", None)]


@pytest.mark.parametrize("batches", [
    [[("2024-01-01T05:00:00", "a"), ("2024-01-01T07:00:00", "a"), ("2024-01-01T23:00:00", "b"), ("2024-01-02T06:00:00", "a")], END],
    [[("2024-01-01T07:00:00", "a")], [("2024-01-01T05:00:00", "a")], [("2024-01-02T06:00:00", "a")], [("2024-01-01T23:00:00", "b")], END],
])
def test_sliding_counts(spark, tmp_path, batches):
    """Any cut of the stream whose rows are within the lateness gives the windows of the whole."""
    found = micro_batches(spark, tmp_path, lambda s: summary.sliding_counts(s, "1 day", "6 hours", "1 day"), batches)
    want = {}
    for t, k in {x for batch in batches[:-1] for x in batch}:
        pane = dt.datetime.fromisoformat(t).replace(hour=dt.datetime.fromisoformat(t).hour // 6 * 6)
        for back in range(4):
            key = (pane - dt.timedelta(hours=6 * back), k)
            want[key] = want.get(key, 0) + 1
    assert {(r["window_start"], r["customer_id"]): r["n_readings"] for r in found if r["customer_id"]} == want
    assert all(float(r["total_kwh"]) == 1.5 * r["n_readings"] for r in found)


def test_sliding_counts_add_each_reading_once(spark):
    """Readings are added to panes; only panes are copied into the windows over them."""
    s = spark.createDataFrame([], "timestamp timestamp, kwh_usage double, customer_id string")
    plan = summary.sliding_counts(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("Aggregate")


def test_late_reading_merges_two_sessions(spark, tmp_path):
    day = "2024-01-01T"
    batches = [[(day + "00:00:00", "m"), (day + "05:00:00", "m"), (day + "09:00:00", "n")], [(day + "02:30:00", "m")], END]
    found = micro_batches(spark, tmp_path, lambda s: summary.reading_sessions(s, "3 hours", "1 day"), batches)
    at = lambda h: dt.datetime(2024, 1, 1, h)
    assert sorted((r["meter_id"], r["session_start"], r["last_reading"], r["n_readings"]) for r in found if r["meter_id"]) == [
        ("m", at(0), at(5), 3), ("n", at(9), at(9), 1)]


def test_session_beyond_the_lateness_stays_closed(spark, tmp_path):
    day = "2024-01-0"
    batches = [[(day + "1T00:00:00", "m")], [(day + "9T00:00:00", "m")], [(day + "1T01:00:00", "m")], END]
    found = micro_batches(spark, tmp_path, lambda s: summary.reading_sessions(s, "3 hours", "1 day"), batches)
    assert sorted((r["session_start"].day, r["n_readings"]) for r in found if r["meter_id"]) == [(1, 1), (9, 1)]


def test_fates_are_counted_on_the_running_batch(spark, tmp_path):
    """Per batch, by one pass: the rows of each file, whatever becomes of them."""
    source, paths = str(tmp_path / "topic"), etl.EtlPaths(str(tmp_path / "etl"))
    spark.createDataFrame([("m1", None, True)], "meter_id string, installation_date date, is_active boolean").write.parquet(paths.meters)
    known = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    first = [message("m1", "2024-01-01T10:00:00Z", 1.0), message("m1", "2024-01-01T11:00:00Z", 1.0, 250), message("m2", "2024-01-01T10:00:00Z", 1.0, customer="x")]
    second = [message("m1", f"2024-01-02T1{i}:00:00Z", 1.0) for i in range(4)]
    with progress.ProgressLog(spark, str(tmp_path / "log")) as log:
        for start, bodies in ((0, first), (10, second)):
            topic(spark, bodies, start).coalesce(1).write.mode("append").parquet(source)
            raw = spark.readStream.schema(TOPIC_RECORD).parquet(source)
            queries = etl.run_stream_etl(raw, known, paths, "2024-01-03", trigger=ONCE)
            etl.await_all(queries)
        found = log.read_observed(queries).collect()
    counts = {(r["batch_id"], r["metric"]): r["value"] for r in found if r["observation"] == "fates"}
    assert {k: v for k, v in counts.items() if v} == {(0, "kept"): 1, (0, "quarantined"): 1, (0, "dropped"): 1, (1, "kept"): 4}
    assert sinks.read_store(spark, paths.readings).count() == 5
    state = progress.status_rows(spark, queries).collect()
    assert [(r["query"], r["active"], r["error"]) for r in state] == [("load", False, None)]


def test_topic_shape():
    assert TOPIC_RECORD.fieldNames() == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
