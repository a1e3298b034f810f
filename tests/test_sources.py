from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kilowise import schemas
from kilowise.plans import sizing, storage
from kilowise.sources import insert_dump, readers

TARIFF_DUMP = """-- rates of two plans
DELETE FROM dim_tariff;
INSERT INTO dim_tariff VALUES
('NIGHT', 'Night, and weekends', 'for heat pumps', 0.41, 0.09, 0.75, '2018-07-01', NULL, TRUE),
('FLAT', 'Bob''s (nearly) flat, one', NULL, 0.22, 0.22, 2.1, '2019-02-28', '2021-10-31', False);
"""

MIXED_DUMP = """INSERT INTO a VALUES (1, 'x'), (2, 'y, z');
INSERT INTO b (id, name) VALUES
(3, 'not mine'),
(4, 'nor this');
insert into public.a values
(5, 'later'); -- done
(6, 'stray')
"""


def test_dump_with_types_quotes_and_nulls(spark, tmp_path):
    path = tmp_path / "tariff.sql"
    path.write_text(TARIFF_DUMP)
    rows = insert_dump.read_insert_dump(spark, str(path), "dim_tariff", schemas.DIM_TARIFF).orderBy("tariff_code").collect()
    assert [r["tariff_code"] for r in rows] == ["FLAT", "NIGHT"]
    assert rows[0]["tariff_name"] == "Bob's (nearly) flat, one" and rows[0]["description"] is None
    assert rows[0]["is_current"] is False and rows[1]["is_current"] is True
    assert rows[1]["peak_rate_per_kwh"] == Decimal("0.4100") and rows[1]["applicable_to"] is None
    assert rows[0]["applicable_to"] == dt.date(2021, 10, 31)


def test_dump_with_several_tables(spark, tmp_path):
    path = tmp_path / "mixed.sql"
    path.write_text(MIXED_DUMP)
    rows = insert_dump.read_insert_dump(spark, str(path), "a").orderBy("col_0").collect()
    assert [tuple(r) for r in rows] == [("1", "x"), ("2", "y, z"), ("5", "later"), ("6", "stray")]
    assert insert_dump.read_insert_dump(spark, str(path), "b").count() == 2
    with pytest.raises(ValueError):
        insert_dump.read_insert_dump(spark, str(path), "c")


def test_dump_split_over_tasks(spark, tmp_path):
    lines = []
    for block in range(40):
        lines.append(f"INSERT INTO {'a' if block % 3 else 'b'} VALUES")
        lines += [f"({block}, '{'x' * 40}{i}')," for i in range(20)]
    (tmp_path / "big.sql").write_text("\n".join(lines) + ";\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = insert_dump.read_insert_dump(spark, str(tmp_path / "big.sql"), "b").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 14 * 20 and {int(r["col_0"]) % 3 for r in rows} == {0}


PAIR = schemas.T.StructType().add("i", "integer").add("s", "string")


def dump_rows(spark, tmp_path, text, schema=PAIR):
    (tmp_path / "t.sql").write_text(text)
    return sorted(tuple(r) for r in insert_dump.read_insert_dump(spark, str(tmp_path), "t", schema).collect())


@pytest.mark.parametrize("text,rows", [
    ("INSERT INTO t VALUES\n(1, 'a\nb');\n", [(1, "a\nb")]),
    ("INSERT INTO t VALUES (1,\n'a'),\n\n(2\n,\n'b')\n;\n", [(1, "a"), (2, "b")]),
    ("INSERT INTO t VALUES\n(1, 'a') ON CONFLICT (i) DO NOTHING;\n", [(1, "a")]),
    ("INSERT INTO t VALUES\n/* (1, 'a'),\n(2, 'b') */\n(3, 'c');\n", [(3, "c")]),
    ('INSERT INTO t VALUES (1, "a, (b"), (2, "it\'s"), (3, \'say ""no""\'), (4, "say ""no"""), (5, \'it\'\'s\')', [
        (1, "a, (b"), (2, "it's"), (3, 'say ""no""'), (4, 'say "no"'), (5, "it's")]),
    ("insert into t (s, i) values ('x', 1), (NULL, 2); insert into t values (3, 'NULL'), (4, '')", [(1, "x"), (2, None), (3, "NULL"), (4, "")]),
    ('INSERT INTO "public"."t"("i","s")VALUES(1,now()),(2,f(a, b));CREATE TABLE t (i int, s text);', [(1, "now()"), (2, "f(a, b)")]),
    ("SET a = 1, b = 2; TRUNCATE TABLE t; INSERT INTO u VALUES (1, 'a'), (2, 'b'); INSERT INTO u SELECT 1, 2;", []),
    ("INSERT INTO t VALUES (1, 'a;--b'), -- it's\n(2, '/*') -- ;\n; -- \"\n", [(1, "a;--b"), (2, "/*")]),
    ("INSERT INTO t VALUES (1, 'a\r\nb'),\r\n(2, '');\r\n", [(1, "a\r\nb"), (2, "")]),
])
def test_dump_over_lines_and_quotes(spark, tmp_path, text, rows):
    assert dump_rows(spark, tmp_path, text) == rows


@pytest.mark.parametrize("text", [
    "INSERT INTO t VALUES (1, 'a", "INSERT INTO t VALUES (1, 'a'", "INSERT INTO t VALUES (1, 'a'); /* ", "INSERT INTO t VALUES (1, 'a'));",
    "INSERT INTO t VALUES (1);", "INSERT INTO t VALUES (1, 'a', 2);", "INSERT INTO t SELECT 1, 'a';", "INSERT INTO t VALUES (1, 'a'), nothing;",
    "INSERT INTO t (a, b) VALUES (1, 'a');", "INSERT INTO t VALUES (1, 'a'; INSERT INTO t VALUES (2, 'b');",
])
def test_dump_raises_on_what_it_cannot_read(spark, tmp_path, text):
    with pytest.raises(Exception, match="DumpError|does not fit"):
        dump_rows(spark, tmp_path, text)


@pytest.mark.parametrize("split", [23, 150])
def test_dump_split_inside_of_texts(spark, tmp_path, monkeypatch, split):
    """Statements, quoted texts and comments go on over many splits; some splits are one part of a unit."""
    draw = random.Random(split)
    want, parts = [], ["-- it's a \"dump\n"]
    texts = ["a'b", 'say "x"', "(1, 2),\n(3", "-- no comment\n", "/* nor\nthis", "; INSERT INTO t VALUES (0, 'no')", "x\n" * 30, "", "','", '","']
    for statement in range(7):
        table = "t" if statement % 3 else "u"
        tuples = []
        for i in range(draw.randint(1, 9)):
            text, quote = draw.choice(texts), draw.choice("'\"")
            own = statement * 100 + i
            tuples.append(f"({own},{draw.choice([' ', chr(10)])}{quote}{text.replace(quote, quote * 2)}{quote})")
            want += [(own, text)] if table == "t" else []
        comment = draw.choice(["", "/* 'unclosed\n\n (\n */", "-- \"unclosed (\n"])
        parts.append(f"INSERT INTO\n{table}\nVALUES{comment} " + draw.choice([",", ",\n", "\n,/* , */\n"]).join(tuples) + draw.choice([";", "\n;\n"]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        if split > 100:
            monkeypatch.setattr(insert_dump, "BROADCAST_BYTES", -1)
        assert dump_rows(spark, tmp_path, "".join(parts)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_dump_of_several_files(spark, tmp_path):
    """Every file begins outside of all statements, and one without rows is no matter."""
    (tmp_path / "a.sql").write_text("INSERT INTO t VALUES (1, 'a')")
    (tmp_path / "b.sql").write_text("-- nothing\n")
    (tmp_path / "c.sql").write_text("")
    (tmp_path / "d.sql").write_text("INSERT INTO u VALUES (9, 'z');\nINSERT INTO t VALUES (2, 'b')\n")
    assert dump_rows(spark, tmp_path, "INSERT INTO t VALUES (3, 'c');") == [(1, "a"), (2, "b"), (3, "c")]


def test_dump_layouts(spark, tmp_path):
    (tmp_path / "t.sql").write_text(
        "INSERT INTO t\n  VALUES (1, 'a -- b'), -- (9, 'x')\n (2, '/* c'); /* (8, 'y') */\ninsert into t\n(i, s)\nVALUES\n-- (7, 'z')\n(3, NULL);\n"
    )
    rows = insert_dump.read_insert_dump(spark, str(tmp_path), "t", schemas.T.StructType.fromDDL("i INT, s STRING")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a -- b"), (2, "/* c"), (3, None)]


def test_dump_default_keyword_becomes_null(spark, tmp_path):
    (tmp_path / "addr.sql").write_text(
        "INSERT INTO bridge_customer_address VALUES\n"
        "(DEFAULT, 'p-40', '3 Mill Lane, Upper Hutt', '2016-01-31', '2018-12-01', False, 'Hutt'),\n"
        "(DEFAULT, 'p-40', '17 Quay, flat 2', '2018-12-01', NULL, True, 'Nelson');\n"
    )
    rows = insert_dump.read_insert_dump(spark, str(tmp_path), "bridge_customer_address", schemas.BRIDGE_CUSTOMER_ADDRESS)
    assert {(r["address_id"], r["start_date"], r["is_current"]) for r in rows.collect()} == {
        (None, dt.date(2016, 1, 31), False), (None, dt.date(2018, 12, 1), True)
    }


def test_text_and_file_listing(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a\nb\n")
    (tmp_path / "two.txt").write_text("c\n")
    assert readers.read_text_lines(spark, str(tmp_path)).count() == 3
    whole = readers.read_text_lines(spark, str(tmp_path), whole=True)
    assert {r["value"] for r in whole.collect()} == {"a\nb\n", "c\n"}
    assert {r["n_bytes"] for r in readers.list_files(spark, str(tmp_path)).collect()} == {4, 2}


def test_topic_table_keeps_positions(spark, messages):
    table = readers.kafka_topic_table(messages, schemas.STREAM_RECORD, "meter_topic")
    assert {"_partition_id", "_offset", "_timestamp"} < set(table.columns)
    avg = spark.sql("SELECT region, AVG(kwh_usage) AS a FROM meter_topic WHERE region IS NOT NULL GROUP BY region")
    assert {r["region"]: r["a"] for r in avg.collect()}["Auckland"] == pytest.approx(16.15)


def test_kafka_defaults_apply_to_the_reader(monkeypatch, spark):
    seen = {}

    class Reader:
        def format(self, fmt):
            seen["format"] = fmt
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return spark.createDataFrame([], schemas.TOPIC_RECORD)

    class Session:
        readStream = read = Reader()

    readers.read_topic(Session(), options={"subscribe": "t", "maxOffsetsPerTrigger": "10000"})
    assert seen == {"format": "kafka", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false",
                    "minPartitions": "1", "maxOffsetsPerTrigger": "10000"}
    seen.clear()
    readers.read_topic(Session(), options={"subscribe": "t"}, streaming=False)
    assert seen["startingOffsets"] == "earliest"


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "t")
    assert plain["dbtable"] == "t" and "numPartitions" not in plain
    ranged = readers.jdbc_options("jdbc:x", "t", "id", (0, 100), 8, user="u")
    assert (ranged["partitionColumn"], ranged["upperBound"], ranged["numPartitions"], ranged["user"]) == ("id", "100", "8", "u")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")


def test_broadcast_hint_by_bytes_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    stored = spark.read.parquet(path)
    size = sizing.base_bytes(stored)
    assert size == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in plan(sizing.broadcast_if_small(stored.distinct(), size))
    assert "broadcast" not in plan(sizing.broadcast_if_small(stored.distinct(), size - 1))
    assert "broadcast" in plan(sizing.broadcast_if_small(spark.range(3)))


def test_no_job_while_the_plan_of_usage_weather_is_built(spark):
    from kilowise.operators.weather import usage_weather
    from kilowise.plans.bindings import Tables

    x = Tables(spark, "/root/testdata/sf0.001")
    readings, weather = x.readings, x.weather
    spark.sparkContext.setJobGroup("plan", "plan")
    usage_weather(readings, weather)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_region_joins_do_not_move_the_customers(spark):
    from kilowise.operators import usage
    from kilowise.plans.bindings import Tables

    readings = Tables(spark, "/root/testdata/sf0.001").readings
    for job in (usage.usage_vs_regional_avg, usage.customer_share_of_region):
        plan = job(readings)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [region" not in plan and "BroadcastHashJoin [region" in plan


def test_partition_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    storage.write_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, "p")
    assert {(r["v"], r["p"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}


def test_month_filter_reaches_the_scan(spark):
    from kilowise.operators.usage import anchor_month_usage
    from kilowise.plans.bindings import Tables

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = anchor_month_usage(Tables(spark, "/root/testdata/sf0.001").readings, "1998-06-01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01" in scan and "LessThan(l_shipdate,1998-07-01" in scan
    assert "l_extendedprice" not in scan and "CartesianProduct" not in text


def test_reload_empties_a_day(spark, tmp_path):
    path = str(tmp_path / "fact")
    day = spark.createDataFrame([(1, "2024-01-15"), (2, "2024-01-15")], "v int, date string")
    storage.reload_partition(day, path, "date", "2024-01-15")
    storage.reload_partition(day.withColumn("date", F.lit("2024-01-16")), path, "date", "2024-01-16")
    storage.reload_partition(day.limit(0), path, "date", "2024-01-15")
    assert [str(r["date"]) for r in spark.read.parquet(path).collect()] == ["2024-01-16"] * 2


def test_month_store_is_pruned_and_sorted(spark, tmp_path):
    from kilowise.plans.bindings import Tables

    path, readings = str(tmp_path / "months"), Tables(spark, "/root/testdata/sf0.001").readings
    assert storage.monthly_partitions(readings, path).agg(F.sum("n_rows")).first()[0] == readings.count()
    span = storage.read_months(spark, path, "1998-06-01", "1998-07-01")
    assert span.count() == readings.filter("reading_ts >= '1998-06-01' AND reading_ts < '1998-07-01'").count()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan or "PartitionFilters: [(" in plan


def test_hot_key_join_can_be_split(spark):
    """Both sides of the reading join are plain shuffles, as the skew split needs."""
    from kilowise.operators.usage import usage_spikes
    from kilowise.plans.bindings import Tables

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.0")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    try:
        stream = Tables(spark, "/root/testdata/sf0.01").loaded_stream.repartition(8)
        hot = stream.withColumn("customer_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("customer_id")))
        found = usage_spikes(hot)
        n = len(found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for key in ("skewJoin.skewedPartitionThresholdInBytes", "skewJoin.skewedPartitionFactor", "advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.adaptive.{key}")
    assert "skew=true" in plan.replace("isSkew", "skew").lower()
    assert n == usage_spikes(hot).count()


def test_refresh_replaces_the_view(spark, tmp_path):
    path = str(tmp_path / "mv")
    storage.refresh_mv(lambda: spark.range(5), path)
    assert storage.refresh_mv(lambda: spark.range(2).withColumn("x", F.lit(1)), path).count() == 2
    for n in (3, 4):
        # A view may be built from its own last state.
        storage.refresh_mv(lambda: storage.read_published(spark, path).limit(1).unionByName(spark.range(n).withColumn("x", F.lit(n))), path)  # noqa: B023
    assert storage.read_published(spark, path).count() == 5
    assert storage.committed(spark, path, "v=") == [2, 3]


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "mv")
    storage.publish(spark.range(5), path)
    spark.range(9).write.parquet(f"{path}/v=1")
    (tmp_path / "mv" / "v=1" / "_SUCCESS").unlink()
    assert storage.read_published(spark, path).count() == 5
    assert storage.publish(spark.range(3), path).count() == 3 and storage.read_published(spark, path).count() == 3


def test_reload_goes_on_after_a_lost_driver(spark, tmp_path):
    """The old partition stands aside and the new one is not in place: the next call starts from the old one."""
    path = str(tmp_path / "fact")
    day = spark.createDataFrame([(1, "a"), (2, "a")], "v int, p string")
    storage.reload_partition(day, path, "p", "a")
    (tmp_path / "fact" / "_old").mkdir(exist_ok=True)
    (tmp_path / "fact" / "p=a").rename(tmp_path / "fact" / "_old" / "p=a")
    storage.reload_partition(day.filter("v = 2"), path, "p", "a")
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [2]
