"""Every registered query against its SQL in DuckDB, values compared exactly."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kilowise.plans import registry, storage
from kilowise.plans.bindings import Tables
from kilowise.plans.registry import QUERIES
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()
OWN = [name for name in queries() if name in QUERIES]
STREAMS = [name for name in OWN if name.startswith("stream_")] + ["append_lake_stream", "read_topic_stream"]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    assert name in SQL
    assert compare(spark, con, FOLDER, name, queries()[name], SQL[name]) is None


@pytest.fixture(scope="module")
def shuffled_topic(spark):
    """The topic as seven files in no order of time, each read as a batch of its own."""
    x = Tables(spark, FOLDER)
    path = storage.work_dir(spark, "shuffled")
    x.topic.repartition(7, "partition", "offset").write.parquet(path)
    assert len(spark.read.parquet(path).inputFiles()) >= 5
    key = (spark.sparkContext.applicationId, FOLDER)
    before = storage._TOPICS.get(key)
    storage._TOPICS[key] = path
    yield
    storage._TOPICS.pop(key)
    if before:
        storage._TOPICS[key] = before


@pytest.mark.parametrize("name", [n for n in STREAMS if n != "stream_refresh_mv"])
def test_stream_does_not_depend_on_batches(spark, con, name, shuffled_topic, monkeypatch):
    monkeypatch.setattr(registry, "BATCH_SIZE", {"maxFilesPerTrigger": "1"})
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_id", "billing_month", "total_kwh", "peak_kwh", "offpeak_kwh", "amount_due"]
    assert df.count() > 0
