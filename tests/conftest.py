from __future__ import annotations

import datetime as dt
import json

import pytest

from kilowise.plans.storage import clean_up
from kilowise.schemas import STREAM_RECORD, TOPIC_RECORD
from kilowise.session import build_session

TOPIC = "k-readings"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_up(session)
    session.stop()


@pytest.fixture
def messages(spark):
    """Four good messages and one that is no JSON."""
    bodies = [
        '{"meter_id":"k-17","timestamp":"2021-03-04T06:30:00Z","kwh_usage":2.75,"voltage":240,"customer_id":"p-4","region":"Wellington"}',
        '{"meter_id":"k-18","timestamp":"2021-03-04T06:45:00Z","kwh_usage":0.8,"voltage":230,"customer_id":"p-5","region":"Auckland"}',
        '{"meter_id":"k-19","timestamp":"2021-03-04T07:10:00Z","kwh_usage":-0.4,"voltage":0,"customer_id":"p-6","region":"Dunedin"}',
        '{"meter_id":"k-20","timestamp":"2021-03-04T07:20:00Z","kwh_usage":31.5,"voltage":250,"customer_id":"p-7","region":"Auckland"}',
        "{cut off",
    ]
    return topic(spark, bodies)


def topic(spark, bodies, start=0):
    at = dt.datetime(2023, 1, 1)
    rows = [
        (None, (b if isinstance(b, str) else json.dumps(b)).encode(), TOPIC, 0, start + i, at, 0)
        for i, b in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, TOPIC_RECORD)


@pytest.fixture
def parsed(spark):
    at = dt.datetime(2021, 3, 4, 6, 30)
    rows = [
        ("k-17", at, 2.75, 240, "p-4", "Wellington"),
        ("k-18", at.replace(minute=45), 0.8, 230, "p-5", "Auckland"),
        ("k-19", at.replace(hour=7, minute=10), -0.4, 0, "p-6", "Dunedin"),
        ("k-20", at.replace(hour=7, minute=20), 31.5, 250, "p-7", "Auckland"),
        (None, at.replace(hour=7), 0.5, 240, None, "Wellington"),
    ]
    return spark.createDataFrame(rows, STREAM_RECORD)


@pytest.fixture
def as_stream(spark, tmp_path):
    """Write topic rows as files and read them back as a stream."""

    def make(df, name="topic", **options):
        path = str(tmp_path / name)
        df.write.mode("append").parquet(path)
        return spark.readStream.schema(TOPIC_RECORD).options(**options).parquet(path)

    return make
