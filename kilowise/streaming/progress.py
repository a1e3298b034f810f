"""State of running queries, from the progress records Spark keeps of them, or that a log stores of every batch."""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kilowise.plans.storage import path_exists, write_file


def stream_progress(
    spark: SparkSession, queries: Mapping[str, StreamingQuery], last: int | None = None
) -> DataFrame:
    """Input rows of the batches of each query, one record per batch: all that Spark keeps
    (spark.sql.streaming.numRecentProgressUpdates), or the ``last`` ones for a status view."""
    rows = [
        (name, int(p["batchId"]), int(p["numInputRows"]))
        for name, query in queries.items()
        for p in (query.recentProgress[-last:] if last else query.recentProgress)
    ]
    return spark.createDataFrame(rows, "query string, batch_id bigint, n_input_rows bigint")


class ProgressLog(StreamingQueryListener):
    """Stores the progress of every batch as a file of its own below ``path``. Spark keeps the last 100 records only.

    Enter it before the queries start. A replayed batch replaces its record; reports of an idle query do not.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self.failed: list[Exception] = []

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            file = f"{self.path}/query_id={p.id}/{p.batchId}.json"
            if p.numInputRows or not path_exists(self.spark, file):
                record = {"batch_id": p.batchId, "n_input_rows": p.numInputRows, "observed": observed_rows(p.observedMetrics)}
                write_file(self.spark, file, json.dumps(record) + "\n")
        except Exception as error:  # Spark only logs what a listener raises
            self.failed.append(error)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def _records(self, queries: Mapping[str, StreamingQuery], seconds: float) -> DataFrame:
        for name, query in queries.items():
            if not query.isActive and not self.ended[str(query.runId)].wait(seconds):
                raise TimeoutError(f"the end of query {name} was not reported")
        if self.failed:
            raise RuntimeError("progress was not stored") from self.failed[0]
        found = self.spark.createDataFrame([], f"query string, {RECORD}")
        for name, query in queries.items():
            folder = f"{self.path}/query_id={query.id}"
            if path_exists(self.spark, folder):
                rows = self.spark.read.schema(RECORD).json(folder)
                found = found.unionByName(rows.withColumn("query", F.lit(name)))
        return found

    def read(self, queries: Mapping[str, StreamingQuery], seconds: float = 120) -> DataFrame:
        """Input rows of all batches of each query, one record per batch. Waits for the last records of queries that have
        ended, which come ``seconds`` later at most."""
        return self._records(queries, seconds).select("query", "batch_id", "n_input_rows")

    def read_observed(self, queries: Mapping[str, StreamingQuery], seconds: float = 120) -> DataFrame:
        """query, batch_id, observation, metric, value: what ``observe`` counted in each batch, without a pass of its own."""
        records = self._records(queries, seconds)
        return records.select("query", "batch_id", F.inline("observed"))


RECORD = "batch_id bigint, n_input_rows bigint, observed array<struct<observation: string, metric: string, value: bigint>>"


def observed_rows(metrics: Mapping[str, Row]) -> list[dict]:
    return [
        {"observation": name, "metric": metric, "value": value} for name, row in metrics.items() for metric, value in row.asDict().items()
    ]


def stream_status(queries: Mapping[str, StreamingQuery]) -> dict[str, dict]:
    """Message, activity and error of each query."""
    status = {}
    for name, query in queries.items():
        error = query.exception()
        status[name] = {
            "active": query.isActive,
            "message": query.status["message"],
            "error": str(error) if error else None,
        }
    return status


def status_rows(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> DataFrame:
    """query, active, message, error: the state of each query as rows; a query without error has null there."""
    rows = [(name, x["active"], x["message"], x["error"]) for name, x in stream_status(queries).items()]
    return spark.createDataFrame(rows, "query string, active boolean, message string, error string")
