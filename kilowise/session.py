"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of them can be set on a running session.
#
# AQE coalesces small shuffle partitions, splits skewed join partitions and
# turns a sort-merge join into a broadcast once the real size is known, so the
# jobs set no partition counts and no join hints beyond those of plans.sizing.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recursive statements end by their own guards, not by a number of rows.
    "spark.sql.cteRecursionRowLimit": "-1",
    # State of streams on local disk and in checkpoints instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that was built elsewhere."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "kilowise", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
