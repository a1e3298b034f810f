"""Broadcast only what its files prove to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Of compressed files; some five times as much in a hash table.
BROADCAST_BYTES = 16 << 20
_MANY_FILES = 1000


def base_bytes(df: DataFrame) -> int | None:
    """Bytes of all files that a frame reads, from the file system's listing; no job runs. A frame
    without files counts as the planner does; None for too many files to look at."""
    names = df.inputFiles()
    if len(names) > _MANY_FILES:
        return None
    context = df.sparkSession.sparkContext
    if not names:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    total = 0
    for name in names:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add the hint when the files below ``df`` are small, else leave the choice to the planner, which has
    a shuffle join with skew splitting, and to its adaptive step, which knows the true size.

    ``df`` must not multiply the rows of its files: filters, projections, distinct rows, and joins
    with tables of one row per key are fine.
    """
    size = base_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df
