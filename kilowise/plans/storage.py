"""Work folders and small table writes.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``,
so that they outlive a lost executor. Only a local session without that setting
gets a temporary folder.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowise.plans.sizing import broadcast_if_small

_LOCAL_BASE: list[str] = []
_TOPICS: dict[tuple[str, str], str] = {}  # stored once per application and folder
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_BASE:
        _LOCAL_BASE.append(tempfile.mkdtemp(prefix="kilowise-"))
    return _LOCAL_BASE[0]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below one folder per application; writers create it."""
    return f"{shared_base(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside delete their shuffle files when they end. Else these stay until the driver
    happens to collect its garbage, and all the shuffles of a long job lie on disk together."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table and read it back.

    Cuts the lineage, makes later reads see one fixed result even when a task
    runs twice, and gives the planner the true size of the table. A join of many
    rows with a table of one row per key is then a join of two plain shuffles,
    which AQE can split at a key that holds a large share of the rows; it cannot
    when one side comes straight out of an aggregation. What was shuffled for it is deleted.
    """
    path = work_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` stored and that nothing will read again; other files are left alone."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            if folder.split("/")[-2] == spark.sparkContext.applicationId:
                remove(spark, folder)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace one small file."""
    files, target = _file_system(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str | None:
    """Text of one small file; None if there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    found = files.open(target)
    try:
        return bytes(found.readAllBytes()).decode()
    finally:
        found.close()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, into parents that are made where they are missing."""
    files, source = _file_system(spark, path)
    _, target = _file_system(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def clean_up(spark: SparkSession) -> None:
    """Delete all work folders of this application; for the end of a job."""
    _TOPICS.clear()
    remove(spark, f"{shared_base(spark)}/{spark.sparkContext.applicationId}")


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers, ascending, of the folders ``<prefix><number>`` below a path whose write came to its end, also of those
    that ``publish_view`` keeps out of sight."""
    return sorted({*_shown(spark, path, prefix), *_shown(spark, f"{path}/{OLD}", prefix)})


def _shown(spark: SparkSession, path: str, prefix: str) -> list[int]:
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    names = [x.getPath().getName() for x in files.listStatus(target) if x.isDirectory()]
    numbers = sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())
    return [n for n in numbers if path_exists(spark, f"{path}/{prefix}{n}/_SUCCESS")]


def publish(df: DataFrame, path: str, version: int | None = None, keep: int = 2) -> DataFrame:
    """Write a new version of a table beside the last one and return it.

    Readers take the newest version whose write ended, so they see the old state or the new one and a
    lost driver leaves the old one. ``df`` may read the table. Writing a version again replaces it;
    versions but the ``keep`` newest are deleted.
    """
    spark = df.sparkSession
    if version is None:
        version = max(_shown(spark, path, "v="), default=-1) + 1
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/v={version}")
    for old in _shown(spark, path, "v=")[:-keep]:
        remove(spark, f"{path}/v={old}")
    return spark.read.parquet(f"{path}/v={version}")


def read_published(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest version, or the newest one below ``before``; None if there is none."""
    for folder in (path, f"{path}/{OLD}"):
        versions = [v for v in _shown(spark, folder, "v=") if before is None or v < before]
        if versions:
            return spark.read.parquet(f"{folder}/v={versions[-1]}")
    return None


OLD, NEW = "_old", "_new"  # folders that readers of the folder above do not look into


def publish_view(df: DataFrame, path: str) -> DataFrame:
    """Replace a stored view and return it. A plain reader of the folder finds one version, its number in ``v``.

    The new version is written aside. Then the old one is moved out of sight and the new one in, so a reader
    sees the old rows or the new ones, never both; ``read_published`` finds the old ones also between the two
    moves, and after a driver was lost there. ``df`` may read the view; the version before is kept for readers that began with it.
    """
    spark = df.sparkSession
    shown, hidden = _shown(spark, path, "v="), _shown(spark, f"{path}/{OLD}", "v=")
    version = max([*shown, *hidden], default=-1) + 1
    aside = f"{path}/{NEW}/v={version}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(aside)
    for old in shown:
        move(spark, f"{path}/v={old}", f"{path}/{OLD}/v={old}")
    move(spark, aside, f"{path}/v={version}")
    for old in hidden if shown else hidden[:-1]:
        remove(spark, f"{path}/{OLD}/v={old}")
    return spark.read.parquet(f"{path}/v={version}")


def write_partitions(df: DataFrame, path: str, *columns: str, sort_by: Sequence[str] = ()) -> None:
    """Replace just the partitions that occur in ``df``.

    The rebalance step gives each partition value few files and lets AQE split
    a value that holds far more rows than the others. Rows sorted inside the files
    give their row groups narrow ranges, which readers use to skip them.
    """
    spread = df.hint("rebalance", *columns)
    if sort_by:
        spread = spread.sortWithinPartitions(*columns, *sort_by)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, *columns: str, sort_by: Sequence[str] = ()) -> None:
    """Replace a whole folder by ``df``, one folder per partition value inside, as ``write_partitions`` spreads it."""
    spread = df.hint("rebalance", *columns)
    if sort_by:
        spread = spread.sortWithinPartitions(*columns, *sort_by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*columns).parquet(path)


def monthly_partitions(readings: DataFrame, path: str, ts: str = "reading_ts") -> DataFrame:
    """Store readings by month, then count each month from the stored table."""
    by_month = readings.withColumn("year_month", F.date_format(ts, "yyyy-MM"))
    write_partitions(by_month, path, "year_month", sort_by=["customer_id", ts])
    stored = readings.sparkSession.read.option("basePath", path).parquet(path)
    return stored.groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def reload_partition(df: DataFrame, path: str, column: str, value: object) -> None:
    """Delete and insert: the partition holds exactly ``df`` afterwards, be it empty.

    The new files are written aside and take the partition's place by renaming; what stood there
    is deleted last. If a job ended between the two steps, the next call puts the old files back first.
    """
    spark = df.sparkSession
    final, new, old = (f"{path}/{x}{column}={value}" for x in ("", "_new/", "_old/"))
    files, target = _file_system(spark, final)
    _, aside = _file_system(spark, old)
    if files.exists(aside) and not files.exists(target):
        files.rename(aside, target)
    files.delete(aside, True)
    df.drop(column).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(new)
    if files.exists(target):
        files.mkdirs(aside.getParent())
        files.rename(target, aside)
    else:
        files.mkdirs(target.getParent())
    files.rename(_file_system(spark, new)[1], target)
    files.delete(aside, True)


def read_months(
    spark: SparkSession, path: str, start: str, before: str, ts: str = "reading_ts"
) -> DataFrame:
    """Readings of a time span from a table stored by month; other months' folders
    are not opened."""
    stored = spark.read.parquet(path)
    month = F.col("year_month").cast("string")
    span = month.between(start[:7], before[:7]) & (F.col(ts) >= start) & (F.col(ts) < before)
    return stored.filter(span).drop("year_month")


def read_calendar_months(spark: SparkSession, path: str, calendar: DataFrame) -> DataFrame:
    """Readings of the months that a calendar (year_month and further columns) names, from a table stored by month.

    Which months those are is known when the calendar has been read; the scan of the readings waits for it and opens the
    folders of these months only (dynamic partition pruning). The calendar is stored first; at a row per month it is small
    enough to be broadcast, which the pruning needs.
    """
    stored = spark.read.parquet(path)
    months = calendar.withColumn("year_month", F.col("year_month").cast(stored.schema["year_month"].dataType))
    # Spark prunes by a side that is filtered; the stored calendar holds the named months only, so any test of them will do.
    months = materialize(months, "calendar").filter(F.col("year_month").cast("string") > "")
    return stored.join(broadcast_if_small(months), "year_month")


def refresh_mv(build: Callable[[], DataFrame], path: str) -> DataFrame:
    """Recompute a stored view and return the stored table. Any reader of the folder finds one complete state."""
    return publish_view(build(), path)
