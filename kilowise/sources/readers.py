"""Sources. The format is always a parameter: a job runs the same on Kafka, Delta
or JDBC, where the connector is installed, and on files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilowise.operators.enrich import parse_json
from kilowise.schemas import TOPIC_RECORD

TOPIC_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

# Defaults of a topic read; offsets per trigger belong to the reader.
KAFKA_STREAM_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false", "minPartitions": "1"}
KAFKA_BATCH_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_topic(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    streaming: bool = True,
    path: str | None = None,
) -> DataFrame:
    """A topic as rows of key, value and position; ``fmt`` may be a file format
    whose files have the same columns."""
    options = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        options = {**(KAFKA_STREAM_OPTIONS if streaming else KAFKA_BATCH_OPTIONS), **options}
    else:
        reader = reader.schema(TOPIC_RECORD)
    reader = reader.format(fmt).options(**options)
    return (reader.load(path) if path else reader.load()).select(*TOPIC_COLUMNS)


def topic_messages(
    s: DataFrame, topic: str, number: str, ts: str, fields: Sequence[Column], partitions: int = 1
) -> DataFrame:
    """Rows in topic shape with a JSON body, dealt to the partitions in turn by their number."""
    place = F.col(number).cast("bigint")
    return s.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(place, F.lit(partitions)).cast("int").alias("partition"),
        F.floor(place / partitions).cast("bigint").alias("offset"),
        F.col(ts).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def kafka_topic_table(raw: DataFrame, schema: T.StructType, view: str | None = None) -> DataFrame:
    """A topic as a table: message fields plus ``_partition_id, _offset, _timestamp``."""
    positioned = raw.select(
        "value",
        F.col("partition").alias("_partition_id"),
        F.col("offset").alias("_offset"),
        F.col("timestamp").alias("_timestamp"),
    )
    table = parse_json(positioned, schema, keep=("_partition_id", "_offset", "_timestamp"))
    if view:
        table.createOrReplaceTempView(view)
    return table


def read_table(
    spark: SparkSession,
    fmt: str,
    location: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stored table: parquet, orc, csv, json, or delta where its jar is present."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(location)


def read_text_lines(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lines, or whole files, with the file they come from."""
    return (
        spark.read.text(path, wholetext=whole)
        .select(F.col("_metadata.file_path").alias("file_path"), "value")
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a prefix and their sizes, without reading their content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("n_bytes"))
    )


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Options of a relational read; with a partition column the table is read in
    parallel ranges instead of through one connection."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def federated_query(spark: SparkSession, frames: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """One statement over tables of any source; the plan is optimized as a whole."""
    return spark.sql(sql, **frames)
