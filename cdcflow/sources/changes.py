"""Change events and text lines, read where they land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.values import utf8_text
from cdcflow.schema import CHANGE_EVENT


def read_changes(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = CHANGE_EVENT
) -> DataFrame:
    """Change events landed as files."""
    return spark.read.format(fmt).schema(schema).load(path)


def stream_changes(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = CHANGE_EVENT,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same as a stream; ``files_per_batch`` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:  # pragma: no cover - needs the Kafka package and a broker
    """Change events as JSON records of a Kafka topic."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return parse_records(reader.load())


_UNREADABLE = "_unreadable"


def _parsed(records: DataFrame, value: str, schema: T.StructType, mode: str) -> Column:
    options = {"mode": mode, "columnNameOfCorruptRecord": _UNREADABLE}
    fields = T.StructType([*schema, T.StructField(_UNREADABLE, T.StringType())])
    return F.from_json(utf8_text(F.col(value)), fields if mode == "PERMISSIVE" else schema, options)


def parse_records(
    records: DataFrame, value: str = "value", schema: T.StructType = CHANGE_EVENT, strict: bool = False
) -> DataFrame:
    """JSON records, text or bytes, to change events.

    Records that are no such events (null, empty, broken or with a value of another type) are in
    ``unreadable_records``, or end the job with ``strict``.
    """
    if strict:
        return records.select(_parsed(records, value, schema, "FAILFAST").alias("_e")).select("_e.*")
    events = records.select(_parsed(records, value, schema, "PERMISSIVE").alias("_e")).where(_is_readable(F.col("_e")))
    return events.select(*[F.col("_e")[name].alias(name) for name in schema.names])


def unreadable_records(records: DataFrame, value: str = "value", schema: T.StructType = CHANGE_EVENT) -> DataFrame:
    """The records that give no change event, as they came."""
    parsed = records.withColumn("_e", _parsed(records, value, schema, "PERMISSIVE"))
    return parsed.where(~_is_readable(F.col("_e"))).drop("_e")


def _is_readable(event: Column) -> Column:
    return event.isNotNull() & event[_UNREADABLE].isNull()


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text lines of arriving files."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines of a socket."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def stream_sequence(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """An endless sequence of numbers."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load().select("value")
