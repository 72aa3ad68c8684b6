"""Change events derived from the ``events`` table, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators.ordered import CHUNKS, block, blocks, last_value
from cdcflow.plans.registry import table

EVENTS_PER_FILE = 400
EVENTS_PER_BLOCK = 100_000
SOURCE_UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
EVENTS_PER_NAME = 300

IMAGE = ["user_id", "event_type", "amount", "payload", "updated"]


def change_log(spark: SparkSession, sf_dir: str, before: bool = False) -> DataFrame:
    """One change event per row of ``events``, the row image as a typed struct.

    ``before`` adds the image of the same user's previous event.
    """
    return changes_of(table(spark, sf_dir, "events"), before)


def changes_of(events: DataFrame, before: bool = False) -> DataFrame:
    """The same for any frame of events, streaming ones included (without ``before``)."""
    event_type, event_id = F.col("event_type"), F.col("event_id")
    file_no = block(event_id, EVENTS_PER_FILE) + 1
    ts = F.col("ts").cast("timestamp")
    # Users of one table never have an update time, as some tables do.
    updated = F.when(F.col("user_id") % 3 != 1, ts)
    log = events.select(
        "event_id",
        F.when(event_type == "signup", "insert").when(event_type == "error", "delete").otherwise("update").alias("op"),
        F.concat(F.lit("app.user_"), F.col("user_id") % 3).alias("db_table"),
        file_no.alias("file_no"),
        file_name(file_no).alias("binlog_file"),
        position(event_id).alias("binlog_pos"),
        F.lit(0).alias("row_seq"),
        F.unix_millis(ts).alias("event_ts_ms"),
        F.concat(F.lit(f"{SOURCE_UUID}:"), event_id + 1).alias("gtid"),
        F.struct(
            "user_id",
            "event_type",
            F.col("value").cast("decimal(18,2)").alias("amount"),
            F.encode("props", "UTF-8").alias("payload"),
            updated.alias("updated"),
        ).alias("after"),
    )
    if not before:
        return log
    return (
        log.withColumns({"_user": F.col("after.user_id"), **blocks(F.col("event_id"), EVENTS_PER_BLOCK)})
        .transform(last_value, ["_user"], CHUNKS, ["event_id"], F.col("after"), "before", inclusive=False)
        .drop("_user", *CHUNKS)
    )


def file_name(number: Column) -> Column:
    text = number.cast("string")
    return F.concat(F.lit("mysql-bin."), F.lpad(text, F.greatest(F.length(text), F.lit(6)), "0"))


def position(event_id: Column) -> Column:
    return event_id % EVENTS_PER_FILE * 100 + 4


def row_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as row events by table id, without their cells."""
    return change_log(spark, sf_dir).withColumn("table_id", F.col("after.user_id") % 3 + 100).drop("after", "db_table")


def row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as row events with cell arrays.

    Some inserts lack a cell and some updates have one too many.
    """

    def cells(image: str) -> Column:
        return F.array(
            F.col(image)["user_id"].cast("string"), F.col(image)["event_type"], F.decode(F.col(image)["payload"], "UTF-8")
        )

    log = change_log(spark, sf_dir, before=True)
    after, user = cells("after"), F.col("after.user_id")
    short = (F.col("op") == "insert") & (user % 7 == 0)
    long = (F.col("op") == "update") & (user % 5 == 0)
    after_cells = F.when(short, F.slice(after, 1, 2)).when(long, F.concat(after, F.array(F.lit("extra")))).otherwise(after)
    return log.withColumns(
        {
            "before_cells": F.when(F.col("op") != "insert", F.when(F.col("op") == "delete", after).otherwise(cells("before"))),
            "after_cells": F.when(F.col("op") != "delete", after_cells),
        }
    ).drop("before", "after")


def table_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table maps: each id gets a new name with its first event of every few hundred."""
    log = change_log(spark, sf_dir)
    table_id, period = F.col("after.user_id") % 3, block(F.col("event_id"), EVENTS_PER_NAME)
    firsts = log.groupBy(table_id.alias("n"), period.alias("period")).agg(
        F.min("event_id").alias("event_id"), F.min("event_ts_ms").alias("event_ts_ms")
    )
    return firsts.select(
        (F.col("n") + 100).alias("table_id"),
        F.concat(F.lit("app.user_"), "n", F.lit("_v"), "period").alias("db_table"),
        file_name(block(F.col("event_id"), EVENTS_PER_FILE) + 1).alias("binlog_file"),
        (position(F.col("event_id")) - 1).alias("binlog_pos"),
        "event_ts_ms",
    )


LOG_SQL = f"""log AS (
  SELECT event_id,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
         'app.user_' || CAST(user_id % 3 AS VARCHAR) AS db_table,
         1 + event_id // {EVENTS_PER_FILE} AS file_no,
         'mysql-bin.' || printf('%06d', 1 + event_id // {EVENTS_PER_FILE}) AS binlog_file,
         4 + event_id % {EVENTS_PER_FILE} * 100 AS binlog_pos,
         epoch_us(ts) // 1000 AS event_ts_ms,
         '{SOURCE_UUID}:' || CAST(event_id + 1 AS VARCHAR) AS gtid,
         user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount, props AS payload, ts,
         CASE WHEN user_id % 3 <> 1 THEN ts END AS updated
  FROM events)"""

LOG_BEFORE_SQL = (
    LOG_SQL
    + """, pairs AS (
  SELECT *,
         lag(user_id) OVER w AS b_user_id, lag(event_type) OVER w AS b_event_type, lag(payload) OVER w AS b_payload
  FROM log WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""
)
