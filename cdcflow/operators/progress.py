"""Progress of a capture: latest offsets, hand-over from a snapshot, backlog, fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.config import (
    BINLOG_FILE_NAME,
    BINLOG_POSITION,
    BINLOG_TIMESTAMP,
    GTID,
    NON_TIME_SUFFIX,
)
from cdcflow.functions.values import file_number, has_text
from cdcflow.operators.changelog import emit_columns
from cdcflow.operators.joins import lookup_join
from cdcflow.operators.ordered import CHUNKS, blocks, last_value
from cdcflow.operators.paging import until_ms

# Queue size a backlog is measured against, and the alert level.
BACKLOG_CAPACITY = 10_000
BACKLOG_LEVEL = 0.8

SAMPLES_PER_BLOCK = 100_000


def progress_keys(primary_key: list[str], update_time: str | None, text_of) -> Column:
    """Key values saved for a row: key and time, or the key under its no-time name."""
    plain = [(F.lit(k), text_of(k)) for k in primary_key]
    blank = [(F.lit(k + NON_TIME_SUFFIX), text_of(k)) for k in primary_key]
    no_time = F.create_map(*[c for pair in blank for c in pair])
    if not update_time:
        return no_time
    with_time = F.create_map(*[c for pair in [*plain, (F.lit(update_time), text_of(update_time))] for c in pair])
    return F.when(has_text(text_of(update_time)), with_time).otherwise(no_time)


def latest_offsets(log: DataFrame, primary_key: list[str], update_time: str | None) -> DataFrame:
    """Per table, the place and key values of its last event.

    A hot table shrinks to one row per task ahead of the shuffle; texts are made of what is left.
    """
    wanted = [*primary_key, *([update_time] if update_time else [])]
    image = log.schema["after"].dataType
    kept = F.col("after") if isinstance(image, T.MapType) else F.struct(*[F.col("after")[c].alias(c) for c in wanted])
    newest = log.groupBy("db_table").agg(
        F.max_by(
            F.struct("binlog_file", "binlog_pos", "event_ts_ms", "gtid", "row_seq", kept.alias("after")),
            F.struct(file_number(F.col("binlog_file")), "binlog_pos", "row_seq"),
        ).alias("at")
    )
    rows = newest.select("db_table", "at.*")
    rows = rows.select("*", F.struct(*emit_columns(rows, wanted)).alias("texts"))
    return rows.select(
        "db_table",
        progress_keys(primary_key, update_time, lambda c: F.col("texts")[c]).alias("info"),
        "binlog_file",
        "binlog_pos",
        "event_ts_ms",
        "gtid",
        "row_seq",
    )


def merge_offsets(saved: DataFrame, newer: DataFrame) -> DataFrame:
    """Saved offsets with later ones laid over them; a table's furthest position wins."""
    both = saved.unionByName(newer)
    row = F.struct(*[c for c in both.columns if c != "db_table"])
    return (
        both.groupBy("db_table")
        .agg(F.max_by(row, F.struct(file_number(F.col("binlog_file")), "binlog_pos", "row_seq")).alias("at"))
        .select("db_table", "at.*")
    )


def saved_progress(offsets: DataFrame, db_table: str) -> dict[str, str]:
    """One table's saved values by their property names, empty if there are none."""
    row = offsets.where(F.col("db_table") == db_table).first()
    if row is None:
        return {}
    at = {
        BINLOG_FILE_NAME: row["binlog_file"],
        BINLOG_POSITION: row["binlog_pos"],
        BINLOG_TIMESTAMP: row["event_ts_ms"],
        GTID: row["gtid"],
    }
    return {k: str(v) for k, v in {**(row["info"] or {}), **at}.items() if v is not None}


def hand_over(snapshot: DataFrame, changes: DataFrame, update_time: str, log_start_ms: int) -> DataFrame:
    """Snapshot rows up to the log's start, then the log from its start; both ends included."""
    before = snapshot.where(until_ms(snapshot, update_time, log_start_ms))
    after = changes.where(F.col("event_ts_ms") >= log_start_ms).select(*snapshot.columns)
    return before.unionByName(after)


def first_event_time(table_maps: DataFrame) -> DataFrame:
    """Time of the earliest table map."""
    return table_maps.agg(F.min("event_ts_ms").alias("first_event_ts_ms"))


def backlog_alerts(
    levels: DataFrame, time: str, level: str, capacity: int = BACKLOG_CAPACITY, threshold: float = BACKLOG_LEVEL
) -> DataFrame:
    """``alert`` at every level over the threshold, ``recovered`` at the first one back under it.

    Levels are samples with a time (a timestamp or a whole number) and are looked at in its order, in blocks of time; samples
    without a time or level are left out.
    """
    known = levels.where(F.col(time).isNotNull() & F.col(level).isNotNull())
    is_number = isinstance(levels.schema[time].dataType, T.IntegralType)
    at = F.col(time).cast("bigint") if is_number else F.unix_seconds(F.col(time).cast("timestamp"))
    full = F.col(level) > F.lit(capacity * threshold)
    states = last_value(
        known.withColumns(blocks(at, SAMPLES_PER_BLOCK)), [], CHUNKS, [time], full, "_was_full", inclusive=False
    )
    state = F.when(full, "alert").when(F.col("_was_full"), "recovered")
    return states.withColumn("state", state).where(F.col("state").isNotNull()).drop("_was_full", *CHUNKS)


def fan_out(log: DataFrame, handlers: DataFrame) -> DataFrame:
    """Each event once per handler registered for its table."""
    return lookup_join(log, handlers, ["db_table"])
