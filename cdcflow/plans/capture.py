"""The capture job: change events to output rows, from one options object."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cdcflow.config import NON_TIME_SUFFIX, ROW_OFFSET, CaptureOptions
from cdcflow.functions.values import stringify
from cdcflow.operators.changelog import (
    emit,
    from_position,
    from_timestamp,
    only_changes,
    only_tables,
    outside_txn_set,
    typed_columns,
)
from cdcflow.operators.paging import new_rows, next_offset, offset_page
from cdcflow.operators.progress import hand_over
from cdcflow.schema import OFFSETS, resolve_columns
from cdcflow.sources.tables import key_columns
from cdcflow.streaming.jobs import later_offsets
from cdcflow.streaming.manifest import Manifest, committed


def selected_changes(log: DataFrame, options: CaptureOptions, include_deletes: bool = False) -> DataFrame:
    """The events to emit: listed tables, from the start on, inserts and updates."""
    log = only_tables(log, options.db_tables)
    log = from_position(log, options.start_file, options.start_position)
    log = from_timestamp(log, options.start_timestamp_ms)
    return only_changes(outside_txn_set(log, options.gtid_set), include_deletes)


def capture(log: DataFrame, options: CaptureOptions, zone: str | None = None, **how) -> DataFrame:
    """Output rows of a change log.

    When the options ask for the zone shift, they or ``zone`` must name the zone.
    """
    return _emitted(selected_changes(log, options), options, zone, **how)


def _emitted(changes: DataFrame, options: CaptureOptions, zone: str | None = None, **how) -> DataFrame:
    shift = (zone or options.zone) if options.shift_to_local else None
    if options.shift_to_local and shift is None:
        raise ValueError("the zone shift is on, but no zone is given")
    return emit(changes, options.output_columns, shift_zone=shift, zoned=options.zoned_columns, **how)


def capture_stream(log: DataFrame, options: CaptureOptions, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Stream output rows and offsets, each batch's both or none: ``read_captured`` and ``read_offsets`` see committed batches only."""
    manifest = Manifest(log.sparkSession, path)

    def make(changes: DataFrame, before: dict) -> dict:
        offsets = later_offsets(changes, options.primary_key, options.update_time, manifest.read("offsets", before))
        return {"append": {"rows": _emitted(changes, options)}, "replace": {"offsets": offsets}}

    return committed(selected_changes(log, options), manifest, make, checkpoint, once=once)


def scan(
    table: DataFrame, options: CaptureOptions, saved: Mapping[str, str] | None = None
) -> tuple[DataFrame, dict[str, str]]:
    """Output rows that a table has gained since saved progress, and the progress after them.

    An incremental scan goes by update time and key, from the progress of an earlier scan or of the log. Else it
    takes the next page after the saved row offset, by its one key.
    """
    if options.incremental:
        keys, time = key_columns(table, options)
        place = {k: v for k, v in (saved or {}).items() if k in {time, *keys, *[key + NON_TIME_SUFFIX for key in keys]}}
        rows, progress = new_rows(table, time, keys, place)
        return stringify(rows, options.output_columns), progress
    (key,) = resolve_columns(table.columns, options.primary_key)
    start = int((saved or {}).get(ROW_OFFSET, options.row_offset))
    page = offset_page(table, key, start, options.page_size)
    return stringify(page, options.output_columns), {ROW_OFFSET: str(next_offset(start, page))}


def scan_offsets(spark: SparkSession, db_table: str, progress: Mapping[str, str]) -> DataFrame:
    """Progress of a scan as a row of the offsets table."""
    return spark.createDataFrame([(db_table, dict(progress), None, None, None, None, None)], OFFSETS)


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, options: CaptureOptions, log_start_ms: int) -> DataFrame:
    """A table's rows up to the log's start, then its changes, in the same columns."""
    log = selected_changes(log, options)
    changes = log.select("event_ts_ms", *typed_columns(log, snapshot.schema))
    return hand_over(snapshot, changes, options.update_time, log_start_ms)


def read_captured(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that ``capture_stream`` has committed; none before its first batch."""
    return Manifest(spark, path).read("rows")
