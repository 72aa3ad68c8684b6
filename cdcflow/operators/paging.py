"""Incremental pages of a table: by key, by offset, and as a polling loop."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.config import DEFAULT_PAGE_SIZE, DEFAULT_WAIT_MS, NON_TIME_SUFFIX
from cdcflow.operators.ordered import CHUNKS, block, running_sum

_TIMES = (T.TimestampType, T.TimestampNTZType)
_EPOCH_MS = re.compile(r"(-?\d+)(?:\.(\d{1,3}))?")


def page_order(update_time: str, primary_key: list[str]) -> list[Column]:
    """Rows without an update time first, then by time and key."""
    return [F.asc_nulls_first(update_time), *[F.asc(k) for k in primary_key]]


def _after(primary_key: list[str], values: list[Column]) -> Column:
    """Key greater than the saved one, compared column by column from the left."""
    arms, equal_so_far = [], F.lit(True)
    for k, v in zip(primary_key, values):
        arms.append(equal_so_far & (F.col(k) > v))
        equal_so_far = equal_so_far & (F.col(k) == v)
    return reduce(lambda a, b: a | b, arms)


def until_ms(table: DataFrame, update_time: str, ms: int) -> Column:
    """Update time within or before a millisecond, or none; in a form that the scan can use."""
    kind = table.schema[update_time].dataType
    at = F.col(update_time) if isinstance(kind, _TIMES) else F.col(update_time).cast("timestamp")
    bound = F.timestamp_millis(F.lit(ms + 1)).cast(kind if isinstance(kind, _TIMES) else "timestamp")
    return F.col(update_time).isNull() | (at < bound)


def progress_text(value: Column, data_type: T.DataType) -> Column:
    """Text of a value in saved progress. Times are epoch milliseconds, as in the log, with a fraction if they have one."""
    if not isinstance(data_type, _TIMES):
        return value.cast("string")
    micros = F.unix_micros(value.cast("timestamp"))
    rest = F.pmod(micros, F.lit(1000))
    ms = F.call_function("div", micros - rest, F.lit(1000)).cast("string")
    return F.when(rest == 0, ms).otherwise(F.concat(ms, F.lit("."), F.lpad(rest.cast("string"), 3, "0")))


def saved_value(text: str, data_type: T.DataType) -> Column:
    """Value of a text in saved progress, whether a scan or the log has saved it. Times may also be written out."""
    number = _EPOCH_MS.fullmatch(text.strip())
    if not isinstance(data_type, _TIMES) or not number:
        return F.lit(text).cast(data_type)
    micros = int(number[1]) * 1000 + int((number[2] or "0").ljust(3, "0"))
    return F.timestamp_micros(F.lit(micros)).cast(data_type)


def rows_after(table: DataFrame, update_time: str, primary_key: list[str], saved: Mapping[str, str]) -> Column:
    """Which rows come after saved progress.

    Rows with a time: later ones, and those of the same time with a greater key; all of them if no
    time was saved. Rows without: those with a greater key than the last one seen without a time.
    """
    typed = lambda name, text: saved_value(text, table.schema[name].dataType)
    keys = lambda suffix: [typed(k, saved[k + suffix]) for k in primary_key]
    has_time = update_time in saved and all(k in saved for k in primary_key)
    has_no_time = all(k + NON_TIME_SUFFIX in saved for k in primary_key)
    if not has_time and not has_no_time:
        raise ValueError("saved progress has neither an update time nor a key")
    t = F.col(update_time)
    if has_time:
        at = typed(update_time, saved[update_time])
        timed = (t > at) | ((t == at) & _after(primary_key, keys("")))
    else:
        timed = t.isNotNull()
    untimed = t.isNull() & _after(primary_key, keys(NON_TIME_SUFFIX)) if has_no_time else t.isNull()
    return timed | untimed


def keyset_page(
    table: DataFrame,
    update_time: str,
    primary_key: list[str],
    saved: Mapping[str, str] | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """The first page, or the next one after saved progress, as a top-n over the filtered scan."""
    rows = table.where(rows_after(table, update_time, primary_key, saved)) if saved else table
    return rows.orderBy(*page_order(update_time, primary_key)).limit(page_size)


def page_progress(
    page: DataFrame, update_time: str, primary_key: list[str], saved: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Progress after a page: its last row with a time and its last row without one."""
    has_time = F.col(update_time).isNotNull()
    text = lambda c: progress_text(F.col(c), page.schema[c].dataType)
    key = F.struct(*[text(k).alias(k) for k in primary_key])
    row = F.struct(text(update_time).alias("t"), key.alias("k"))
    by = F.struct(update_time, *primary_key)
    timed = F.max_by(row, F.when(has_time, by)).alias("timed")
    untimed = F.max_by(row, F.when(~has_time, by)).alias("untimed")
    found = page.agg(timed, untimed).first()
    out = dict(saved or {})
    if found["timed"] is not None:
        out |= {**found["timed"]["k"].asDict(), update_time: found["timed"]["t"]}
    if found["untimed"] is not None:
        out |= {k + NON_TIME_SUFFIX: v for k, v in found["untimed"]["k"].asDict().items()}
    return out


def progress_after(table: DataFrame, update_time: str, primary_key: list[str], saved: Mapping[str, str] | None = None, page_size: int | None = None) -> dict[str, str]:
    """Progress after the next page, or after all rows there are. Only key columns are read."""
    keys = table.select(*dict.fromkeys([update_time, *primary_key]))
    if page_size is not None:
        rows = keyset_page(keys, update_time, primary_key, saved, page_size)
    else:
        rows = keys.where(rows_after(keys, update_time, primary_key, saved)) if saved else keys
    return page_progress(rows, update_time, primary_key, saved)


def page_rows(
    table: DataFrame, update_time: str, primary_key: list[str], saved: Mapping[str, str] | None, progress: Mapping[str, str]
) -> DataFrame:
    """Rows after saved progress and up to a later one, whatever the table has gained beyond."""
    rows = table.where(rows_after(table, update_time, primary_key, saved)) if saved else table
    return rows.where(~F.coalesce(rows_after(table, update_time, primary_key, progress), F.lit(False))) if progress else rows.limit(0)


def new_rows(
    table: DataFrame, update_time: str, primary_key: list[str], saved: Mapping[str, str] | None = None
) -> tuple[DataFrame, dict[str, str]]:
    """All rows after saved progress as one parallel read, and the progress after them.

    What the pages hold together, for tables too large to be paged through. The read ends at the progress found, so rows that
    come in between are left to the next one.
    """
    progress = progress_after(table, update_time, primary_key, saved)
    return page_rows(table, update_time, primary_key, saved, progress), progress


def keyset_pages(
    read: Callable[[], DataFrame],
    update_time: str,
    primary_key: list[str],
    saved: Mapping[str, str] | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
    wait_ms: int = DEFAULT_WAIT_MS,
    stop_after_ms: int | None = None,
) -> Iterator[tuple[DataFrame, dict[str, str]]]:
    """Pages with the progress after each, until one is empty.

    With a wait, an empty page is followed by another look at the table. ``stop_after_ms`` ends
    the scan once update times pass it; those rows are left to the change log.
    """
    progress = dict(saved or {})
    while True:
        started = time.monotonic()
        table = read()
        if stop_after_ms is not None:
            table = table.where(until_ms(table, update_time, stop_after_ms))
        page = keyset_page(table, update_time, primary_key, progress, page_size).persist()
        try:
            after = page_progress(page, update_time, primary_key, progress)
            if after != progress:
                yield page, after
                progress = after
                continue
        finally:
            page.unpersist()
        left = wait_ms / 1000 - (time.monotonic() - started)
        if left <= 0:
            return
        time.sleep(left)


def offset_page(
    table: DataFrame, primary_key: str, offset: int, page_size: int = DEFAULT_PAGE_SIZE, rows_per_chunk: int = 1_000_000
) -> DataFrame:
    """``page_size`` rows after the first ``offset`` by an integer key, however deep.

    Rows are counted per block of keys first; only the blocks that hold the page are sorted. As
    each such block adds a row to the page, there are at most ``page_size`` of them to send out.
    """
    coarse, fine = CHUNKS
    counts = table.groupBy(block(F.col(primary_key), rows_per_chunk).alias(fine)).agg(F.count("*").alias("_n"))
    counts = counts.withColumn(coarse, block(F.col(fine), rows_per_chunk))
    ends = running_sum(counts, [], [coarse], [fine], F.col("_n"), "_end")
    holding = ends.where((F.col("_end") > offset) & (F.col("_end") - F.col("_n") < offset + page_size))
    rows = table.withColumn(fine, block(F.col(primary_key), rows_per_chunk)).join(
        F.broadcast(holding.select(fine, (F.col("_end") - F.col("_n")).alias("_before"))), fine
    )
    place = F.row_number().over(Window.partitionBy(fine).orderBy(primary_key)) + F.col("_before")
    return (
        rows.withColumn("_place", place)
        .where((F.col("_place") > offset) & (F.col("_place") <= offset + page_size))
        .select(*table.columns)
    )


def next_offset(previous: int | None, page: DataFrame) -> int:
    """Row offset after a page."""
    return (previous or 0) + page.count()
