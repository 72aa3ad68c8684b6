"""A table scan as a job: page after page by update time and key, committed with the progress after it."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from time import monotonic, sleep

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdcflow import files
from cdcflow.config import CaptureOptions
from cdcflow.functions.values import value_text
from cdcflow.operators.ordered import block
from cdcflow.operators.paging import page_order, page_progress, rows_after, until_ms
from cdcflow.sources.tables import key_columns
from cdcflow.streaming.manifest import Manifest

ROWS_PER_ZONE = 1_000_000
ROWS_PER_COMMIT = 1_000_000
_ZONE, _START, _PAGE, _PART = "_zone", "_start", "_page", "_part"


def scan_job(
    read: Callable[[], DataFrame],
    options: CaptureOptions,
    path: str,
    saved: Mapping[str, str] | None = None,
    stop_after_ms: int | None = None,
    stop: Callable[[], bool] = lambda: False,
) -> dict[str, str]:
    """Commit a table's pages of ``page_size`` rows until there are no more, and give the progress.

    The job goes on from what is committed under ``path``, or from ``saved`` if nothing is, so one that was killed
    neither loses nor repeats a row. A look at the table lays out the rows after the progress in page order, all at once; its pages
    are committed from there, first one, then two, four and so on together, up to a million rows, each time with the progress
    after them. Rows that the table gains in between are left to the next look, so they belong to one page only. With ``wait_ms``,
    the table is looked at again after a look without rows, that long after the last one, until ``stop`` says so; without, such
    a look ends the job. ``stop`` is asked after each commit. ``stop_after_ms`` leaves later update times to the change log.
    """
    table = read()
    spark, (keys, at) = table.sparkSession, key_columns(table, options)
    manifest = Manifest(spark, path)
    while True:
        started = monotonic()
        before = manifest.newest()
        progress = before["note"].get("progress", dict(saved or {}))
        table = read()
        if stop_after_ms is not None:
            table = table.where(until_ms(table, at, stop_after_ms))
        rows = table.where(rows_after(table, at, keys, progress)) if progress else table
        found, first, together, stopped = _Pages(rows, at, keys, options, f"{path}/look"), 0, 1, False
        while first < found.pages and not stopped:
            last = min(first + together, found.pages)
            some, number = found.rows(first, last), before["batch"] + 1
            progress = page_progress(some, at, keys, progress)
            out = some.select(*[F.col(f"_text{i}").alias(c) for i, c in enumerate(found.columns)], (F.col(_PAGE) + number).alias("page"))
            manifest.commit(number + last - 1, append={"rows": out}, note={"progress": progress})
            stopped = stop()
            first, together = last, max(1, min(2 * together, ROWS_PER_COMMIT // options.page_size))
        files.remove(spark, f"{path}/look")
        if not found.pages:
            if options.wait_ms <= 0 or stop():
                return progress
            sleep(max(0.0, options.wait_ms / 1000 - (monotonic() - started)))
        elif stopped:
            return progress


def scanned(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all committed pages, as text, with the page's number from 0."""
    return Manifest(spark, path).read("rows")


class _Pages:
    """A frame's rows in zones along the page order, with the places where its pages begin and end.

    A page ends with the row that fills it and the rows equal to that one in time and key. So where a zone's pages end depends
    on how many rows the page that is open at its start still lacks, and this on the zone before. Each zone says for every such
    number how many pages it ends and what its last one lacks; the driver goes through these answers from zone to zone.
    """

    def __init__(self, rows: DataFrame, at: str, keys: list[str], options: CaptureOptions, path: str):
        self.spark, self.path, self.size = rows.sparkSession, path, options.page_size
        self.columns = options.output_columns or rows.columns
        self.parts, self.pages = [], 0
        zones = math.ceil(rows.count() / ROWS_PER_ZONE)
        if not zones:
            return
        order = page_order(at, keys)
        text = [value_text(F.col(c), rows.schema[c].dataType).alias(f"_text{i}") for i, c in enumerate(self.columns)]
        placed = rows.select(*dict.fromkeys([at, *keys]), *text).repartitionByRange(zones, *order).withColumn(_ZONE, F.spark_partition_id())
        start = F.rank().over(Window.partitionBy(_ZONE).orderBy(*order)).cast("bigint") - 1
        placed.withColumn(_START, start).write.mode("overwrite").parquet(path)
        starts = self.spark.read.parquet(path).select(_ZONE, _START).groupBy(_ZONE)
        size = self.size

        def answers(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            ends, n = _ends(table)
            ended, lacks = pages_of(ends, np.arange(1, min(size, n) + 1), size)
            lists = [pa.array([a.astype(np.int64)], pa.list_(pa.int64())) for a in (ended, lacks)]
            return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([n], pa.int64()), *lists], ["zone", "n", "ended", "lacks"])

        opened, lacks, page = {}, size, 0
        for zone in starts.applyInArrow(answers, "zone int, n bigint, ended array<bigint>, lacks array<bigint>").orderBy("zone").toLocalIterator():
            opened[zone["zone"]] = (page, lacks)
            if lacks > zone["n"]:
                lacks -= zone["n"]
            else:
                page, lacks = page + zone["ended"][lacks - 1], zone["lacks"][lacks - 1]

        def cuts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            ends, n = _ends(table)
            page, lacks = opened[key[0].as_py()]
            low = [0]
            while (i := np.searchsorted(ends, low[-1] + lacks)) < len(ends) and ends[i] < n:
                low.append(int(ends[i]))
                lacks = size
            made = {_ZONE: [key[0].as_py()] * len(low), _PAGE: range(page, page + len(low)), "low": low, "high": [*low[1:], n]}
            return pa.table({name: pa.array(values, pa.int32() if name == _ZONE else pa.int64()) for name, values in made.items()})

        self.parts = sorted(tuple(p) for p in starts.applyInArrow(cuts, f"{_ZONE} int, {_PAGE} bigint, low bigint, high bigint").collect())
        self.pages = self.parts[-1][1] + 1

    def rows(self, first: int, last: int) -> DataFrame:
        """The rows of the pages from ``first`` to the one before ``last``, with the page's number in this look."""
        parts = [p for p in self.parts if first <= p[1] < last]
        made = self.spark.createDataFrame(parts, f"{_ZONE} int, {_PAGE} bigint, low bigint, high bigint")
        within = F.sequence(block(F.col("low"), self.size), block(F.col("high") - 1, self.size))
        made = made.withColumn(_PART, F.explode(within))
        rows = self.spark.read.parquet(self.path).where(F.col(_ZONE).between(parts[0][0], parts[-1][0]))
        found = rows.withColumn(_PART, block(F.col(_START), self.size)).join(F.broadcast(made), [_ZONE, _PART])
        return found.where((F.col(_START) >= F.col("low")) & (F.col(_START) < F.col("high")))


def _ends(table: pa.Table) -> tuple[np.ndarray, int]:
    """Where a zone's groups of equal rows end, in order, and its number of rows."""
    starts = np.unique(table[_START].to_numpy())
    return np.append(starts[1:], table.num_rows), table.num_rows


def pages_of(ends: np.ndarray, lacks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each number of rows that an open page lacks: how many pages end within these groups, and what the last one lacks then."""
    n, lacks = ends[-1], lacks.copy()
    place, ended = np.zeros(len(lacks), np.int64), np.zeros(len(lacks), np.int64)
    while True:
        i = np.searchsorted(ends, place + lacks)
        full = i < len(ends)
        if not full.any():
            return ended, lacks - (n - place)
        place[full] = ends[i[full]]
        ended[full] += 1
        lacks[full] = size
