"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.session import shared_dir


def small_batches(spark: SparkSession, rows: int = 2_000, most_bytes: str | None = None) -> SparkSession:
    """Hand whole texts to Python in batches of fewer rows, and fewer bytes, than Spark's default, to bound a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if most_bytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes)
    return spark


_scratch: list[str] | None = None


@contextmanager
def scratch(paths: list[str]) -> Iterator[None]:
    """Have the folders that ``saved`` writes meanwhile added to a list, for who knows when they are done with."""
    global _scratch
    outer, _scratch = _scratch, paths
    try:
        yield
    finally:
        _scratch = outer


def saved(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write a frame to the cluster's shared folder, in folders by some columns, and read it back: no executor that goes can take it along."""
    path = shared_dir(df.sparkSession, name)
    if _scratch is not None:
        _scratch.append(path)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names, so that whatever else a frame holds can't clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def same(a: Column, b: Column) -> Column:
    """Equality that holds for two nulls as well."""
    return a.eqNullSafe(b)


def text_key(text: Column | str) -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by whole-number keys as tables of whole groups, with the row where each group begins and the end."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        table = table.combine_chunks()
        starts = _starts(table, keys)
        if starts[-1]:
            yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.append(_starts(rest, keys), rest.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def tidy(fn: Callable) -> Callable:
    """``fn`` over a partition's Arrow batches; a worker lives on after its task, so what it freed goes back to the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
