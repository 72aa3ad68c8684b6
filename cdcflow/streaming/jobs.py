"""Streaming jobs: rows to files, word totals, quality counts, handlers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdcflow.operators.nodes import observe_quality
from cdcflow.operators.progress import latest_offsets, merge_offsets
from cdcflow.operators.text import word_count
from cdcflow.schema import OFFSETS
from cdcflow.streaming.manifest import Manifest, committed


def emit_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append rows to Parquet files; the checkpoint and the file log make it exactly once."""
    return _start(rows.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, once)


def each_batch(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", once: bool = True
) -> StreamingQuery:
    """Hand each micro-batch to a handler. A batch can come again after a failure, with the same id."""
    return _start(rows.writeStream.foreachBatch(handle).outputMode(mode), checkpoint, once)


def by_table(handlers: Mapping[str, Iterable[Callable[[DataFrame, int], None]]]) -> Callable[[DataFrame, int], None]:
    """A batch handler that gives each table's events, read once, to all handlers registered for it."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.where(F.col("db_table").isin(list(handlers))).persist()
        try:
            for db_table, functions in handlers.items():
                for fn in functions:
                    fn(kept.where(F.col("db_table") == db_table), batch_id)
        finally:
            kept.unpersist()

    return handle


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def print_stream(rows: DataFrame, checkpoint: str, mode: str = "append", once: bool = True) -> StreamingQuery:
    """Rows to the console."""
    return _start(rows.writeStream.format("console").option("truncate", False).outputMode(mode), checkpoint, once)


def _largest(totals: DataFrame) -> DataFrame:
    return totals.groupBy("word").agg(F.max("n").alias("n"))


def count_words(lines: DataFrame, text: str, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Running word totals: each micro-batch commits the totals that it changed; older ones are merged from time to time."""
    manifest = Manifest(lines.sparkSession, path, merge={"totals": _largest})
    return committed(word_count(lines, text), manifest, lambda totals, _: {"append": {"totals": totals}}, checkpoint, "update", once)


def current_word_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest total per word. Totals only grow, so it is the greatest."""
    return _largest(_read(spark, path, "totals", "word string, n bigint"))


def later_offsets(changes: DataFrame, primary_key: list[str], update_time: str | None, saved: DataFrame | None) -> DataFrame:
    """Offsets after some more changes, laid over the saved ones; one row per table."""
    newest = latest_offsets(changes, primary_key, update_time)
    return (newest if saved is None else merge_offsets(saved, newest)).coalesce(1)


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """The offsets that a capture has committed together with its rows."""
    return _read(spark, path, "offsets", OFFSETS)


def _read(spark: SparkSession, path: str, table: str, schema) -> DataFrame:
    found = Manifest(spark, path).read(table)
    return spark.createDataFrame([], schema) if found is None else found


def check_quality(rows: DataFrame, rules: Mapping[str, Column], path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Rows of a stream together with how many of them pass and fail each rule, counted while they are written.

    Counts are committed with the batch they are of, so a batch that runs again doesn't count twice.
    """
    manifest = Manifest(rows.sparkSession, path, merge={"quality": _summed})

    def make(batch: DataFrame, _: dict) -> dict:
        seen = Observation()

        def counts() -> DataFrame:
            found = seen.get  # of the rows' write, which is done by now
            return rows.sparkSession.createDataFrame([(name, found[name], found["rows"] - found[name]) for name in rules], QUALITY)

        return {"append": {"rows": observe_quality(batch, seen, rules), "quality": counts}}

    return committed(rows, manifest, make, checkpoint, once=once)


QUALITY = "rule string, passed bigint, failed bigint"


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def quality_counts(spark: SparkSession, path: str) -> DataFrame:
    """rule, passed, failed over all batches that ``check_quality`` has committed."""
    return _summed(_read(spark, path, "quality", QUALITY))
