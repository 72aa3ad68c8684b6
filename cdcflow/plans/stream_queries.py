"""Queries that run as streams over the tables' files, to the end of the input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow import sinks
from cdcflow.config import CaptureOptions
from cdcflow.operators import changelog as C
from cdcflow.plans.capture import capture_stream, read_captured
from cdcflow.functions.values import file_number
from cdcflow.plans.derived import LOG_SQL, change_log, changes_of, row_headers, table_maps
from cdcflow.plans.log_queries import START_MS, TEXT_SQL
from cdcflow.plans.registry import query, table
from cdcflow.plans.registry import SQL
from cdcflow.plans.text_queries import WORD_COUNT_SQL
from cdcflow.session import shared_dir
from cdcflow.sources.changes import stream_changes
from cdcflow.streaming import backlog, jobs, names, running
from cdcflow.streaming.manifest import Manifest, committed
from cdcflow.streaming.scan import scan_job, scanned


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream. The path is a pattern, which finds a file as well as a folder of files."""
    return stream_changes(spark, f"{sf_dir}/{name}.parque[t]", schema=table(spark, sf_dir, name).schema)


@query(WORD_COUNT_SQL)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "words")
    job = jobs.count_words(_stream(spark, sf_dir, "documents"), "text", f"{work}/counts", f"{work}/checkpoint")
    job.awaitTermination()
    return jobs.current_word_counts(spark, f"{work}/counts")


@query(f"WITH {LOG_SQL} SELECT binlog_file, binlog_pos, {TEXT_SQL} FROM log WHERE op <> 'delete'")
def stream_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "emit")
    log = C.only_changes(changes_of(_stream(spark, sf_dir, "events")))
    columns = ["user_id", "event_type", "amount", "payload", "updated"]
    rows = C.emit(log, columns, keep=["binlog_file", "binlog_pos"])
    jobs.emit_stream(rows, f"{work}/rows", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/rows")


OPTIONS = CaptureOptions(
    database="app",
    tables=["user_0", "user_1"],
    output_columns=["user_id", "event_type", "amount"],
    primary_key=["user_id"],
    update_time="updated",
    start_timestamp_ms=START_MS,
)
CAPTURED_SQL = f"""{LOG_SQL}, captured AS (
  SELECT * FROM log WHERE op <> 'delete' AND db_table IN ('app.user_0', 'app.user_1') AND event_ts_ms >= {START_MS})"""


def _capture(spark: SparkSession, sf_dir: str) -> str:
    work = shared_dir(spark, "capture")
    log = changes_of(_stream(spark, sf_dir, "events"))
    capture_stream(log, OPTIONS, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return f"{work}/out"


@query(
    f"""WITH {CAPTURED_SQL}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(amount AS VARCHAR) AS amount FROM captured"""
)
def stream_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_captured(spark, _capture(spark, sf_dir))


@query(
    f"""WITH {CAPTURED_SQL}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY db_table ORDER BY event_id DESC) AS rn FROM captured)
SELECT db_table, CAST(user_id AS VARCHAR) AS key, binlog_file, binlog_pos, event_ts_ms, gtid FROM newest WHERE rn = 1"""
)
def stream_capture_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = jobs.read_offsets(spark, _capture(spark, sf_dir))
    key = F.coalesce(F.try_element_at("info", F.lit("user_id")), F.try_element_at("info", F.lit("user_idNonTime")))
    return offsets.select("db_table", key.alias("key"), "binlog_file", "binlog_pos", "event_ts_ms", "gtid")


@query(
    f"""WITH {LOG_SQL} SELECT event_id, db_table, event_ts_ms FROM log
WHERE db_table = 'app.user_1' AND event_ts_ms >= {START_MS}"""
)
def landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log landed in folders by table and day, read with filters that prune them."""
    path = shared_dir(spark, "landed")
    sinks.land_changes(change_log(spark, sf_dir), path)
    log = C.from_timestamp(C.only_tables(spark.read.parquet(path), ["app.user_1"]), START_MS)
    return log.select("event_id", "db_table", "event_ts_ms")


def _in_parts(rows: DataFrame, order: Column, path: str, run: Callable[[], object], parts: int = 3) -> None:
    """Land a frame part after part along a whole number, and run a job after each, as if started again each time."""
    placed = rows.withColumn("_order", order)
    cuts = placed.stat.approxQuantile("_order", [i / parts for i in range(1, parts)], 0.01)
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        part = placed if low is None else placed.where(F.col("_order") >= low)
        part = part if high is None else part.where(F.col("_order") < high)
        part.drop("_order").write.mode("append").parquet(path)
        run()


@query(SQL["running_word_count"])
def stream_running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total at every word as documents arrive, the stream started three times."""
    work = shared_dir(spark, "running")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = Manifest(spark, f"{work}/out")

    def run() -> None:
        lines = stream_changes(spark, f"{work}/in", schema=docs.schema)
        rows = running.running_words(lines, "text", "doc_id")
        committed(rows, manifest, lambda batch, _: {"append": {"rows": batch}}, f"{work}/checkpoint").awaitTermination()

    _in_parts(docs, F.col("doc_id"), f"{work}/in", run)
    return manifest.read("rows")


@query(SQL["resolve_table_ids"])
def stream_resolve_table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events under the newest table map of their id as the log arrives, the stream started three times."""
    work = shared_dir(spark, "names")
    log = names.one_log(row_headers(spark, sf_dir), table_maps(spark, sf_dir))

    def run() -> None:
        names.resolve_names(stream_changes(spark, f"{work}/in", schema=log.schema), f"{work}/out", f"{work}/checkpoint").awaitTermination()

    _in_parts(log, file_number(F.col("binlog_file")) * 1_000_000 + F.col("binlog_pos"), f"{work}/in", run)
    columns = ["event_id", "table_id", "db_table"]
    return names.named_rows(spark, f"{work}/out").select(*columns).union(names.waiting(spark, f"{work}/out").select(*columns))


@query(
    """WITH levels AS (SELECT user_id % 3 AS queue, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL),
states AS (SELECT *, n > 6.4 AS over, coalesce(lag(n > 6.4) OVER (PARTITION BY queue ORDER BY hour), false) AS was FROM levels)
SELECT queue, hour, n, CASE WHEN over THEN 'alert' ELSE 'recovered' END AS state FROM states WHERE over OR was"""
)
def stream_backlog_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of each queue's backlog as its samples arrive, the stream started three times."""
    work = shared_dir(spark, "backlog")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    levels = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 3).alias("queue"), hour).agg(F.count("*").alias("n"))
    manifest = Manifest(spark, f"{work}/out")

    def run() -> None:
        samples = stream_changes(spark, f"{work}/in", schema=levels.schema)
        states = backlog.backlog_states(samples, "queue", "hour", "n", capacity=8)
        committed(states, manifest, lambda batch, _: {"append": {"rows": batch}}, f"{work}/checkpoint").awaitTermination()

    _in_parts(levels, F.unix_seconds(F.col("hour").cast("timestamp")), f"{work}/in", run)
    return manifest.read("rows")


@query(
    """SELECT 'has_text' AS rule, count(*) FILTER (WHERE length(text) > 0) AS passed,
       count(*) FILTER (WHERE (length(text) > 0) IS NOT TRUE) AS failed FROM documents
UNION ALL SELECT 'long', count(*) FILTER (WHERE n_chars >= 500), count(*) FILTER (WHERE (n_chars >= 500) IS NOT TRUE) FROM documents"""
)
def stream_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules counted while a stream's rows are written, the stream started three times."""
    work = shared_dir(spark, "quality")
    docs = table(spark, sf_dir, "documents")
    rules = {"has_text": F.length("text") > 0, "long": F.col("n_chars") >= 500}

    def run() -> None:
        jobs.check_quality(stream_changes(spark, f"{work}/in", schema=docs.schema), rules, f"{work}/out", f"{work}/checkpoint").awaitTermination()

    _in_parts(docs, F.col("doc_id"), f"{work}/in", run)
    return jobs.quality_counts(spark, f"{work}/out")


SCAN_ROWS = 5_000


@query(
    f"""WITH o AS (SELECT *, CASE WHEN o_custkey % 3 <> 1 THEN o_orderdate END AS updated FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(epoch_us(updated) // 1000 AS VARCHAR) AS updated, o_orderstatus,
       (row_number() OVER (ORDER BY updated NULLS FIRST, o_orderkey) - 1) // {SCAN_ROWS} AS page FROM o"""
)
def scan_job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table scan as a job: all orders, page after page by update time and key."""
    path = shared_dir(spark, "scan")
    updated = F.when(F.col("o_custkey") % 3 != 1, F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders").withColumn("updated", updated)
    options = CaptureOptions("app", ["orders"], ["o_orderkey", "updated", "o_orderstatus"], ["o_orderkey"], "updated", page_size=SCAN_ROWS)
    scan_job(lambda: orders, options, path)
    return scanned(spark, path)
