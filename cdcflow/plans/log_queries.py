"""Queries over the change log."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.config import CaptureOptions, table_names
from cdcflow.functions.values import file_number, parse_time, stringify, table_key, table_of_key, truncate_second
from cdcflow.operators import changelog as C
from cdcflow.operators import progress as P
from cdcflow.plans.capture import capture
from cdcflow.plans.derived import (
    EVENTS_PER_NAME,
    LOG_BEFORE_SQL,
    LOG_SQL,
    SOURCE_UUID,
    change_log,
    row_events,
    row_headers,
    table_maps,
)
from cdcflow.plans.registry import query, table
from cdcflow.schema import COLUMN_CATALOG
from cdcflow.sources.changes import parse_records, unreadable_records

ZONE = "Asia/Shanghai"
ZONE_OFFSET_MS = 28_800_000
START_MS = 1_705_276_800_000
TEXT_SQL = """CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(amount AS VARCHAR) AS amount, payload,
  CAST(epoch_us(updated) // 1000 AS VARCHAR) AS updated"""


@query(
    f"""WITH {LOG_SQL}
SELECT binlog_file, binlog_pos, {TEXT_SQL}, CAST(NULL AS VARCHAR) AS absent
FROM log WHERE op <> 'delete' AND db_table IN ('app.user_0', 'app.user_2')"""
)
def emit_after_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = C.only_changes(C.only_tables(change_log(spark, sf_dir), ["app.user_0", "app.user_2"]))
    columns = ["user_id", "event_type", "amount", "payload", "updated", "absent"]
    return C.emit(log, columns, keep=["binlog_file", "binlog_pos"], missing="null")


@query(
    f"""WITH {LOG_SQL}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(epoch_us(updated) // 1000 - {ZONE_OFFSET_MS} AS VARCHAR) AS updated
FROM log
WHERE op <> 'delete' AND db_table IN ('app.user_0', 'app.user_1') AND event_ts_ms >= {START_MS}
  AND (file_no > 3 OR (file_no = 3 AND binlog_pos >= 10004)) AND event_id + 1 NOT BETWEEN 1 AND 900"""
)
def capture_from_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = CaptureOptions.from_properties(
        {
            "jdbcUrl": "jdbc:mysql://db.example:3306/app?useSSL=false",
            "tableName": "user_0,app.user_1",
            "outputColumns": "user_id,event_type,updated",
            "primaryKeyColumns": "user_id",
            "updateTimeColumn": "updated",
            "timezoneZero": "true",
            "binlogFileName": "mysql-bin.000003",
            "binlogPosition": "10004",
            "binlogTimestamp": str(START_MS),
            "gtid": f"{SOURCE_UUID}:1-900",
        }
    )
    return capture(change_log(spark, sf_dir), options, zone=ZONE)


@query(f"WITH {LOG_SQL} SELECT event_id, db_table FROM log WHERE db_table IN ('app.user_0', 'app.user_2')")
def table_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [f"app.{t}" for t in table_names("app.user_0, user_2")]
    return C.only_tables(change_log(spark, sf_dir), wanted).select("event_id", "db_table")


@query(
    f"""WITH {LOG_SQL} SELECT event_id, binlog_file, binlog_pos FROM log
WHERE file_no > 2 OR (file_no = 2 AND binlog_pos >= 5004)"""
)
def resume_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir).drop("file_no")
    return C.from_position(log, "mysql-bin.000002", 5004).select("event_id", "binlog_file", "binlog_pos")


@query(f"WITH {LOG_SQL} SELECT event_id, event_ts_ms FROM log WHERE event_ts_ms >= {START_MS}")
def resume_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.from_timestamp(change_log(spark, sf_dir), START_MS).select("event_id", "event_ts_ms")


@query(
    f"""WITH {LOG_SQL} SELECT event_id, gtid FROM log
WHERE NOT (event_id + 1 BETWEEN 1 AND 500 OR event_id + 1 BETWEEN 700 AND 800 OR event_id + 1 = 900)"""
)
def resume_from_txn_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    gtid_set = f"{SOURCE_UUID}:1-500:700-800, {SOURCE_UUID}:900, 00000000-0000-0000-0000-000000000000:1-999999999"
    return C.outside_txn_set(change_log(spark, sf_dir), gtid_set).select("event_id", "gtid")


@query(
    f"""WITH {LOG_SQL}, maps AS (
  SELECT user_id % 3 + 100 AS table_id, event_id // {EVENTS_PER_NAME} AS period, min(event_id) AS first_event
  FROM log GROUP BY ALL)
SELECT l.event_id, l.user_id % 3 + 100 AS table_id,
       'app.user_' || CAST(l.user_id % 3 AS VARCHAR) || '_v' || CAST(m.period AS VARCHAR) AS db_table
FROM log l ASOF JOIN maps m ON l.user_id % 3 + 100 = m.table_id AND l.event_id >= m.first_event"""
)
def resolve_table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.resolve_table_ids(row_headers(spark, sf_dir), table_maps(spark, sf_dir)).select("event_id", "table_id", "db_table")


def _catalog(spark: SparkSession) -> DataFrame:
    """Column order differs between tables; ``user_9`` occurs in no event."""
    names = {t: ["user_id", "event_type", "payload"] for t in ("user_0", "user_1", "user_9")}
    names["user_2"] = ["id", "kind", "body"]
    rows = [("app", t, c, i, "string") for t, columns in names.items() for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, COLUMN_CATALOG)


@query(
    f"""WITH {LOG_BEFORE_SQL}, good AS (SELECT * FROM pairs WHERE NOT (op = 'insert' AND user_id % 7 = 0)),
cells AS (
  SELECT event_id, db_table, 'after' AS side, 1 AS n, CAST(user_id AS VARCHAR) AS v FROM good WHERE op <> 'delete'
  UNION ALL SELECT event_id, db_table, 'after', 2, event_type FROM good WHERE op <> 'delete'
  UNION ALL SELECT event_id, db_table, 'after', 3, payload FROM good WHERE op <> 'delete'
  UNION ALL SELECT event_id, db_table, 'before', 1, CAST(CASE op WHEN 'delete' THEN user_id ELSE b_user_id END AS VARCHAR)
    FROM good WHERE op <> 'insert'
  UNION ALL SELECT event_id, db_table, 'before', 2, CASE op WHEN 'delete' THEN event_type ELSE b_event_type END
    FROM good WHERE op <> 'insert'
  UNION ALL SELECT event_id, db_table, 'before', 3, CASE op WHEN 'delete' THEN payload ELSE b_payload END
    FROM good WHERE op <> 'insert')
SELECT event_id, side,
       CASE WHEN db_table = 'app.user_2' THEN CASE n WHEN 1 THEN 'id' WHEN 2 THEN 'kind' ELSE 'body' END
            ELSE CASE n WHEN 1 THEN 'user_id' WHEN 2 THEN 'event_type' ELSE 'payload' END END AS column_name,
       v AS value
FROM cells"""
)
def row_to_named_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = C.named_images(row_events(spark, sf_dir), _catalog(spark))
    sides = F.create_map(F.lit("before"), F.col("before"), F.lit("after"), F.col("after"))
    return good.select("event_id", F.explode(sides).alias("side", "image")).select(
        "event_id", "side", F.explode("image").alias("column_name", "value")
    )


@query(
    f"""WITH {LOG_SQL} SELECT event_id, db_table, op, CAST(2 AS INTEGER) AS cells
FROM log WHERE op = 'insert' AND user_id % 7 = 0"""
)
def arity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = C.named_images(row_events(spark, sf_dir), _catalog(spark))
    return rejects.select("event_id", "db_table", "op", F.size("after_cells").alias("cells"))


@query(
    f"""WITH {LOG_BEFORE_SQL}
SELECT event_id, op, CASE WHEN op = 'delete' THEN b_user_id ELSE user_id END AS user_id,
       CASE WHEN op = 'delete' THEN b_event_type ELSE event_type END AS event_type
FROM pairs"""
)
def effective_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir, before=True).withColumn("image", C.effective_image())
    return log.select("event_id", "op", "image.user_id", "image.event_type")


@query(
    f"""WITH {LOG_SQL}
SELECT event_id, CASE op WHEN 'insert' THEN 1 WHEN 'update' THEN 2 ELSE 3 END AS op_code FROM log"""
)
def op_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).select("event_id", C.op_code().alias("op_code"))


@query(
    f"""WITH {LOG_SQL}
SELECT event_id, 'app.' || event_type AS table_key, 'user_' || CAST(user_id % 3 AS VARCHAR) AS table_name, '' AS no_table,
       file_no FROM log"""
)
def table_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).select(
        "event_id",
        table_key(F.lit("app"), F.col("after.event_type")).alias("table_key"),
        table_of_key(F.col("db_table")).alias("table_name"),
        table_of_key(F.col("db_table"), "-").alias("no_table"),
        file_number(F.col("binlog_file")).alias("file_no"),
    )


@query("SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def truncate_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", truncate_second(F.col("ts")).cast("timestamp_ntz").alias("ts"))


@query(
    f"""WITH {LOG_SQL}
SELECT event_id, CAST(epoch_us(updated) // 1000 - {ZONE_OFFSET_MS} AS VARCHAR) AS updated FROM log"""
)
def zone_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.emit(change_log(spark, sf_dir), ["updated"], keep=["event_id"], shift_zone=ZONE)


@query(
    """SELECT event_id,
       CASE WHEN event_type = 'click' THEN date_trunc('second', ts) ELSE date_trunc('millisecond', ts) END AS ts
FROM events"""
)
def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", parse_time(text).cast("timestamp_ntz").alias("ts"))


@query(
    f"""WITH {LOG_SQL}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY db_table ORDER BY file_no DESC, binlog_pos DESC) AS rn
  FROM log WHERE op <> 'delete')
SELECT db_table, CASE WHEN updated IS NOT NULL THEN CAST(user_id AS VARCHAR) END AS key,
       CAST(epoch_us(updated) // 1000 AS VARCHAR) AS update_time,
       CASE WHEN updated IS NULL THEN CAST(user_id AS VARCHAR) END AS key_without_time,
       binlog_file, binlog_pos, event_ts_ms, gtid
FROM newest WHERE rn = 1"""
)
def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = P.latest_offsets(C.only_changes(change_log(spark, sf_dir)), ["user_id"], "updated")
    info = lambda key: F.try_element_at("info", F.lit(key))
    return offsets.select(
        "db_table",
        info("user_id").alias("key"),
        info("updated").alias("update_time"),
        info("user_idNonTime").alias("key_without_time"),
        "binlog_file",
        "binlog_pos",
        "event_ts_ms",
        "gtid",
    )


@query(f"WITH {LOG_SQL} SELECT min(event_ts_ms) AS first_event_ts_ms FROM log")
def first_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.first_event_time(table_maps(spark, sf_dir))


@query(
    """WITH levels AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1),
states AS (SELECT hour, n, n > 16 AS over, coalesce(lag(n > 16) OVER (ORDER BY hour), false) AS was FROM levels)
SELECT hour, n, CASE WHEN over THEN 'alert' ELSE 'recovered' END AS state FROM states WHERE over OR was"""
)
def backlog_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    levels = table(spark, sf_dir, "events").groupBy(hour).agg(F.count("*").alias("n"))
    return P.backlog_alerts(levels, "hour", "n", capacity=20)


@query(
    f"""WITH {LOG_SQL}, handlers AS (SELECT * FROM (VALUES ('app.user_0', 'audit'), ('app.user_0', 'search'),
  ('app.user_2', 'audit')) AS t(db_table, handler))
SELECT event_id, db_table, handler FROM log JOIN handlers USING (db_table)"""
)
def handler_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    handlers = spark.createDataFrame(
        [("app.user_0", "audit"), ("app.user_0", "search"), ("app.user_2", "audit")], "db_table string, handler string"
    )
    return P.fan_out(change_log(spark, sf_dir), handlers).select("event_id", "db_table", "handler")


@query(f"WITH {LOG_SQL} SELECT event_id, binlog_file, binlog_pos, event_ts_ms, gtid FROM log")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).select("event_id", "binlog_file", "binlog_pos", "event_ts_ms", "gtid")


@query()
def emit_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.emit(C.only_changes(change_log(spark, sf_dir)), ["user_id", "event_type", "amount"])
    return C.with_envelope(rows, route="main")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts,
       CAST(user_id AS VARCHAR) AS user_id, event_type, props FROM events"""
)
def table_scan_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringify(table(spark, sf_dir, "events"), ["event_id", "ts", "user_id", "event_type", "props"])


@query(
    f"""WITH {LOG_SQL}
SELECT event_id, event_type, CAST(epoch_us(updated) // 1000 - {ZONE_OFFSET_MS} AS VARCHAR) AS updated
FROM log WHERE op <> 'delete' AND db_table IN ('app.user_0', 'app.user_1')"""
)
def zone_shift_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift in map images, whose times are epoch milliseconds as text."""
    log = change_log(spark, sf_dir)
    names = ["event_type", "updated"]
    pairs = zip(names, C.emit_columns(log, names))
    texts = F.create_map(*[c for name, text in pairs for c in (F.lit(name), text)])
    options = CaptureOptions(
        "app", ["user_0", "user_1"], names, shift_to_local=True, zone=ZONE, zoned_columns=["updated"]
    )
    return capture(log.withColumn("after", texts), options, keep=["event_id"])


@query(
    f"""WITH {LOG_SQL}, maps AS (
  SELECT user_id % 3 AS n, min(event_id) AS first_event FROM log WHERE event_id >= {EVENTS_PER_NAME} GROUP BY ALL)
SELECT event_id, op, gtid FROM log LEFT JOIN maps ON user_id % 3 = n WHERE coalesce(event_id < first_event, true)"""
)
def unresolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events ahead of the first table map of their id, as when a log is read from its middle."""
    late_maps = table_maps(spark, sf_dir).where(~F.col("db_table").endswith("_v0"))
    resolved = C.resolve_table_ids(row_headers(spark, sf_dir), late_maps)
    cells = {side: F.array().cast("array<string>") for side in ("before_cells", "after_cells")}
    _, rejects = C.named_images(resolved.withColumns(cells), _catalog(spark))
    return rejects.select("event_id", "op", "gtid")


@query(f"WITH {LOG_SQL} SELECT event_id, op = 'delete' AS unreadable FROM log")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events sent as JSON, some of them cut off on the way; none gets lost."""
    log = change_log(spark, sf_dir)
    body = F.to_json(F.struct("db_table", "op", "binlog_file", "binlog_pos", "row_seq", "event_ts_ms", "gtid"))
    cut = F.when(F.col("op") == "delete", F.substring(body, 1, 40)).otherwise(body)
    sent = log.select("event_id", F.encode(cut, "UTF-8").alias("value"))
    read = parse_records(sent).select((F.substring_index("gtid", ":", -1).cast("bigint") - 1).alias("event_id"), F.lit(False).alias("unreadable"))
    return read.unionByName(unreadable_records(sent).select("event_id", F.lit(True).alias("unreadable")))


@query(
    f"""WITH {LOG_SQL}
SELECT count(*) AS n, count(*) AS ids, true AS in_time, 'main' AS route FROM log WHERE op <> 'delete'"""
)
def envelope_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope of all emitted rows: an id of its own for each, and an emit time of now."""
    started = int(time.time() * 1000)
    rows = emit_envelope(spark, sf_dir)
    return rows.agg(
        F.count("*").alias("n"),
        F.count_distinct("_uuid").alias("ids"),
        F.min(F.col("_emit_time").between(started, F.unix_millis(F.current_timestamp()))).alias("in_time"),
        F.min("_route_path").alias("route"),
    )
