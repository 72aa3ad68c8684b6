"""Queries over table snapshots: pages, hand-over, typed writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow import sinks
from cdcflow.operators import paging
from cdcflow.operators import progress as P
from cdcflow.operators.joins import equi_join
from cdcflow.operators.zones import lay_out, zoned_keyset_page, zoned_offset_page
from cdcflow.plans.capture import scan, scan_offsets, snapshot_then_log
from cdcflow.config import CaptureOptions
from cdcflow.plans.derived import LOG_SQL, change_log
from cdcflow.plans.registry import query, table
from cdcflow.session import shared_dir
from cdcflow.sources import tables as S

KEYS = ["o_orderkey"]
TIME = "o_updated"
PAGE = 300
SAVED = {"o_orderkey": "700", "o_updated": "1996-03-01 00:00:00", "o_orderkeyNonTime": "1400"}
HAND_OVER_MS = 1_705_276_800_000
ORDERS_SQL = """o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS o_updated FROM orders)"""
LATEST_SQL = f"""{LOG_SQL}, snap AS (
  SELECT user_id, event_type, CASE WHEN user_id % 3 <> 1 THEN ts END AS updated FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an update time that every seventh lacks."""
    updated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", updated.alias(TIME))


@query(f"WITH {ORDERS_SQL} SELECT * FROM o ORDER BY o_updated ASC NULLS FIRST, o_orderkey LIMIT {PAGE}")
def first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.keyset_page(_orders(spark, sf_dir), TIME, KEYS, page_size=PAGE)


@query(
    f"""WITH {ORDERS_SQL}
SELECT * FROM (
  SELECT * FROM o WHERE o_updated = TIMESTAMP '1996-03-01' AND o_orderkey > 700
  UNION ALL SELECT * FROM o WHERE o_updated > TIMESTAMP '1996-03-01'
  UNION ALL SELECT * FROM o WHERE o_updated IS NULL AND o_orderkey > 1400)
ORDER BY o_updated ASC NULLS FIRST, o_orderkey LIMIT {PAGE * 10}"""
)
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.keyset_page(_orders(spark, sf_dir), TIME, KEYS, SAVED, PAGE * 10)


@query(
    f"""WITH {ORDERS_SQL}
SELECT * FROM (
  SELECT * FROM o WHERE o_updated IS NOT NULL
  UNION ALL SELECT * FROM o WHERE o_updated IS NULL AND o_orderkey > 14000)
ORDER BY o_updated ASC NULLS FIRST, o_orderkey LIMIT {PAGE * 2}"""
)
def keyset_page_null_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.keyset_page(_orders(spark, sf_dir), TIME, KEYS, {"o_orderkeyNonTime": "14000"}, PAGE * 2)


@query(
    f"""WITH {ORDERS_SQL}
SELECT * FROM o WHERE (o_updated = TIMESTAMP '1996-03-01' AND o_orderkey > 700)
  OR o_updated > TIMESTAMP '1996-03-01' OR (o_updated IS NULL AND o_orderkey > 1400)"""
)
def rows_after_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the next pages will hold together."""
    orders = _orders(spark, sf_dir)
    return orders.where(paging.rows_after(orders, TIME, KEYS, SAVED))


@query(
    f"""WITH {ORDERS_SQL},
fresh AS (SELECT * FROM o WHERE (o_updated = TIMESTAMP '1996-03-01' AND o_orderkey > 700)
  OR o_updated > TIMESTAMP '1996-03-01' OR (o_updated IS NULL AND o_orderkey > 1400)),
last_timed AS (SELECT * FROM fresh WHERE o_updated IS NOT NULL ORDER BY o_updated DESC, o_orderkey DESC LIMIT 1)
SELECT (SELECT count(*) FROM fresh) AS n, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(epoch_us(o_updated) // 1000 AS VARCHAR) AS o_updated,
       CAST(coalesce((SELECT max(o_orderkey) FROM fresh WHERE o_updated IS NULL), 1400) AS VARCHAR) AS "o_orderkeyNonTime"
FROM last_timed"""
)
def progress_after_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a scan finds after saved progress, and the progress it leaves."""
    rows, progress = paging.new_rows(_orders(spark, sf_dir), TIME, KEYS, SAVED)
    return rows.agg(F.count("*").alias("n")).select("n", *[F.lit(v).alias(k) for k, v in progress.items()])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 1300")
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return paging.offset_page(orders, "o_orderkey", offset=1300, page_size=100, rows_per_chunk=1_000)


def _laid_out(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "zones")
    lay_out(_orders(spark, sf_dir), path, [TIME, *KEYS], rows_per_zone=400)
    return path


@query(
    f"""WITH {ORDERS_SQL}
SELECT * FROM (
  SELECT * FROM o WHERE o_updated = TIMESTAMP '1996-03-01' AND o_orderkey > 700
  UNION ALL SELECT * FROM o WHERE o_updated > TIMESTAMP '1996-03-01'
  UNION ALL SELECT * FROM o WHERE o_updated IS NULL AND o_orderkey > 1400)
ORDER BY o_updated ASC NULLS FIRST, o_orderkey LIMIT {PAGE}"""
)
def zoned_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page after saved progress, from the few zones that hold it."""
    return zoned_keyset_page(spark, _laid_out(spark, sf_dir), TIME, KEYS, SAVED, PAGE)


@query(f"WITH {ORDERS_SQL} SELECT * FROM o ORDER BY o_updated ASC NULLS FIRST, o_orderkey LIMIT 100 OFFSET 1300")
def zoned_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page after an offset, from the few zones that hold it."""
    return zoned_offset_page(spark, _laid_out(spark, sf_dir), [TIME, *KEYS], 1300, 100)


SCAN = CaptureOptions("shop", ["orders"], ["o_orderkey", "o_custkey", TIME], ["O_ORDERKEY"], "O_UPDATED")


@query(
    f"""WITH {ORDERS_SQL}
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(epoch_us(o_updated) // 1000 AS VARCHAR) AS o_updated
FROM o WHERE (o_updated = TIMESTAMP '1996-03-01' AND o_orderkey > 700)
  OR o_updated > TIMESTAMP '1996-03-01' OR (o_updated IS NULL AND o_orderkey > 1400)"""
)
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan job after progress that an earlier scan saved with the offsets."""
    kept = scan_offsets(spark, "shop.orders", SAVED)
    return scan(_orders(spark, sf_dir), SCAN, P.saved_progress(kept, "shop.orders"))[0]


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, '1400' AS next_offset
FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 1300)"""
)
def offset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan job without key and time, a page after the row offset that the offsets hold."""
    options = CaptureOptions.from_properties(
        {"jdbcUrl": "jdbc:mysql://db/shop", "tableName": "orders", "primaryKeyColumns": "o_orderkey",
         "outputColumns": "o_orderkey,o_custkey", "incrNeeded": "false", "limit": "100"}
    )
    kept = scan_offsets(spark, "shop.orders", {"rowOffset": "1300"})
    rows, after = scan(table(spark, sf_dir, "orders"), options, P.saved_progress(kept, "shop.orders"))
    return rows.withColumn("next_offset", F.lit(after["rowOffset"]))


@query(
    f"""WITH {LATEST_SQL}, place AS (
  SELECT * FROM log WHERE db_table = 'app.user_0' AND event_ts_ms < {HAND_OVER_MS} ORDER BY file_no DESC, binlog_pos DESC LIMIT 1)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(epoch_us(updated) // 1000 AS VARCHAR) AS updated
FROM (SELECT s.*, a.updated AS a_updated, a.user_id AS a_user_id FROM snap s, place a)
WHERE updated IS NULL OR updated > a_updated OR (updated = a_updated AND user_id > a_user_id)"""
)
def scan_resumed_from_log_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a snapshot after the place that the log has saved for a table."""
    log = change_log(spark, sf_dir)
    early = log.where((F.col("db_table") == "app.user_0") & (F.col("event_ts_ms") < HAND_OVER_MS))
    saved = P.saved_progress(P.latest_offsets(early, ["user_id"], "updated"), "app.user_0")
    options = CaptureOptions("app", ["user_0"], ["user_id", "event_type", "updated"], ["user_id"], "updated")
    return scan(_newest_rows(log), options, saved)[0]


def _newest_rows(log: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("user_id", "event_type", "updated"), "event_id").alias("r")
    return log.select("event_id", "after.*").groupBy("user_id").agg(newest).select("r.*")


@query("SELECT 'orders_' || CAST(o_orderkey % 4 AS VARCHAR) AS _table, o_orderkey, o_custkey FROM orders")
def sharded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    for n in range(4):
        orders.where(F.col("o_orderkey") % 4 == n).createOrReplaceTempView(f"orders_{n}")
    return S.sharded_scan(spark, r"select o_orderkey, o_custkey from ${orders_\d+}")


@query(
    """SELECT 'shop' AS table_schema, 'orders' AS table_name, column_name, CAST(ordinal AS INTEGER) AS ordinal, data_type,
  filled FROM (
  VALUES ('o_orderkey', 0, 'bigint', (SELECT count(o_orderkey) FROM orders)),
         ('o_custkey', 1, 'bigint', (SELECT count(o_custkey) FROM orders)),
         ('o_orderstatus', 2, 'string', (SELECT count(o_orderstatus) FROM orders)),
         ('o_totalprice', 3, 'double', (SELECT count(o_totalprice) FROM orders)),
         ('o_orderdate', 4, 'timestamp_ntz', (SELECT count(o_orderdate) FROM orders)),
         ('o_orderpriority', 5, 'string', (SELECT count(o_orderpriority) FROM orders))
) AS t(column_name, ordinal, data_type, filled)"""
)
def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of a table, with how many values each column holds."""
    orders = table(spark, sf_dir, "orders")
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "column_name", "filled")
    return S.column_catalog(orders, "shop", "orders").join(filled, "column_name")


@query(
    f"""WITH {LATEST_SQL}
SELECT user_id, event_type, updated FROM snap WHERE updated IS NULL OR epoch_us(updated) // 1000 <= {HAND_OVER_MS}
UNION ALL
SELECT user_id, event_type, updated FROM log
WHERE event_ts_ms >= {HAND_OVER_MS} AND op <> 'delete'"""
)
def snapshot_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's newest row, then the log from the hand-over on."""
    log = change_log(spark, sf_dir)
    rows = _newest_rows(log)
    options = CaptureOptions(
        database="app", tables=["user_0", "user_1", "user_2"], output_columns=rows.columns, update_time="updated"
    )
    both = snapshot_then_log(rows, log, options, HAND_OVER_MS)
    return both.withColumn("updated", F.col("updated").cast("timestamp_ntz"))


@query(
    f"""WITH {ORDERS_SQL}
SELECT o_orderkey, o_updated, 'snapshot' AS origin FROM o WHERE o_updated IS NULL OR epoch_us(o_updated) // 1000 <= 852076800000
UNION ALL SELECT o_orderkey, o_updated, 'log' FROM o WHERE epoch_us(o_updated) // 1000 >= 852076800000"""
)
def hand_over_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows up to the hand-over from the table and later ones from the log; those of the very time come from both."""
    orders = _orders(spark, sf_dir).drop("o_custkey")
    log = orders.withColumns({"origin": F.lit("log"), "event_ts_ms": F.unix_millis(F.col(TIME).cast("timestamp"))})
    return P.hand_over(orders.withColumn("origin", F.lit("snapshot")), log, TIME, 852_076_800_000)


@query(
    """WITH bounds AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)
SELECT value FROM (SELECT unnest(range(lo, hi + 1)) AS value FROM bounds)
WHERE value NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the order sequence without a line."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("value"))
    low, high = lines.agg(F.min("value"), F.max("value")).first()
    return equi_join(S.sequence(spark, low, high), lines, ["value"], "left_anti")


@query(
    """SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '"'
  || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END || '}' AS json
FROM customer"""
)
def rows_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    return sinks.json_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name", segment))


@query(
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '0000000000000000000000.123456789012345678901234567890' AS price
FROM orders"""
)
def typed_wide_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals wider than Spark's, with 30 places, keep every digit."""
    wide = F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 22 + ".123456789012345678901234567890"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", wide.alias("price"))
    return orders.select(*sinks.typed_columns(orders, [-5, 3]))


@query(
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders"""
)
def typed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows cast to their SQL type codes, written as a table and read again."""
    orders = table(spark, sf_dir, "orders").drop("o_orderstatus")
    path = shared_dir(spark, "typed")
    orders.select(*sinks.typed_columns(orders, [4, 12, 8, 91, 0])).write.parquet(path)
    return spark.read.parquet(path)
