"""Queries over text and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions import json_flat as J
from cdcflow.functions.values import has_text
from cdcflow.operators import text as W
from cdcflow.operators.nodes import flat_map
from cdcflow.plans.registry import query, spread_table, table
from cdcflow.schema import parse_declared

WORD_COUNT_SQL = r"""SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""
NESTED_SQL = """WITH paths AS (
  SELECT event_id, 'id' AS path, CAST(event_id AS VARCHAR) AS value FROM events
  UNION ALL SELECT event_id, 'user.id', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'user.tags[0]', event_type FROM events
  UNION ALL SELECT event_id, 'user.tags[1]', '' FROM events
  UNION ALL SELECT event_id, 'user.tags[2].k', CAST(json_extract_string(props, '$.k') AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'user.raw', props FROM events
  UNION ALL SELECT event_id, 'none', '' FROM events
  UNION ALL SELECT event_id, 'grid[0][0]', CAST(user_id % 10 AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'grid[1][0]', CAST(event_id % 10 AS VARCHAR) FROM events
  UNION ALL SELECT event_id, 'grid[1][1].ok', 'true' FROM events)
"""


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested documents: null members, empty containers, arrays of arrays, JSON as text."""
    body = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"),
        F.lit(',"user":{"id":'), F.col("user_id").cast("string"),
        F.lit(',"tags":["'), F.col("event_type"), F.lit('",null,'), F.to_json(F.array("props")).substr(F.lit(2), F.length(F.to_json(F.array("props"))) - 2),
        F.lit(',{},[]],"raw":'), F.to_json(F.array("props")).substr(F.lit(2), F.length(F.to_json(F.array("props"))) - 2),
        F.lit('},"none":null,"empty":{},"list":[],"grid":[['), (F.col("user_id") % 10).cast("string"),
        F.lit("],["), (F.col("event_id") % 10).cast("string"), F.lit(',{"ok":true}]]}'),
    )
    return spread_table(spark, sf_dir, "events").select("event_id", body.alias("body"))


@query(WORD_COUNT_SQL)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_count(spread_table(spark, sf_dir, "documents"), "text")


@query(
    r"""WITH parts AS (SELECT doc_id, regexp_split_to_array(lower(text), '\W+') AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM parts)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS n
FROM tokens WHERE word <> ''"""
)
def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.running_word_count(table(spark, sf_dir, "documents"), "text", "doc_id")


@query(
    r"""SELECT conv_id, turn, word FROM (
  SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM conversations) WHERE word <> ''"""
)
def split_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_rows(table(spark, sf_dir, "conversations"), "text", ["conv_id", "turn"]).drop("pos")


@query(
    r"""SELECT page_id, CAST(unnest(range(len(parts))) AS INTEGER) AS pos, unnest(parts) AS part
FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)"""
)
def flat_map_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return flat_map(pages, F.split("url", "/"), "part", position="pos").select("page_id", "pos", "part")


@query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value FROM events")
def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.flatten_json(spread_table(spark, sf_dir, "events"), "props", ["event_id"])


@query(NESTED_SQL + "SELECT event_id, path, value FROM paths")
def flatten_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.flatten_json(_nested(spark, sf_dir), "body", ["event_id"])


@query(
    NESTED_SQL
    + """SELECT event_id, CAST(10 AS INTEGER) AS keys, max(value) FILTER (path = 'user.id') AS user_id,
       max(value) FILTER (path = 'user.tags[2].k') AS k, max(value) FILTER (path = 'none') AS none
FROM paths GROUP BY event_id"""
)
def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = _nested(spark, sf_dir).select("event_id", J.json_properties(F.col("body")).alias("p"))
    return props.select(
        "event_id",
        F.size("p").alias("keys"),
        F.col("p")["user.id"].alias("user_id"),
        F.col("p")["user.tags[2].k"].alias("k"),
        F.col("p")["none"].alias("none"),
    )


@query(
    f"""SELECT event_id, '{"a." * 14}x[0].k' AS path, props[7:length(props) - 1] AS value FROM events"""
)
def flatten_deep_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's properties, fifteen objects and an array further down."""
    head, tail = '{"a":' * 14 + '{"x":[', "]}" + "}" * 14
    deep = F.concat(F.lit(head), "props", F.lit(tail)).alias("body")
    return J.flatten_json(spread_table(spark, sf_dir, "events").select("event_id", deep), "body", ["event_id"])


@query("SELECT doc_id, '' AS path, text AS value FROM documents")
def scalar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose is no JSON: each text is the one value of its document."""
    return J.flatten_json(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(coalesce(text, ''), '\S') OR regexp_matches(coalesce(source, ''), '\S')")
def non_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(has_text(F.col("text"), F.col("source"))).select("doc_id")


@query(
    """SELECT event_id, CAST(user_id AS INTEGER) AS as_integer, event_id AS as_long, value AS as_double,
       event_type = 'click' AS as_boolean, date_trunc('millisecond', ts) AS as_date, props AS as_bytes,
       event_type AS as_string, CAST(NULL AS INTEGER) AS as_null FROM events"""
)
def cast_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    truth = F.when(F.col("event_type") == "click", "TRUE").when(F.col("event_type") == "view", "1").otherwise("no")
    epoch_ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_declared(text("user_id"), "integer").alias("as_integer"),
        parse_declared(text("event_id"), "long").alias("as_long"),
        parse_declared(text("value"), "double").alias("as_double"),
        parse_declared(truth, "boolean").alias("as_boolean"),
        parse_declared(epoch_ms, "date").cast("timestamp_ntz").alias("as_date"),
        F.decode(parse_declared(F.col("props"), "bytes"), "UTF-8").alias("as_bytes"),
        parse_declared(F.col("event_type"), "string").alias("as_string"),
        parse_declared(F.lit(None).cast("string"), "integer").alias("as_null"),
    )
