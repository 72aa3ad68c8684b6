"""Queries for the dataflow nodes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow import sinks
from cdcflow.functions.conditions import derived
from cdcflow.operators import nodes as N
from cdcflow.plans.registry import query, table
from cdcflow.schema import node_outputs, project_declared, resolve_columns
from cdcflow.session import shared_dir

EXACT = "decimal(18,2)"
FILTER = {
    "logicType": "and",
    "conditions": [
        {"name": "price", "funcName": "gt", "funcType": "DEFAULT", "funcArgs": [{"type": "double", "value": "200000"}]},
        {"name": "o_orderstatus", "funcName": "in", "funcArgs": [{"value": "F"}, {"value": "O"}]},
    ],
}
PRICED_SQL = """p AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price
  FROM orders)"""


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a price that urgent ones lack."""
    price = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", price.alias("price"))


@query(f"WITH {PRICED_SQL} SELECT * FROM p WHERE price > 200000 AND o_orderstatus IN ('F', 'O')")
def filter_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.route_filter(_priced(spark, sf_dir), FILTER, [{"type": "true", "uuid": "big"}])["big"]


@query(f"WITH {PRICED_SQL} SELECT * FROM p WHERE (price > 200000 AND o_orderstatus IN ('F', 'O')) IS NOT TRUE")
def filter_false(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [{"type": "true", "uuid": "big"}, {"type": "false", "uuid": "rest"}]
    return N.route_filter(_priced(spark, sf_dir), FILTER, targets)["rest"]


@query(f"WITH {PRICED_SQL} SELECT * FROM p WHERE price < 5000 OR o_orderstatus = 'P'")
def filter_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.two_way_filter(_priced(spark, sf_dir), {"expr": "price < 5000 or o_orderstatus = 'P'"})[0]


@query(
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""
)
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda t, p, *more: table(spark, sf_dir, t).select(
        F.col(f"{p}key").alias("key"), F.col(f"{p[0]}_name").alias("name"), F.col(f"{p[0]}_acctbal").alias("balance"), *more
    )
    return N.merge(pick("customer", "c_cust", F.col("c_mktsegment").alias("segment")), pick("supplier", "s_supp"))


@query("SELECT event_id, user_id, value * 2 AS doubled FROM events WHERE event_type <> 'error'")
def process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = lambda df: df.where("event_type <> 'error'").select("event_id", "user_id", (F.col("value") * 2).alias("doubled"))
    return N.process(table(spark, sf_dir, "events"), keep)


@query("SELECT p_partkey, length(p_name) AS length FROM part")
def process_custom_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    def lengths(batches: Iterator) -> Iterator:
        for pdf in batches:
            yield pdf.assign(length=pdf["p_name"].str.len())[["p_partkey", "length"]]

    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return N.process_batches(parts, lengths, "p_partkey bigint, length bigint")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = _sides(spark, sf_dir)
    return N.equi_join(orders, customers, ["custkey"], "inner", salt=4).select("o_orderkey", "c_name", "c_mktsegment")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    return orders, table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")


@query("SELECT o_orderkey, o_custkey AS key, s_name FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the supplier of its customer's number, where there is one; frequent customers are spread."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key")
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "key")
    return N.equi_join(orders, suppliers, ["key"], "left", salt=4).select("o_orderkey", "key", "s_name")


@query("SELECT c_custkey AS custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = _sides(spark, sf_dir)
    return N.equi_join(customers, orders, ["custkey"], "left_semi").select("custkey", "c_name")


@query(
    """SELECT o_orderkey, o_custkey AS custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers outside one segment."""
    orders, customers = _sides(spark, sf_dir)
    builders = customers.where("c_mktsegment = 'BUILDING'")
    return N.equi_join(orders, builders, ["custkey"], "left_anti").select("o_orderkey", "custkey")


@query(
    "SELECT o_orderkey, p_partkey FROM orders FULL JOIN part ON o_custkey = p_partkey + 10"
)
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers shifted so that both sides have rows without a partner."""
    orders = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    parts = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey") + 10)
    return N.equi_join(orders, parts, ["k"], "full", salt=4).select("o_orderkey", "p_partkey")


@query("SELECT o_orderkey, p_partkey FROM orders RIGHT JOIN part ON o_custkey = p_partkey")
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part with the orders of the customer of its number, or alone; frequent customers are spread."""
    orders = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    parts = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey"))
    return N.equi_join(orders, parts, ["k"], "right", salt=4).select("o_orderkey", "p_partkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def dynamic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    keys = urgent.select(F.col("o_orderkey").alias("l_orderkey"))
    return N.dynamic_filter(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), keys, ["l_orderkey"])


@query("SELECT o_orderstatus, o_orderdate, o_orderkey FROM orders")
def sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    return N.sort(orders, ["o_orderstatus"], descending=["o_orderdate"])


@query(
    f"""WITH {PRICED_SQL} SELECT o_orderkey, price FROM p ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 50"""
)
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sort(_priced(spark, sf_dir).drop("o_orderstatus"), ["price"], descending=["price"]).limit(50)


@query(
    """SELECT count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price, max(l_shipdate) AS last_ship
FROM lineitem"""
)
def global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.aggregate(table(spark, sf_dir, "lineitem"), [], **_sums(), last_ship=F.max("l_shipdate"))


def _sums() -> dict:
    total = lambda c: F.sum(F.col(c).cast(EXACT)).cast("double")
    return {"n": F.count("*"), "quantity": total("l_quantity"), "price": total("l_extendedprice")}


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem GROUP BY ALL"""
)
def keyed_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.aggregate(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], **_sums())


@query("SELECT l_suppkey, count(*) AS n, max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL")
def parallel_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node with a task count of its own."""
    by_supplier = lambda df: N.aggregate(df, ["l_suppkey"], n=F.count("*"), last_ship=F.max("l_shipdate"))
    return N.process(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate"), by_supplier, parallelism=4)


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'alerts' WHEN value > 100 THEN 'large' ELSE 'rest' END AS _route_path
FROM events"""
)
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(F.col("event_type") == "error", "alerts"), (F.col("value") > 100, "large")]
    return N.route(table(spark, sf_dir, "events"), rules, "rest").select("event_id", "_route_path")


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'alerts' WHEN event_type = 'signup' THEN 'new' ELSE 'rest' END
  AS _route_path FROM events"""
)
def routed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows written into one folder per route and read again."""
    rules = [(F.col("event_type") == "error", "alerts"), (F.col("event_type") == "signup", "new")]
    path = shared_dir(spark, "routes")
    sinks.write_routes(N.route(table(spark, sf_dir, "events").select("event_id", "event_type"), rules, "rest"), path)
    return spark.read.parquet(path).select("event_id", "_route_path")


@query(
    """SELECT lang, 'has_text' AS rule, count(*) FILTER (WHERE length(text) > 0) AS passed,
       count(*) FILTER (WHERE (length(text) > 0) IS NOT TRUE) AS failed FROM documents GROUP BY lang
UNION ALL SELECT lang, 'long', count(*) FILTER (WHERE n_chars >= 500), count(*) FILTER (WHERE n_chars < 500)
FROM documents GROUP BY lang"""
)
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"has_text": F.length("text") > 0, "long": F.col("n_chars") >= 500}
    return N.data_quality(table(spark, sf_dir, "documents"), rules, ["lang"])


@query(
    f"""WITH {PRICED_SQL}
SELECT 'priced' AS rule, count(*) FILTER (WHERE price > 0) AS passed, count(*) FILTER (WHERE (price > 0) IS NOT TRUE) AS failed
FROM p"""
)
def data_quality_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.data_quality(_priced(spark, sf_dir), {"priced": F.col("price") > 0})


@query("SELECT o_totalprice, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey FROM orders")
def declared_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = [
        {"name": "o_orderkey", "type": "string"},
        {"name": "o_custkey", "type": "Integer"},
        {"name": "o_totalprice", "type": "double"},
        {"name": "o_orderstatus", "type": "string"},
    ]
    wanted = ["o_totalprice", "o_orderkey", "undeclared", "o_custkey"]
    return project_declared(table(spark, sf_dir, "orders"), wanted, declared)


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def outputable_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = node_outputs(
        [
            {"name": " O_ORDERKEY", "type": "long", "outputable": True},
            {"name": "o_custkey", "type": "long", "outputable": False},
            {"name": "O_OrderPriority ", "type": "string", "outputable": True},
        ]
    )
    orders = table(spark, sf_dir, "orders")
    return orders.select(*resolve_columns(orders.columns, outputs.names))


@query(
    """SELECT event_id, upper(event_type) AS kind, event_type || '-' || CAST(user_id AS VARCHAR) AS label,
       user_id % 5 AS remainder FROM events"""
)
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_id = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").withColumn("uid", text_id).select(
        derived("event_id"),
        derived("kind", "upper", [{"value": "$event_type"}]),
        derived("label", "concat_ws", [{"value": "-"}, "$event_type", "$uid"]),
        derived("remainder", "pmod", [{"value": "$user_id"}, {"type": "long", "value": "5"}]),
    )
