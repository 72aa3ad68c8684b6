"""Table scans: JDBC, catalog tables, sharded tables, sequences."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.config import CaptureOptions
from cdcflow.schema import resolve_columns

_TABLE_TOKEN = re.compile(r"\$\{(.*?)\}")


# Bytes of files, as Spark estimates a scan, for a task of costly work per row.
SPREAD_BYTES = 1 << 20


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer tasks than the cluster has cores, or than its bytes call for; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    tasks = max(cores, -(-size // SPREAD_BYTES))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def jdbc_options(options: CaptureOptions, table: str | None = None, query: str | None = None) -> dict[str, str]:
    """Reader options for a table or a query. The driver class follows from the URL."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    return {**options.jdbc, **({"dbtable": table} if table else {"query": query}), "fetchsize": "1000"}


def read_jdbc(
    spark: SparkSession,
    options: CaptureOptions,
    table: str | None = None,
    query: str | None = None,
    split_on: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Read over JDBC. ``split_on`` is (column, lower, upper, partitions) for a parallel read."""
    reader = spark.read.format("jdbc").options(**jdbc_options(options, table, query))
    if split_on:
        column, lower, upper, parts = split_on
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def key_columns(df: DataFrame, options: CaptureOptions) -> tuple[list[str], str]:
    """Actual names of the key and update-time columns of a table."""
    if not options.primary_key or not options.update_time:
        raise ValueError("primaryKeyColumns and updateTimeColumn are needed")
    *keys, time = resolve_columns(df.columns, [*options.primary_key, options.update_time])
    return keys, time


def matching_tables(spark: SparkSession, pattern: str, database: str | None = None) -> list[str]:
    """Catalog tables whose whole name matches a regular expression."""
    names = {t.name for t in spark.catalog.listTables(database)}
    return sorted(n for n in names if re.fullmatch(pattern, n))


def sharded_scan(spark: SparkSession, template: str, tables: list[str] | None = None) -> DataFrame:
    """Run a template SELECT once per table and union the results, with the table's name.

    ``${pattern}`` in the template stands for the table. Without a list, the tables are those
    whose name matches the pattern.
    """
    token = _TABLE_TOKEN.search(template)
    if not token:
        raise ValueError("no ${..} in the template")
    names = tables if tables is not None else matching_tables(spark, token[1])
    if not names:
        raise ValueError(f"no table matches {token[1]!r}")
    parts = [spark.sql(template.replace(token[0], n)).withColumn("_table", F.lit(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


def column_catalog(df: DataFrame, database: str, table: str) -> DataFrame:
    """The column catalog of a frame: one row per column, ordinals from 0."""
    rows = [(database, table, f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    names = "table_schema string, table_name string, column_name string, ordinal int, data_type string"
    return df.sparkSession.createDataFrame(rows, names)


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Whole numbers from first to last, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", "value")
