"""Writers: typed database and table writes, JSON rows, the landed change log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.values import utc_day

# JDBC type codes and the Spark type each one is written as.
SQL_TYPES = {
    -7: "boolean", 16: "boolean",
    -16: "string", -15: "string", -1: "string", 1: "string", 12: "string",
    -6: "tinyint", 5: "smallint", 4: "int", -5: "bigint",
    7: "float", 6: "double", 8: "double",
    2: "decimal(38,18)", 3: "decimal(38,18)",
    91: "date", 92: "string", 93: "timestamp",
    -4: "binary", -3: "binary", -2: "binary",
}
SQL_NULL = 0
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TIME_PATTERN = "HH:mm:ss"


def typed_columns(df: DataFrame, codes: list[int]) -> list[Column]:
    """Columns cast to their SQL type codes, in order.

    Code 0 writes null, an unknown code leaves the column as it is, and a value that does not fit
    raises. No digit of a decimal is cut: text of a number stays text, as databases have wider decimals than Spark. The number of codes must be the number of columns.
    """
    if len(codes) != len(df.columns):
        raise ValueError(f"{len(codes)} types for {len(df.columns)} columns")
    return [_typed(df, name, code).alias(name) for name, code in zip(df.columns, codes)]


def _typed(df: DataFrame, name: str, code: int) -> Column:
    value, source = F.col(name), df.schema[name].dataType
    if code == SQL_NULL:
        return F.lit(None).cast(source)
    if code not in SQL_TYPES:
        return value
    target = SQL_TYPES[code]
    if target.startswith("decimal"):
        if source.typeName() == "string":
            return _number_text(value)
        if source.typeName() in ("decimal", "double", "float"):
            return value
    if code == 92 and source.typeName().startswith("timestamp"):
        return F.date_format(value, TIME_PATTERN)
    return value.cast(target)


def _number_text(value: Column) -> Column:
    """Text of a number, which the database reads with all its digits; any other text raises."""
    text = F.trim(value)
    bad = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("string")
    return F.when(text.rlike(_NUMBER), text).when(text.isNotNull(), bad)


def write_typed(df: DataFrame, codes: list[int], url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append typed rows to a database table."""
    df.select(*typed_columns(df, codes)).write.jdbc(url, table, mode="append", properties=dict(properties))


def json_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as JSON text; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("json"))


def land_changes(log: DataFrame, path: str, mode: str = "append") -> None:
    """Write change events so that table and day filters prune folders.

    The rebalance hint lets Spark split a hot table over several files and join small ones.
    """
    day = utc_day(F.col("event_ts_ms"))
    (
        log.withColumn("event_date", day)
        .hint("rebalance", "db_table", "event_date")
        .write.mode(mode)
        .partitionBy("db_table", "event_date")
        .parquet(path)
    )


def write_routes(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write labelled rows into one folder per route."""
    df.write.mode(mode).partitionBy("_route_path").parquet(path)


def print_rows(df: DataFrame, n: int = 20) -> None:
    """Print rows of a batch frame."""
    df.show(n, truncate=False)
