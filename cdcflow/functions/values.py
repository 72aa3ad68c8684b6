"""Column functions for emitted values: text form, times, blanks, table keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two accepted time formats, tried in this order.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss")


def utf8_text(value: Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes the replacement character and never ends a job."""
    return F.make_valid_utf8(value.cast("string"))


def utc_day(ms: Column) -> Column:
    """The day of an epoch time in milliseconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int"))


def value_text(value: Column, data_type: T.DataType) -> Column:
    """Text form of an emitted value: bytes decoded, timestamps as epoch ms, the rest as is."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BinaryType):
        return utf8_text(value)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(value.cast("timestamp")).cast("string")
    return value.cast("string")


def stringify(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All (or the named) columns as text."""
    return df.select(*[value_text(F.col(c), df.schema[c].dataType).alias(c) for c in columns or df.columns])


def table_key(database: Column, table: Column) -> Column:
    """``db.table``; null when either part is."""
    return F.concat(database, F.lit("."), table)


def table_of_key(key: Column, separator: str = ".") -> Column:
    """Table part of a two-part key, empty text for anything else."""
    parts = F.split(key, rf"\Q{separator}\E")
    return F.when(F.size(parts) == 2, parts.getItem(1)).otherwise(F.lit(""))


def truncate_second(ts: Column) -> Column:
    """Drop the fraction of a second."""
    return F.date_trunc("second", ts)


def wall_clock_as_local(ts: Column, zone: str) -> Column:
    """Read a UTC wall clock as local time of ``zone``, i.e. subtract the zone's offset."""
    return F.to_utc_timestamp(ts, zone)


def shifted_ms(text: Column, zone: str) -> Column:
    """The same for epoch milliseconds as text; other text stays."""
    at = wall_clock_as_local(F.timestamp_millis(text.try_cast("bigint")), zone)
    return F.coalesce(F.unix_millis(at).cast("string"), text)


def parse_time(text: Column) -> Column:
    """Time text with milliseconds, else without; other text raises."""
    with_ms, plain = TIME_FORMATS
    return F.coalesce(F.try_to_timestamp(text, F.lit(with_ms)), F.to_timestamp(text, plain))


def has_text(*values: Column) -> Column:
    """True if any value is neither null nor blank."""
    tests = [F.coalesce(v.cast("string").rlike(r"\P{javaWhitespace}"), F.lit(False)) for v in values]
    return reduce(lambda a, b: a | b, tests)


def file_number(binlog_file: Column) -> Column:
    """Numeric suffix of a log file name, so that ``.1000000`` follows ``.999999``."""
    return F.substring_index(binlog_file, ".", -1).cast("bigint")
