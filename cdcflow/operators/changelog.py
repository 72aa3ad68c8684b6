"""Filters and projections over change events."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.values import file_number, shifted_ms, utc_day, value_text, wall_clock_as_local
from cdcflow.operators.joins import lookup_join
from cdcflow.operators.ordered import last_value

# Operation codes.
OP_CODES = {"insert": 1, "update": 2, "delete": 3}

PROVENANCE = ["binlog_file", "binlog_pos", "row_seq", "event_ts_ms", "gtid"]
_GTID_RANGE = re.compile(r"(\d+)(?:-(\d+))?")


# -- which events -----------------------------------------------------------------------------


def only_tables(log: DataFrame, db_tables: list[str]) -> DataFrame:
    """Keep the listed ``db.table`` keys."""
    return log.where(F.col("db_table").isin(db_tables))


def only_changes(log: DataFrame, include_deletes: bool = False) -> DataFrame:
    """Keep inserts and updates, and deletes only when asked for."""
    return log.where(F.col("op").isin(list(OP_CODES) if include_deletes else ["insert", "update"]))


def from_position(log: DataFrame, binlog_file: str | None, position: int = 0) -> DataFrame:
    """Events at or after a log position, files ordered by their number."""
    if not binlog_file:
        return log
    number = int(binlog_file.rsplit(".", 1)[-1])
    at = F.col("file_no") if "file_no" in log.columns else file_number(F.col("binlog_file"))
    return log.where((at > number) | ((at == number) & (F.col("binlog_pos") >= position)))


def from_timestamp(log: DataFrame, start_ms: int | None) -> DataFrame:
    """Events not strictly older than the start; no start keeps all.

    In a log landed by day, the days before the start are not read.
    """
    if start_ms is None:
        return log
    if "event_date" in log.columns:
        log = log.where(F.col("event_date") >= utc_day(F.lit(start_ms)))
    return log.where(F.col("event_ts_ms") >= start_ms)


def gtid_in_set(gtid: Column, gtid_set: str) -> Column:
    """Whether ``uuid:n`` lies in a set ``uuid:a-b[:c-d][,uuid:..]``; a null gtid does not."""
    source, txn = F.substring_index(gtid, ":", 1), F.substring_index(gtid, ":", -1).cast("bigint")
    tests = []
    for part in filter(None, (p.strip() for p in gtid_set.split(","))):
        uuid, *ranges = part.split(":")
        for text in ranges:
            found = _GTID_RANGE.fullmatch(text.strip())
            if not found:
                raise ValueError(f"bad transaction range {text!r}")
            low = int(found[1])
            tests.append((source == uuid) & txn.between(low, int(found[2] or low)))
    if not tests:
        raise ValueError("empty transaction set")
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def outside_txn_set(log: DataFrame, gtid_set: str | None) -> DataFrame:
    """Skip events whose transaction is in the set; events without one stay."""
    return log if not gtid_set else log.where(~gtid_in_set(F.col("gtid"), gtid_set))


# -- from row events to named images ----------------------------------------------------------


def resolve_table_ids(row_events: DataFrame, table_maps: DataFrame) -> DataFrame:
    """Name each row event by the newest table map of its id that precedes it in the log.

    One log file is the unit of work, so a hot table is spread over its files.
    """
    named = table_maps.select("table_id", "binlog_file", "binlog_pos", F.col("db_table").alias("_name"))
    log = (
        row_events.withColumn("_name", F.lit(None).cast("string"))
        .unionByName(named.withColumn("_is_map", F.lit(True)), allowMissingColumns=True)
        .withColumn("_file_no", file_number(F.col("binlog_file")))
    )
    resolved = last_value(log, ["table_id"], ["_file_no"], ["binlog_pos"], F.col("_name"), "db_table")
    return resolved.where(F.col("_is_map").isNull()).drop("_name", "_is_map", "_file_no")


def catalog_names(catalog: DataFrame) -> DataFrame:
    """One row per table: its column names by ordinal."""
    return catalog.groupBy(F.concat_ws(".", "table_schema", "table_name").alias("db_table")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))), lambda c: c["column_name"]).alias(
            "_names"
        )
    )


def named_images(row_events: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cell arrays to column maps, and the rows whose cell count does not fit their table.

    Inserts fill ``after``, deletes ``before``, updates both; the other map stays empty. Inserts
    and deletes must have exactly the table's columns. Updates may carry extra cells, which are
    not named, but not fewer. A table without a catalog entry is not registered and is left out; a
    row whose table is not known at all, as no table map came before it, is among the rejects.
    """
    joined = lookup_join(row_events, catalog_names(catalog), ["db_table"])
    width = F.size("_names")
    is_insert, is_delete, is_update = (F.col("op") == o for o in ("insert", "delete", "update"))
    fits = F.coalesce(
        F.when(is_insert, F.size("after_cells") == width)
        .when(is_delete, F.size("before_cells") == width)
        .when(is_update, (F.size("before_cells") >= width) & (F.size("after_cells") >= width)),
        F.lit(False),
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def image(cells: str, filled: Column) -> Column:
        return F.when(filled, F.map_from_arrays("_names", F.slice(cells, 1, width))).otherwise(empty)

    good = joined.where(fits).withColumns(
        {
            "before": image("before_cells", is_delete | is_update),
            "after": image("after_cells", is_insert | is_update),
        }
    )
    rejects = joined.where(~fits)
    nameless = row_events.where(F.col("db_table").isNull())
    return good.drop("_names", "before_cells", "after_cells"), rejects.drop("_names").unionByName(nameless)


def effective_image() -> Column:
    """``after`` of inserts and updates, ``before`` of deletes, null for anything else."""
    return F.when(F.col("op").isin("insert", "update"), F.col("after")).when(F.col("op") == "delete", F.col("before"))


def op_code() -> Column:
    """1 insert, 2 update, 3 delete, else null."""
    codes = F.create_map(*[F.lit(v) for pair in OP_CODES.items() for v in pair])
    return F.try_element_at(codes, F.col("op"))


# -- to output rows ---------------------------------------------------------------------------


def emit_columns(
    log: DataFrame,
    columns: list[str],
    image: str = "after",
    missing: str = "error",
    shift_zone: str | None = None,
    zoned: list[str] | None = None,
) -> list[Column]:
    """The output columns as text, in order, taken from a map or typed struct image.

    In a struct, a name it does not have is an error, or null with ``missing='null'``; the keys of
    a map are only known per row, so there it is always null. ``shift_zone`` reads zoned
    timestamps as wall clocks of that zone; a map holds them as epoch milliseconds, so ``zoned`` has to
    name them there.
    """
    kind = log.schema[image].dataType
    if isinstance(kind, T.MapType):
        if shift_zone and zoned is None:
            raise ValueError("a zone shift of map images needs the names of the zoned columns")
        texts = {c: F.try_element_at(F.col(image), F.lit(c)) for c in columns}
        return [(shifted_ms(t, shift_zone) if shift_zone and c in zoned else t).alias(c) for c, t in texts.items()]
    unknown = [c for c in columns if c not in kind.names]
    if unknown and missing != "null":
        raise ValueError(f"no such column: {', '.join(unknown)}")
    out = []
    for c in columns:
        if c in unknown:
            out.append(F.lit(None).cast("string").alias(c))
            continue
        value, data_type = F.col(image)[c], kind[c].dataType
        if shift_zone and isinstance(data_type, T.TimestampType):
            value = wall_clock_as_local(value, shift_zone)
        out.append(value_text(value, data_type).alias(c))
    return out


def emit(log: DataFrame, columns: list[str], keep: list[str] | None = None, **how) -> DataFrame:
    """Project change events to output rows, with any provenance columns asked for."""
    return log.select(*(keep or []), *emit_columns(log, columns, **how))


def typed_columns(log: DataFrame, schema: T.StructType, image: str = "after") -> list[Column]:
    """The columns of ``schema`` from the image, in its types.

    Map images hold text, in which timestamps are epoch milliseconds.
    """
    if not isinstance(log.schema[image].dataType, T.MapType):
        return [F.col(image)[f.name].cast(f.dataType).alias(f.name) for f in schema]

    def of_text(f: T.StructField) -> Column:
        text = F.try_element_at(F.col(image), F.lit(f.name))
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.timestamp_millis(text.cast("bigint")).cast(f.dataType)
        return text.cast(f.dataType)

    return [of_text(f).alias(f.name) for f in schema]


def with_envelope(df: DataFrame, route: str | None = None) -> DataFrame:
    """Add a row id, the emit time in ms and a route label."""
    return df.withColumns(
        {
            "_uuid": F.expr("uuid()"),
            "_emit_time": F.unix_millis(F.current_timestamp()),
            "_route_path": F.lit(route).cast("string"),
        }
    )
