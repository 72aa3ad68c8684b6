"""Canonical schemas, declared column types and node input/output lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_IMAGE, _CELLS = T.MapType(_STRING, _STRING), T.ArrayType(_STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_PLACE = {"binlog_file": _STRING, "binlog_pos": _LONG, "row_seq": _INT, "event_ts_ms": _LONG, "gtid": _STRING}
CHANGE_EVENT = _struct(db_table=_STRING, op=_STRING, before=_IMAGE, after=_IMAGE, **_PLACE)
ROW_EVENT = _struct(table_id=_LONG, op=_STRING, before_cells=_CELLS, after_cells=_CELLS, **_PLACE)
TABLE_MAP = _struct(table_id=_LONG, db_table=_STRING, binlog_file=_STRING, binlog_pos=_LONG, event_ts_ms=_LONG)
OFFSETS = _struct(
    db_table=_STRING, info=_IMAGE, binlog_file=_STRING, binlog_pos=_LONG, event_ts_ms=_LONG, gtid=_STRING, row_seq=_INT
)
COLUMN_CATALOG = _struct(
    table_schema=_STRING, table_name=_STRING, column_name=_STRING, ordinal=_INT, data_type=_STRING
)
RAW_CELL = _struct(
    event_id=_LONG, row_seq=_INT, column_name=_STRING, mysql_type=_STRING, meta=_INT, length=_INT, raw=T.BinaryType()
)

# The declared type names and what each one is in Spark.
DECLARED_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.IntegerType(),
    "LONG": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "BYTE": T.StringType(),
    "BYTES": T.BinaryType(),
    "DATE": T.TimestampType(),
    "OBJECT": T.StringType(),
}


def declared_type(name: str) -> T.DataType:
    """Spark type of a declared type name, in any case; an unknown name is an error."""
    try:
        return DECLARED_TYPES[name.upper()]
    except KeyError:
        raise ValueError(f"unknown column type {name!r}") from None


def parse_declared(value: Column, type_name: str) -> Column:
    """Read a string column as a declared type. Null stays null, bad numbers raise."""
    kind = type_name.upper()
    target = declared_type(kind)
    if kind in ("STRING", "BYTE", "OBJECT"):
        return value
    if kind == "BOOLEAN":
        return F.lower(value) == "true"
    if kind == "DATE":
        return F.timestamp_millis(value.cast("bigint"))
    if kind == "BYTES":
        return F.encode(value, "UTF-8")
    return value.cast(target)


@dataclass(frozen=True)
class NodeColumn:
    """One declared column of a node's input or output."""

    name: str
    type: str
    outputable: bool = True
    targetable: bool = False
    disabled: bool = False

    @classmethod
    def of(cls, item: NodeColumn | Mapping) -> NodeColumn:
        if isinstance(item, cls):
            return item
        known = {k: item[k] for k in ("name", "type", "outputable", "targetable", "disabled") if k in item}
        return cls(**known)

    def field(self) -> T.StructField:
        flags = {"outputable": self.outputable, "targetable": self.targetable, "disabled": self.disabled}
        return T.StructField(self.name, declared_type(self.type), True, flags)


def node_inputs(declared: Iterable[NodeColumn | Mapping]) -> T.StructType:
    """All declared input columns."""
    return T.StructType([NodeColumn.of(c).field() for c in declared])


def node_outputs(declared: Iterable[NodeColumn | Mapping]) -> T.StructType:
    """The declared output columns that are flagged outputable."""
    return T.StructType([f for f in node_inputs(declared) if f.metadata["outputable"]])


def project_declared(
    df: DataFrame, component_columns: Iterable[str], declared: Iterable[NodeColumn | Mapping]
) -> DataFrame:
    """Select the component's columns in its order, typed from the declared list.

    String columns are parsed by the declared type's own rule, others are cast. A component
    column without a declaration is left out.
    """
    types = {c.name: c.type for c in map(NodeColumn.of, declared)}
    names = [n for n in component_columns if n in types]
    return df.select(*[_typed(df, n, types[n]).alias(n) for n in names])


def _typed(df: DataFrame, name: str, type_name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_declared(F.col(name), type_name)
    return F.col(name).cast(declared_type(type_name))


def resolve_columns(available: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """Match column names without regard to case and outer blanks; a missing one is an error."""
    by_key = {a.strip().lower(): a for a in available}
    found, missing = [], []
    for name in wanted:
        match = by_key.get(name.strip().lower())
        found.append(match) if match is not None else missing.append(name)
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return found
