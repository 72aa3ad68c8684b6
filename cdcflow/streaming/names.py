"""Names of row events while their log arrives: the newest table map of an event's table id that precedes it.

The state is two committed tables: the table maps so far, with runs of one name kept as their first, and the events that wait for a
map. Each micro-batch resolves its own and the waiting events by the same join along the log as a batch does, log file by
log file, so a hot table is no task's whole load and cells never leave the JVM. Events, maps and what waits are
committed in one step.

An event goes out as soon as a map that precedes it has arrived, under the newest such map. An event without one waits, for
any number of batches; ``waiting`` has these. An event that comes late, after maps of later positions, still gets the map before it.
A map that comes after a later event was named from an older one renames nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdcflow.functions.values import file_number
from cdcflow.operators.changelog import resolve_table_ids
from cdcflow.streaming.manifest import Manifest, committed

_MAP = ["table_id", "binlog_file", "binlog_pos", "db_table"]
IS_MAP = "is_table_map"


def one_log(row_events: DataFrame, table_maps: DataFrame) -> DataFrame:
    """Row events and table maps as one frame or stream, as ``resolve_names`` takes it."""
    events = row_events.withColumns({"db_table": F.lit(None).cast("string"), IS_MAP: F.lit(False)})
    return events.unionByName(table_maps.select(*_MAP).withColumn(IS_MAP, F.lit(True)), allowMissingColumns=True)


def first_of_runs(maps: DataFrame) -> DataFrame:
    """Without maps that give their id the name that it has already."""
    along = Window.partitionBy("table_id").orderBy(file_number(F.col("binlog_file")), "binlog_pos")
    return maps.withColumn("_before", F.lag("db_table").over(along)).where(~F.col("_before").eqNullSafe(F.col("db_table"))).select(*_MAP)


def resolve_names(log: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Commit each row event of a log (``one_log``) with its ``db_table`` once it is known."""
    manifest = Manifest(log.sparkSession, path, merge={"maps": first_of_runs})

    def make(batch: DataFrame, before: dict) -> dict:
        new_maps = batch.where(IS_MAP).select(*_MAP)
        events = batch.where(~F.col(IS_MAP)).drop(IS_MAP, "db_table")
        maps, waiting = new_maps, manifest.read("waiting", before)
        if waiting is not None:
            maps = manifest.read("maps", before).unionByName(new_maps)
            events = events.unionByName(waiting)
        resolved = resolve_table_ids(events, maps)
        return {
            "append": {"rows": resolved.where(F.col("db_table").isNotNull()), "maps": first_of_runs(new_maps)},
            "replace": {"waiting": resolved.where(F.col("db_table").isNull()).drop("db_table")},
        }

    return committed(log, manifest, make, checkpoint, once=once)


def named_rows(spark: SparkSession, path: str) -> DataFrame | None:
    return Manifest(spark, path).read("rows")


def waiting(spark: SparkSession, path: str) -> DataFrame | None:
    """Events that no table map precedes so far, without a name."""
    found = Manifest(spark, path).read("waiting")
    return None if found is None else found.withColumn("db_table", F.lit(None).cast(T.StringType()))
