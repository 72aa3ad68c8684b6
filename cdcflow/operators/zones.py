"""Pages of a table that lies in the order of its pages: a map of its zones says which few files hold a page.

``lay_out`` deals a table into folders along the page order (by update time and key with null times first, or by key alone), cuts the
sorted rows of each into zones, and writes one row a zone to a map: how many rows it has, and the least and greatest value of
each order column; rows without a time count apart. The greatest values of all columns together are no less, in page order, than
any row of the zone, and the least no greater, so from the map follows between which places of the order a zone's rows lie.

A page then reads only the zones whose places meet it, whether it follows saved progress or an offset, however deep: their
folders alone, and there what Parquet's statistics don't rule out. The map is read whole (a row for each ``rows_per_zone`` rows);
of it, the driver gets the zones of the page.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow import files
from cdcflow.operators.paging import keyset_page, rows_after

_FOLDER, _ZONE, _TIMED = "_folder", "_zone", "_timed"
ROWS_PER_FOLDER = 1_000_000
_ROW_BITS = 33  # of a monotonically increasing id, for the row's place in its partition


def lay_out(df: DataFrame, path: str, order: list[str], rows_per_zone: int = 1_000_000) -> None:
    """Write a table's rows in zones along ``order`` (null values of its first column first), then their map."""
    folders = max(1, math.ceil(df.count() / max(rows_per_zone, ROWS_PER_FOLDER)))
    dealt = df.repartitionByRange(folders, *order).withColumn(_FOLDER, F.spark_partition_id()).sortWithinPartitions(_FOLDER, *order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    zone = F.shiftleft(F.col(_FOLDER).cast("bigint"), _ROW_BITS) + F.call_function("div", place, F.lit(rows_per_zone))
    placed = dealt.withColumn(_ZONE, zone)
    placed.write.partitionBy(_FOLDER).parquet(f"{path}/rows")
    files.write_text(df.sparkSession, f"{path}/schema.json", placed.schema.json())
    rows = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    bounds = [f(c).alias(f"{name}_{c}") for c in order for name, f in (("lo", F.min), ("hi", F.max))]
    found = rows.groupBy(_FOLDER, _ZONE, F.col(order[0]).isNotNull().alias(_TIMED)).agg(F.count("*").alias("_rows"), *bounds)
    found.coalesce(1).write.parquet(f"{path}/map")


def zone_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/map")


def _placed(zones: DataFrame, order: list[str], counted: Column) -> DataFrame:
    """Zones with ``_first``, the rows that certainly come before all of theirs, and ``_end``, those that may come before their last.

    ``counted`` says of which zones all rows are certain to count. Bounds are put in order as points; running totals along them
    count the zones that end before a zone begins, and those that begin before it ends.
    """
    key = [F.col(_ZONE), F.col(_TIMED)]
    point = lambda side, tag, before, upto: zones.select(
        *key, *[F.col(f"{side}_{c}").alias(c) for c in order], F.lit(tag).alias("_tag"), before.alias("_before"), upto.alias("_upto")
    )
    points = point("lo", 0, F.lit(0), F.col("_rows")).union(point("hi", 1, F.when(counted, F.col("_rows")).otherwise(0), F.lit(0)))
    along = Window.orderBy(*[F.asc_nulls_first(c) for c in order], "_tag").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.withColumns({"_before": F.sum("_before").over(along), "_upto": F.sum("_upto").over(along)})
    ends = swept.groupBy(*key).agg(
        F.max(F.when(F.col("_tag") == 0, F.col("_before"))).alias("_first"), F.max(F.when(F.col("_tag") == 1, F.col("_upto"))).alias("_end")
    )
    return zones.join(ends, [_ZONE, _TIMED])


def _rows_of(spark: SparkSession, path: str, zones: list, order: list[str]) -> DataFrame:
    """The rows of some zones' timed and untimed halves, from their folders alone."""
    schema = T.StructType.fromJson(json.loads(files.read_text(spark, f"{path}/schema.json")))
    if not zones:
        return spark.createDataFrame([], schema).drop(_ZONE, _FOLDER)
    folders = sorted({f"{path}/rows/{_FOLDER}={z[_FOLDER]}" for z in zones})
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders)
    half = lambda timed: [z[_ZONE] for z in zones if z[_TIMED] == timed]
    has_value = F.col(order[0]).isNotNull()
    return rows.where((has_value & F.col(_ZONE).isin(half(True))) | (~has_value & F.col(_ZONE).isin(half(False)))).drop(_ZONE, _FOLDER)


def _bound(zones: DataFrame, order: list[str], side: str) -> DataFrame:
    """The map with one side's bounds under the names of the order columns."""
    return zones.select(*[c for c in zones.columns if c.startswith("_")], *[F.col(f"{side}_{c}").alias(c) for c in order])


def zoned_keyset_page(
    spark: SparkSession, path: str, update_time: str, primary_key: list[str], saved: Mapping[str, str] | None, page_size: int
) -> DataFrame:
    """The page after saved progress (or the first one) of a table laid out by update time and key."""
    order, zones = [update_time, *primary_key], zone_map(spark, path)
    whole = F.lit(True)
    if saved:
        # A zone holds rows of the page only if its greatest values come after the progress, and no others if the least do.
        after = lambda side: _bound(zones, order, side).where(rows_after(_bound(zones, order, side), update_time, primary_key, saved))
        some, all_of = (after(side).select(_ZONE, _TIMED) for side in ("hi", "lo"))
        zones = zones.join(some, [_ZONE, _TIMED], "left_semi").join(all_of.withColumn("_whole", F.lit(True)), [_ZONE, _TIMED], "left")
        whole = F.col("_whole").isNotNull()
    needed = _placed(zones, order, whole).where(F.col("_first") < page_size).select(_FOLDER, _ZONE, _TIMED).collect()  # about a page's rows
    return keyset_page(_rows_of(spark, path, needed, order), update_time, primary_key, saved, page_size)


def zoned_offset_page(spark: SparkSession, path: str, order: list[str], offset: int, page_size: int) -> DataFrame:
    """``page_size`` rows after the first ``offset`` of a table laid out by ``order``."""
    placed = _placed(zone_map(spark, path), order, F.lit(True)).cache()
    try:
        before = placed.where(F.col("_end") <= offset).agg(F.sum("_rows")).first()[0] or 0
        needed = placed.where((F.col("_end") > offset) & (F.col("_first") < offset + page_size)).select(_FOLDER, _ZONE, _TIMED).collect()
    finally:
        placed.unpersist()
    rows = _rows_of(spark, path, needed, order).orderBy(*[F.asc_nulls_first(c) for c in order])
    return rows.offset(offset - before).limit(page_size)
