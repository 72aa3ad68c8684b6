"""Joins against a side that may or may not be small, with hot keys split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT = "_salt"
_RIGHT_ROWS = {"right", "full"}  # kinds that also give right rows without a partner
_KEYS_ONLY = {"semi", "anti"}


def _kind(how: str) -> str:
    """Spark's names of a join kind as one."""
    name = how.lower().replace("_", "")
    return {"outer": "full", "leftsemi": "semi", "leftanti": "anti"}.get(name, name.removesuffix("outer"))


def row_salt(df: DataFrame, salt: int) -> Column:
    """0 to ``salt`` - 1 from the row and the task that holds it.

    A task run again gives the same, whatever the order of its rows, and equal rows in different tasks are spread.
    """
    simple = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return F.pmod(F.xxhash64(*simple, F.spark_partition_id()), F.lit(salt))


def equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salt: int = 1) -> DataFrame:
    """Join on equal columns, of any kind.

    Semi and anti joins meet each right key once, so a key that many right rows share is no burden. ``salt`` above 1
    spreads each key of the left side over that many tasks, with the right side repeated once per salt; right rows without a
    partner are then added by a join with the distinct left keys. Without a salt, Spark splits hot keys at run time where it can:
    either side of inner joins, the left side of left, semi and anti joins, the right side of right joins, no side of full ones.
    """
    kind = _kind(how)
    if kind in _KEYS_ONLY:
        right = right.select(*on).distinct()
    if salt <= 1:
        return left.join(right, on, kind)
    spread = left.withColumn(_SALT, row_salt(left, salt))
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    matched_as = {"right": "inner", "full": "left"}.get(kind, kind)
    joined = spread.join(repeated, [*on, _SALT], matched_as).drop(_SALT)
    if kind not in _RIGHT_ROWS:
        return joined
    alone = right.join(left.select(*on).distinct(), on, "anti")
    return joined.union(left.where(F.lit(False)).join(alone, on, "right"))


def lookup_join(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner", salt: int = 1) -> DataFrame:
    """Join a large frame with a side that is usually small.

    Nothing is counted or forced: Spark broadcasts the side if its bytes allow it, or else shuffles, and splits hot keys of the
    large frame. The rows are the same whatever the sizes. ``salt`` above 1 splits the keys of the large frame from the start.
    """
    return equi_join(df, side, on, how, salt)
