"""Running values along an order, without one task per key.

A plain window puts all rows of a key into one task. Here the order is cut into chunks by
columns that never decrease along it (a log file, a block of ids). Rows meet only the rows of
their own key and chunk; one small row per key and chunk carries the value over to later chunks.
Chunk columns go from coarse to fine, so the carrying rows can be cut up again the same way. A
chunk's number occurs once in the whole order: it is not counted anew in each coarser chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COARSE, _FINE = "_coarse", "_fine"
_CHUNK_VALUE = "_chunk_value"
_CARRIED = "_carried"
_FROM_EARLIER = "_from_earlier"


def running_sum(
    df: DataFrame,
    keys: list[str],
    chunks: list[str],
    order: list[str],
    value: Column,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Sum of ``value`` over the key's rows up to this one (or before it). Keys must not be null."""
    return _running(df, keys, chunks, order, value, out, _SUM, inclusive)


def last_value(
    df: DataFrame,
    keys: list[str],
    chunks: list[str],
    order: list[str],
    value: Column,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Newest non-null ``value`` of the key up to this row (or before it). Keys must not be null."""
    return _running(df, keys, chunks, order, value, out, _LAST, inclusive)


def block(number: Column, size: int) -> Column:
    """Which block of ``size`` consecutive whole numbers a number lies in."""
    return F.call_function("div", number, F.lit(size))


def blocks(number: Column, size: int) -> dict[str, Column]:
    """Two chunk columns, coarse and fine, for an order by whole numbers."""
    return {_COARSE: block(number, size * size), _FINE: block(number, size)}


CHUNKS = [_COARSE, _FINE]


class _SUM:
    over = staticmethod(lambda value, order: F.sum(value))
    of_chunk = staticmethod(lambda value, order: F.sum(value))
    join = staticmethod(lambda here, earlier: F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0)))


class _LAST:
    over = staticmethod(lambda value, order: F.last(value, ignorenulls=True))
    of_chunk = staticmethod(lambda value, order: F.max_by(value, F.when(value.isNotNull(), F.struct(*order))))
    join = staticmethod(lambda here, earlier: F.coalesce(here, earlier))


def _running(df, keys, chunks, order, value, out, kind, inclusive):
    *outer, chunk = chunks or [None]
    group = keys + chunks[-1:]
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    here = kind.over(value, order).over(upto)
    if not chunks:
        return df.withColumn(out, here)
    # Said outright so that both uses of the chunk rows have the same plan and share its shuffle.
    has_key = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group + outer])
    per_chunk = (
        df.where(has_key)
        .groupBy(*group)
        .agg(kind.of_chunk(value, order).alias(_CHUNK_VALUE), *[F.min(c).alias(c) for c in outer])
    )
    earlier = _running(
        per_chunk, keys, outer, [chunk], F.col(_CHUNK_VALUE), _CARRIED, kind, inclusive=False
    ).select(*group, F.struct(_CARRIED).alias(_FROM_EARLIER))
    # Every row has its chunk's row; none is found only where a key is null.
    carried = F.coalesce(
        F.col(_FROM_EARLIER), F.raise_error(F.lit(f"null in {group}")).cast(earlier.schema[_FROM_EARLIER].dataType)
    )[_CARRIED]
    return (
        df.withColumn(out, here)
        .join(earlier, group, "left")
        .withColumn(out, kind.join(F.col(out), carried))
        .drop(_FROM_EARLIER)
    )
