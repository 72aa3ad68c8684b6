"""Two-pass external shuffle into shards.

Pass one scatters the rows over buckets by a seeded hash, so many that each fits in a task's memory. Pass two shuffles each
bucket by Fisher-Yates and writes it. Read one after the other, the buckets are one random order of all rows; dealing that
order out to the shards in turn keeps their row counts at most one apart.

Nulls and odd rows: no column needs to be unique or present beside the size column. A row's place in the scan is part of its
hash, so rows that are equal in all columns spread as well; the same files, splits and seed give the same order. An empty
frame gives an empty result. The input row stays whole in the struct ``row``, so its column names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.frames import saved, tidy

BUCKET_BYTES = 32 << 20
_OUT_ROWS = 1000


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _fisher_yates(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # one bucket
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        if not table.num_rows:
            return
        bucket = table["bucket"][0].as_py()
        order = np.argsort(table["scanned"].to_numpy(), kind="stable")  # rows arrive in any order
        order = order[np.random.default_rng([seed, bucket]).permutation(len(order))]  # numpy's permutation is Fisher-Yates
        for first in range(0, len(order), _OUT_ROWS):
            part = order[first : first + _OUT_ROWS]
            taken = table["row"].take(pa.array(part)).combine_chunks()
            n = len(part)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, bucket)), pa.array(np.arange(first, first + n)), taken], ["bucket", "place", "row"])

    return run


def external_shuffle(df: DataFrame, size: Column, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """bucket, place, row: a random order of all rows, written bucket by bucket to the shared folder."""
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    scanned = F.monotonically_increasing_id()
    placed = df.select(F.struct("*").alias("row"), scanned.alias("scanned")).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed), "scanned"), F.lit(buckets)).cast("bigint")
    )
    row_type = placed.schema["row"].dataType.simpleString()
    shuffled = placed.repartitionById(buckets, F.col("bucket").cast("int")).mapInArrow(tidy(_fisher_yates(seed)), f"bucket bigint, place bigint, row {row_type}"
    )
    return saved(shuffled, "buckets")


def shards(df: DataFrame, size: Column, count: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """shard, slot, row: shuffled rows dealt to ``count`` shards, slots from 0 without gaps, row counts at most one apart."""
    shuffled = external_shuffle(df, size, seed, bucket_bytes)
    each = shuffled.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row for each bucket, not for each row of the input.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select(F.col("bucket").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    at = F.col("before") + F.col("place")
    # Its size is known: 16 bytes for each ``bucket_bytes`` of input. Unbroadcast, the join would shuffle all texts again.
    return shuffled.join(F.broadcast(offsets), shuffled.bucket == offsets["of"]).select(
        F.pmod(at, F.lit(count)).cast("int").alias("shard"), F.floor(at / count).cast("bigint").alias("slot"), "row"
    )
