"""Removal of lines that many documents hold, by levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z as a-z. Keys of at least ``least_chars`` code points that at least
``least_docs`` documents hold lose all their lines but those of the largest id that holds them.

The hashes of the long lines (128-bit BLAKE2) are written once, dealt into batches of descending ids. Each batch is aggregated
to one entry a key (documents, largest id), merge-anti-joined with the runs, so that keys already settled there (enough
documents; the largest id is known, as later batches hold smaller ones) go no further, and written as a run of its own. Runs
are tables bucketed and sorted by the hash, so these joins don't shuffle the runs. When a level holds ``fanout`` runs, they are
merged into one of the next level. A key may have entries in several runs until all are merged at the end. ``LineRuns`` can go
on with more batches at any time.

Entries are counted before the shuffle, so a very common line is one row a task there. The lines are then joined with the
common keys; Spark may split that join's hot keys. Texts are shuffled once, to be met by the numbers of the lines that go, and
stay in the JVM there.

Nulls and odd rows: a null or empty text is one empty line; each row is a document of its own; null ids rank below all others,
and where all ids are null, or several rows have the largest id, all of these keep the line; a document that holds a key twice
counts once, keeps or loses both; an empty frame gives an empty result; other columns stay in the struct ``row``.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, saved, tidy
from cdcflow.session import shared_dir

LEAST_DOCS, LEAST_CHARS = 5, 40
HASH = ["h1", "h2"]
#: Bytes of text that a task turns into line hashes at a time.
STEP_BYTES = 1 << 20


class LineRuns:
    """Entries (h1, h2, n, last: documents and largest id of a key) in runs by level, each sorted by the hash."""

    def __init__(self, spark, least_docs: int = LEAST_DOCS, fanout: int = 2, buckets: int | None = None):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = defaultdict(list)

    def add(self, entries: DataFrame) -> None:
        """Add a batch, one row a key, of ids below those of earlier batches."""
        for name in [name for level in self.levels.values() for name in level]:
            settled = self.spark.table(name).where(F.col("n") >= self.least_docs).select(*HASH, F.lit(True).alias("settled"))
            # Not written as an anti-join, which Spark would move below the batch's aggregation.
            entries = entries.join(settled.hint("merge"), HASH, "left").where("settled is null").drop("settled")
        self.levels[0].append(self._write(entries))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._merge(self.levels[level], level)
            level += 1

    def merged(self) -> DataFrame:
        """All entries, one row a key."""
        names = [name for level in sorted(self.levels) for name in self.levels[level]]
        return self._together(names)

    def close(self) -> None:
        """Forget the runs' names."""
        for level in self.levels.values():
            for name in level:
                self.spark.sql(f"drop table if exists {name}")
        self.levels.clear()

    def _merge(self, names: list[str], level: int) -> None:
        self.levels[level + 1].append(self._write(self._together(names)))
        for name in names:
            self.spark.sql(f"drop table {name}")
        names.clear()

    def _together(self, names: list[str]) -> DataFrame:
        """Runs merged two at a time: sorted tables of equal buckets need no shuffle."""
        first, *others = names
        out = self.spark.table(first)
        for name in others:
            other = self.spark.table(name).select(*HASH, F.col("n").alias("n2"), F.col("last").alias("last2"))
            n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            out = out.join(other.hint("merge"), HASH, "full").select(*HASH, n.alias("n"), F.greatest("last", "last2").alias("last"))
        return out

    def _write(self, entries: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = entries.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", shared_dir(self.spark, "line-run")).saveAsTable(name)
        return name


def _line_hashes(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            start = 0
            while start < len(texts):
                size, rows, numbers, firsts, digests = 0, [], [], [], []
                while start < len(texts) and size < STEP_BYTES:
                    text = texts[start].as_py() or ""
                    seen = set()
                    for number, line in enumerate(text.split("\n")):
                        line = line.strip(" \t\v\f\r")
                        if len(line) < least_chars:
                            continue
                        digest = hashlib.blake2b(line.encode().lower(), digest_size=16).digest()  # bytes.lower knows A-Z only
                        rows.append(start)
                        numbers.append(number)
                        firsts.append(digest not in seen)
                        digests.append(digest)
                        seen.add(digest)
                    size, start = size + len(text) + 1, start + 1
                at = pa.array(rows, pa.int64())
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [batch.column(c).take(at) for c in ("id", "k1", "k2")]
                columns += [pa.array(numbers, pa.int32()), pa.array(firsts, pa.bool_()), *map(pa.array, halves.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "k1", "k2", "number", "first", *HASH])

    return run


def batch_bounds(ids: DataFrame, batches: int) -> list[int]:
    """Ids that cut the rows into about equal batches, in descending order; null ids are left out."""
    if batches < 2:
        return []
    cuts = ids.where("id is not null").stat.approxQuantile("id", [i / batches for i in range(1, batches)], 0.01)
    return sorted({math.ceil(cut) for cut in cuts}, reverse=True)


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """row (the input row), n_lines, n_dropped, kept (its text without the lines that go) for each row. Ids are whole numbers."""
    spark = docs.sparkSession
    base = pick(docs, id=id_col, text=text_col).withColumns(_row_keys("id", "text"))
    bounds = batch_bounds(base.select("id"), batches)
    batch = F.lit(len(bounds))  # the last has the smallest ids, and null ones
    for i, bound in reversed(list(enumerate(bounds))):
        batch = F.when(F.col("id") >= bound, i).otherwise(batch)
    id_type = base.schema["id"].dataType.simpleString()
    lines = base.mapInArrow(tidy(_line_hashes(least_chars)), f"id {id_type}, k1 bigint, k2 bigint, number int, first boolean, h1 bigint, h2 bigint")
    lines = saved(lines.withColumn("batch", batch), "lines", "batch")

    runs = LineRuns(spark, least_docs, fanout)
    for i in range(len(bounds) + 1):
        runs.add(lines.where((F.col("batch") == i) & F.col("first")).groupBy(*HASH).agg(F.count("*").alias("n"), F.max("id").alias("last")))
    common = saved(runs.merged().where(F.col("n") >= least_docs).select(*HASH, "last"), "common")
    runs.close()

    going = lines.join(common, HASH).where(~F.col("id").eqNullSafe(F.col("last")))
    going = going.groupBy("k1", "k2").agg(F.collect_set("number").alias("going"))  # of one document
    rows = docs.select(F.struct("*").alias("row"), docs[text_col].alias("text")).withColumns(_row_keys(f"row.`{id_col}`", "text"))
    met = rows.join(going, ["k1", "k2"], "left").withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "going")
    kept = F.array_join(F.transform(staying, lambda i: F.get("lines", i)), "\n")
    return met.select(
        "row",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("going"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("going").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"),
    )


def _row_keys(id_col: str, text_col: str) -> dict:
    """128 bits that stand for a row's id and text; rows equal in both lose the same lines."""
    return {name: F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(text_col, F.lit(""))) for name, seed in (("k1", 1), ("k2", 2))}
