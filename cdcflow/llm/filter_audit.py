"""How five quality filters interact: what each removes, at each place in each of the 120 orders.

A document's five outcomes are one of 32 codes, so all that the audit needs of a part (a source) is how many documents, good
ones and toxic ones have each code: a tensor of 2 x 2 x 2 x 2 x 2 counts, whose axes are the filters (0 passes, 1 fails). Each
figure contracts it with one vector an axis: ``pass`` keeps what passes, ``fail`` what fails, ``both`` sums over the axis. At a
step, the earlier filters' axes take ``pass``, its own takes ``fail`` (removed) or ``pass`` (kept), the later ones ``both``.

Spark makes the counts: the filters that see one text only are expressions over the scan, and a narrow row of each document
is written. Copies are found by their digests' least ids (SHA-256), which are counted before the shuffle; only texts that
several ids hold are joined back, by a join that Spark may split, as its result is counted by part and code before it is
shuffled. From then on there are at most 32 rows a part; parts are contracted in parallel, many in one einsum.

Nulls and odd rows: a null text is empty; a null source and an empty one are the part ''; a null id is never smaller than
another, copies no other and has no label; rows of one id and text are no copies of one another but of smaller ids; a document is
good or toxic if any label of its id says so; an empty frame gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, saved

LETTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(LETTERS)]
PASS, FAIL, BOTH = (1, 0), (0, 1), (1, 1)
_SPACE = "[ \\t-\\r]+"
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_failures(text: Column, least_words: int = 50, least_distinct: int = 65, most_capitals: int = 5, marks: str = "#$%&*|") -> list[Column]:
    """Filters A to D as conditions of failure: few words, repeated words, capitals (both in percent), marks."""
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < least_words,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(least_distinct) * F.size(words),
        F.lit(100) * capitals > F.lit(most_capitals) * F.char_length(text),
        text.rlike(f"[{marks}]"),
    ]


def outcome_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", failures=text_failures
) -> DataFrame:
    """part, code, n, good, toxic: documents of each part and code, of which bit i says that filter i fails (the last: copies)."""
    base = pick(docs, id=id_col, text=text_col, part=part_col).select("id", F.coalesce("part", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    fails = failures(F.col("text"))
    code = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(fails)), F.lit(0))
    spread = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    narrow = saved(base.select("id", "part", code.alias("code"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), spread.alias("spread")), "outcomes")

    firsts = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    copies = F.when(F.col("id") > F.col("first"), 1 << len(fails))
    marked = narrow.join(firsts, "digest", "left").select("id", "part", (F.col("code") + F.coalesce(copies, F.lit(0))).alias("code"), "spread")

    says = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int")).alias(name)
    known = pick(labels, label_id="doc_id", quality="quality", toxic="toxic").where("label_id is not null").groupBy("label_id").agg(says("quality"), says("toxic"))
    # Rows without an id match nothing and are spread by a number of their own.
    labelled = marked.withColumn("by", F.coalesce("id", "spread")).join(known, (F.col("by") == F.col("label_id")) & F.col("id").isNotNull(), "left")
    return labelled.groupBy("part", "code").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])


def _vectors(earlier: tuple, own: tuple, later: tuple) -> list[np.ndarray]:
    """For each axis a row for each order and step: which of its slices the contraction takes."""
    rows = [
        [own if axis == letter else earlier if axis in order[:step] else later for axis in LETTERS] for order in ORDERS for step, letter in enumerate(order)
    ]
    return list(np.array(rows, np.int64).transpose(1, 0, 2))


def contract(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Tensors of counts (documents, good, toxic; then parts, then 32 codes) to each figure by part and by order and step."""
    # Bit 0 of a code varies fastest, so the last axis is the first filter: turn the axes round.
    tensor = counts.reshape(3, -1, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
    take = lambda t, *vectors: np.einsum("...abcde,ka,kb,kc,kd,ke->...k", t, *_vectors(*vectors))
    removed, good_lost, toxic_lost = take(tensor, PASS, FAIL, BOTH)
    filters = np.array([LETTERS.index(letter) for order in ORDERS for letter in order])
    totals = np.stack([removed[:, filters == i].sum(axis=1) for i in range(len(LETTERS))], axis=1)
    return {
        "kept": take(tensor[0], PASS, PASS, BOTH),
        "removed": removed,
        "redundant": take(tensor[0], BOTH, FAIL, BOTH) - removed,
        "unique_fails": take(tensor[0], PASS, FAIL, PASS),
        "good_lost": good_lost,
        "toxic_lost": toxic_lost,
        "shapley": totals[:, filters],
    }


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders = pa.array([order for order in ORDERS for _ in LETTERS])
    steps = pa.array(np.tile(np.arange(1, len(LETTERS) + 1, dtype=np.int32), len(ORDERS)))
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            some = batch.slice(start, 64)
            counts = np.zeros((3, some.num_rows, 1 << len(LETTERS)), np.int64)
            for row, cells in enumerate(some.column("cells").to_pylist()):
                for cell in cells:
                    counts[:, row, cell["code"]] = cell["n"], cell["good"], cell["toxic"]
            found = contract(counts)
            for row in range(some.num_rows):
                part = pa.array([some.column("part")[row].as_py()] * len(orders), pa.string())
                yield pa.RecordBatch.from_arrays([part, orders, steps, *[pa.array(found[c][row]) for c in _COUNTS]], ["part", "filter_order", "step", *_COUNTS])


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """part, filter_order, step and the seven counts, for each part, order and step."""
    cells = saved(outcome_counts(docs, labels, **columns), "cells")
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("code", "n", "good", "toxic")).alias("cells"))  # at most 32
    return parts.mapInArrow(_figures, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS))
