"""Best-fit decreasing packing of tokenised documents into windows.

Documents longer than a window are first cut into full windows and a rest. Then all pieces, longest first, go into the open
window with the least room that still holds them. Which piece goes where depends on the lengths alone, so the packing is
worked out on how many pieces have each length (at most one count per length of the window), with windows of equal content
kept as ranges; a segment tree indexed by remaining capacity finds the tightest open window. Each piece then finds its window
from its length and its number among the pieces of that length. The result is best-fit decreasing over all pieces at once.

Nulls and odd rows: a null text is empty and still has its end token; ids may be null or repeat; other columns are ignored;
equal pieces may swap places; an empty frame gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.frames import pick, saved, tidy

WINDOW = 1024
PIECE_ROWS_PER_GROUP = 100_000
#: Bytes of token ids, of whole documents, that a task hands on at a time.
STEP_BYTES = 1 << 20
_ORDINAL_BITS = 48


class OpenWindows:
    """How many open windows have each remaining capacity; finds the least capacity that holds a length."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, length: int) -> int | None:
        at = self.leaves + length
        if self.count[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(lengths: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows of (length, first piece, first window, pieces in each window, offset of the first) for counts by length.

    Pieces of one length are numbered from 0; a row holds up to the next row's first piece or the next length.
    """
    tree, ranges, steps, opened = OpenWindows(window), defaultdict(list), [], 0
    for length in sorted(lengths, reverse=True):
        piece, left = 0, lengths[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, fresh = window, math.ceil(left / (window // length))
                first, n, opened = opened, fresh, opened + fresh
            else:
                first, n = ranges[room].pop()
                tree.add(room, -n)
            each = room // length
            full = min(n, left // each)
            steps.append((length, piece, first, each, window - room))
            used = [(first, full, room - each * length)]
            some = left - full * each if full < n else 0
            if some:
                used.append((first + full, 1, room - some * length))
            used.append((first + full + (some > 0), n - full - (some > 0), room))
            for start, number, capacity in used:
                if number and capacity:
                    ranges[capacity].append((start, number))
                    tree.add(capacity, number)
            piece, left = piece + full * each + some, left - full * each - some
    return np.array(steps, np.int64).reshape(-1, 5)


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end_id: int = 0, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, start, length, ids, doc_tokens: each document's token ids and an end id, cut into full windows and a rest.

    ``ids`` holds little-endian unsigned 32-bit numbers. ``ranks_path`` is a vocabulary file that every machine has. Two more
    columns number the pieces for ``pack``: ``part``, the task that cuts them, and ``nth``, from 0 among those of a length there.
    """
    marks, end = tuple(special.items()), np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, part, seen = _encoding(ranks_path, pattern, marks), TaskContext.get().partitionId(), [0] * (window + 1)
        for batch in batches:
            texts, row = batch.column("text"), 0
            while row < len(texts):
                rows, starts, lengths, ids, totals, nths, size = [], [], [], [], [], [], 0
                while row < len(texts) and size < STEP_BYTES:
                    raw = encoding.encode_to_numpy(texts[row].as_py() or "", allowed_special="all").astype("<u4").tobytes() + end
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        rows.append(row)
                        starts.append(start)
                        lengths.append(length := min(window, n - start))
                        nths.append(seen[length])
                        seen[length] += 1
                        ids.append(raw[4 * start : 4 * (start + window)])
                        totals.append(n)
                    row, size = row + 1, size + len(raw)
                numbers = [pa.array(values, pa.int64()) for values in (starts, lengths, totals, nths)]
                start, length, total, nth = numbers
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows, pa.int64())), start, length, pa.array(ids, pa.binary()), total, pa.array([part] * len(rows), pa.int32()), nth],
                    ["id", "start", "length", "ids", "doc_tokens", "part", "nth"],
                )

    base = pick(docs, id=id_col, text=text_col)
    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(tidy(run), f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, part int, nth bigint")


def _numbered(pieces: DataFrame, group_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with ``ordinal``, from 0 among those of their length, and the counts by length.

    Pieces are numbered within groups, each group's numbers following those of the groups before it. Where ``token_pieces`` has
    numbered them within its tasks, those are the groups and no piece is moved; others are dealt into groups by hash.
    """
    if {"part", "nth"} <= set(pieces.columns):
        placed = pieces.withColumnsRenamed({"part": "grp", "nth": "within"})
    else:
        groups = max(1, math.ceil(pieces.count() / group_rows))
        within = Window.partitionBy("length", "grp").orderBy(*[c for c in pieces.columns if c != "length"])
        placed = pieces.withColumn("grp", F.pmod(F.xxhash64(*pieces.columns), F.lit(groups))).withColumn("within", F.row_number().over(within) - 1)
    sizes = placed.groupBy("length", "grp").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    sizes = saved(sizes.select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "n"), "groups")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length up to the window
    numbered = placed.join(sizes.drop("n"), ["length", "grp"])  # the smaller side by far: a row for each group and length
    return numbered.withColumn("ordinal", F.col("before") + F.col("within")), histogram


def pack(pieces: DataFrame, window: int = WINDOW, group_rows: int = PIECE_ROWS_PER_GROUP) -> DataFrame:
    """Give pieces (column ``length``, 1 to ``window``, and others that can be ordered) a sequence_id and an offset.

    Reads ``pieces`` more than once: give a saved frame. The numbers that ``token_pieces`` gives are dropped.
    """
    numbered, histogram = _numbered(pieces, group_rows)
    steps = best_fit_decreasing(histogram, window)
    keys = (steps[:, 0] << _ORDINAL_BITS) | steps[:, 1]
    order = np.argsort(keys)
    keys, steps = keys[order], steps[order]
    kept = pieces.drop("part", "nth")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, ordinal = batch.column("length").to_numpy(), batch.column("ordinal").to_numpy()
            _, first, opened, each, offset = steps[np.searchsorted(keys, (length << _ORDINAL_BITS) | ordinal, "right") - 1].T
            here = ordinal - first
            sequence, at = opened + here // each, offset + here % each * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(at)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return numbered.select(*names, "ordinal").mapInArrow(tidy(run), f"{schema}, sequence_id bigint, offset bigint")
