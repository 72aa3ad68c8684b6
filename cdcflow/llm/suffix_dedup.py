"""Removal of every byte that lies in a string of ``length`` bytes which also starts anywhere else.

Sorting all suffixes of a corpus would move many times its size. Instead each ``length``-byte window has an anchor: the
position of the least hash among its ``gram``-byte substrings, which depends on the window's bytes alone. Equal windows have
equal substrings at equally placed anchors, so only suffixes that start at anchors need comparing, and only where an anchor's
substring occurs at another anchor too. An anchor serves a run of neighbouring windows; its context is the bytes they cover.

Anchors with equal contexts (copies) are settled by their digests, counted before the shuffle; those of the most frequent
contexts are dealt evenly, so that no task gets all copies of a text. Each different context goes once to the group of its
substring. There the suffixes from the anchors, and the reversed texts before them, are
put in order by deep-shallow sorting; from the common lengths of neighbours follow, for each two anchors, how far they agree
to the right and left, and so which bytes both share over at least ``length``. Groups beyond ``group_anchors`` are not sorted
together: their windows are counted by digest instead, which is exact as well (up to 64-bit collisions) and needs no group in
one task.

Nulls and odd rows: a null text is empty; ids may be null or repeat; each row counts as a document of its own, so equal rows
are copies of one another; texts shorter than ``length`` keep all; an empty frame gives an empty result; other columns stay in
the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.arrays import mix, prefix_hashes, span_hashes, text_bytes
from cdcflow.llm.deep_shallow import sort_strings
from cdcflow.llm.frames import complete_groups, pick, saved, text_key, tidy

LENGTH, GRAM = 400, 32
GROUP_ANCHORS = 2_000
#: Anchors of so many of the most frequent contexts are marked by broadcast. Any other context has less than one anchor in so many.
HOT_CONTEXTS = 1_000
SEGMENT = 1 << 19
_POSITION_BITS = 24


def _segments(offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts long enough, in runs of about a segment; a longer text in overlapping parts: text, first byte, end byte."""
    held, size = [], 0
    for text in np.flatnonzero(np.diff(offsets) >= length):
        for at in range(int(offsets[text]), int(offsets[text + 1]) - length + 1, SEGMENT):
            end = min(at + SEGMENT + length - 1, int(offsets[text + 1]))
            if size and size + end - at > 2 * SEGMENT:
                yield tuple(np.array(held).T)
                held, size = [], 0
            held.append((text, at, end))
            size += end - at
    if held:
        yield tuple(np.array(held).T)


def _least_before(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    n = len(keys)
    padded = np.concatenate([keys, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """text, at (the anchor), lo, hi (first and last start of its windows; bytes within the text), gram and context hashes."""
    out: dict[str, list] = {k: [] for k in ("text", "at", "lo", "hi", "gram", "context")}
    for text, first, end in _segments(offsets, length):
        sizes = end - first
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        joined = np.concatenate([data[a:b] for a, b in zip(first, end, strict=True)])
        prefix = prefix_hashes(joined)
        n = len(joined) - gram + 1
        hashes = span_hashes(prefix, np.arange(n), np.arange(gram, gram + n))
        keys = (hashes >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(n, dtype=np.uint64)
        least = (_least_before(keys, length - gram + 1) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        starts = np.arange(len(least))
        of = np.searchsorted(bounds, starts, "right") - 1
        whole = starts + length <= bounds[of + 1]
        starts, least, of = starts[whole], least[whole], of[whole]
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1])
        lo_row = np.flatnonzero(new)
        hi_row = np.append(lo_row[1:], len(starts)) - 1
        shift = (first - offsets[text])[of[lo_row]] - bounds[of[lo_row]]
        out["text"].append(text[of[lo_row]])
        out["at"].append(least[lo_row] + shift)
        out["lo"].append(starts[lo_row] + shift)
        out["hi"].append(starts[hi_row] + shift)
        out["gram"].append(hashes[least[lo_row]].view(np.int64))
        sizes_mixed = mix((least[lo_row] - starts[lo_row]).astype(np.uint64) * np.uint64(1 << 20) + (starts[hi_row] - starts[lo_row]).astype(np.uint64))
        out["context"].append((span_hashes(prefix, starts[lo_row], starts[hi_row] + length) ^ sizes_mixed).view(np.int64))
    return {k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in out.items()}


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_anchors(*text_bytes(batch.column("text")), length, gram)
            columns = [batch.column("key").take(pa.array(found["text"])), *[pa.array(found[c]) for c in ("gram", "context", "at", "lo", "hi")]]
            yield pa.RecordBatch.from_arrays(columns, ["key", "gram", "context", "at", "lo", "hi"])

    return run


def _contexts(length: int):
    """Bytes before and from each wanted anchor; for groups beyond the limit, the windows' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy()
            cols: dict[str, list] = {k: [] for k in ("gram", "key", "at", "left", "right", "digest")}
            for row, wanted in enumerate(batch.column("wanted").to_pylist()):
                text = data[offsets[row] : offsets[row + 1]]
                for w in wanted:
                    at, lo, end = w["at"], w["lo"], w["hi"] + length
                    if w["crowded"]:
                        part = text[lo:end]
                        first = np.arange(len(part) - length + 1)
                        for i, d in zip((first + lo).tolist(), span_hashes(prefix_hashes(part), first, first + length).view(np.int64).tolist(), strict=True):
                            for name, value in (("gram", w["gram"]), ("key", keys[row]), ("at", i), ("left", None), ("right", None), ("digest", d)):
                                cols[name].append(value)
                    else:
                        for name, value in (("gram", w["gram"]), ("key", keys[row]), ("at", at), ("left", text[lo:at].tobytes()), ("right", text[at:end].tobytes()), ("digest", None)):
                            cols[name].append(value)
            types = {"left": pa.binary(), "right": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in cols.items()], list(cols))

    return run


def _matrix(strings: list[bytes]) -> np.ndarray:
    width = max(1, max(map(len, strings)))
    out = np.zeros((len(strings), width), np.uint16)
    for row, s in enumerate(strings):
        out[row, : len(s)] = np.frombuffer(s, np.uint8)
    lengths = np.array([len(s) for s in strings])
    out += np.arange(width) < lengths[:, None]
    return out


def _agreement(strings: list[bytes]) -> np.ndarray:
    """How many first characters each two strings share."""
    order, shared = sort_strings(_matrix(strings))
    m = len(order)
    table = np.full((m, m), np.iinfo(np.int32).max, np.int32)
    for i in range(m - 1):
        table[i, i + 1 :] = np.minimum.accumulate(shared[i + 1 :])
    table = np.minimum(table, table.T)
    back = np.empty(m, np.int64)
    back[order] = np.arange(m)
    lengths = np.array([len(s) for s in strings])
    return np.minimum(table[np.ix_(back, back)], np.minimum(lengths[:, None], lengths[None, :]))


def shared_spans(left: list[bytes], right: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(member, bytes before its anchor, bytes from it) covered by strings of ``length`` bytes that another member has too."""
    before, after = _agreement([s[::-1] for s in left]), _agreement(right)
    enough = before + after >= length
    np.fill_diagonal(enough, False)
    rows, others = np.nonzero(enough)
    found = np.unique(np.stack([rows, before[rows, others], after[rows, others]], axis=1), axis=0)
    return [tuple(r) for r in found.tolist()]


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in complete_groups(batches, ["gram"]):
            keys, at = table["key"].to_numpy(), table["at"].to_numpy()
            left, right = table["left"].to_pylist(), table["right"].to_pylist()
            out_key, out_start, out_end = [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                for member, before, after in shared_spans(left[a:b], right[a:b], length):
                    out_key.append(keys[a + member])
                    out_start.append(at[a + member] - before)
                    out_end.append(at[a + member] + after)
            yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.int64()), pa.array(out_start, pa.int64()), pa.array(out_end, pa.int64())], ["key", "start", "end"])

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans cover."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, removed = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw, at, parts = (text or "").encode(), 0, []
            gone = merged([(s["start"], s["end"]) for s in spans or ()])
            for start, end in gone:
                parts.append(raw[at:start])
                at = end
            kept.append(b"".join([*parts, raw[at:]]))
            removed.append([{"start": a, "end": b} for a, b in gone])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.binary()), pa.array(removed, span)], ["row", "kept", "removed"])


def remove_repeated_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group_anchors: int = GROUP_ANCHORS,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """row (the input row), kept (its remaining bytes), removed (array of start, end in bytes, maximal runs) for each row."""
    base = pick(docs, id=id_col, text=text_col)
    key = F.xxhash64("id", text_key("text"))
    texts = base.select(key.alias("key"), "text")
    anchors = saved(
        texts.where(F.octet_length("text") >= length).mapInArrow(tidy(_anchors(length, gram)), "key bigint, gram bigint, context bigint, at bigint, lo bigint, hi bigint"), "anchors"
    )
    # One row for each different context, with one of its anchors: equal contexts are equal from their first byte to their last.
    one = [F.first(c).alias(c) for c in ("key", "at", "lo", "hi")]
    contexts = anchors.groupBy("gram", "context").agg(F.count("*").alias("n"), *one)
    grams = contexts.groupBy("gram").agg(F.count("*").alias("contexts"), F.sum("n").alias("total")).where("total > 1").select("gram", "contexts")
    met = saved(contexts.join(grams, "gram"), "met")
    copies = met.where("n > 1").select("gram", "context", "n")
    hot = copies.orderBy(F.desc("n"), "gram", "context").limit(hot_contexts).select("gram", "context", F.lit(True).alias("hot"))
    # An anchor of a hot context is a copy whatever it meets, so these are dealt by themselves and not by their context.
    dealt = anchors.join(F.broadcast(hot), ["gram", "context"], "left")
    dealt = dealt.select("key", "lo", "hi", "gram", "hot", F.when(F.col("hot"), F.xxhash64("key", "at")).otherwise(F.col("context")).alias("by"))
    known = dealt.join(copies.select("gram", F.col("context").alias("by"), F.lit(True).alias("copy")), ["gram", "by"], "left")
    settled = known.where(F.col("hot") | F.col("copy")).select("key", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    asked = met.where("contexts > 1")
    wanted = asked.groupBy("key").agg(
        F.collect_list(F.struct("gram", "at", "lo", "hi", (F.col("contexts") > group_anchors).alias("crowded"))).alias("wanted")  # of one document
    )
    fetched = saved(
        texts.join(wanted, "key").dropDuplicates(["key"]).mapInArrow(tidy(_contexts(length)), "gram bigint, key bigint, at bigint, left binary, right binary, digest bigint"),
        "contexts",
    )
    sorted_groups = fetched.where("digest is null").select("gram", "key", "at", "left", "right").repartition("gram").sortWithinPartitions("gram", "key", "at")
    compared = sorted_groups.mapInArrow(tidy(_compare(length)), "key bigint, start bigint, end bigint")
    windows = fetched.where("digest is not null")
    again = windows.groupBy("gram", "digest").agg(F.count("*").alias("n")).where("n > 1").select("gram", "digest")
    counted = windows.join(again, ["gram", "digest"]).select("key", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    spans = settled.union(compared).union(counted).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one document
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(docs[id_col], text_key(docs[text_col])).alias("key"), docs[text_col].alias("text"))
    joined = rows.join(spans, "key", "left").select("row", "text", "spans")
    row_type = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(tidy(_cut), f"row {row_type}, kept binary, removed array<struct<start: bigint, end: bigint>>")
