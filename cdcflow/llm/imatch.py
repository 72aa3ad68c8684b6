"""I-Match fingerprints: hashes of a text's terms of middling rarity, under several randomised subsets of the lexicon.

Terms are words, A-Z as a-z. The lexicon keeps terms whose inverse document frequency lies in a band. A fingerprint has a
part for each of ``SUBSETS`` random lexicon subsets: the text's distinct terms of the subset, sorted and hashed. Subsets
differ in density, so that short texts and long ones both have parts that a change elsewhere in the text leaves alone. A part
without terms is zero. A text without any lexicon term is hashed over all its terms. Likeness is the share of equal parts
among those where either fingerprint has terms.

The band's upper end keeps terms in at least ``least_share`` of the documents, so the lexicon has at most (mean distinct terms
of a document) / ``least_share`` terms, however many documents there are; that bound allows tasks to carry it.

Nulls and odd rows: a null text is empty, and empty texts share the fingerprint of nothing (likeness 1); null ids come last in
descending order; ids may repeat; rows with equal ids are ordered by their texts' hashes, then texts; other columns are ignored; an empty frame gives an
empty result; one document alone is its own next.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.arrays import mix, steps, words
from cdcflow.llm.frames import pick, same, saved, tidy

DENSITIES = (16, 64, 256, 1024)  # one in so many terms
PER_DENSITY = 12
SUBSETS = len(DENSITIES) * PER_DENSITY
RANGE_BYTES = 16 << 20
_TERM_BITS = 44
_PART = 8


def document_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each text, sorted, as 44-bit hashes, and the text of each."""
    hashes, at = words(data, offsets)
    of = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    both = np.sort((of << np.uint64(_TERM_BITS)) | (hashes >> np.uint64(64 - _TERM_BITS)))
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both & np.uint64((1 << _TERM_BITS) - 1), (both >> np.uint64(_TERM_BITS)).astype(np.int64)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [document_terms(data, offsets)[0] for _, _, data, offsets in steps(batch.column("text"))]
        terms, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "n"])


def lexicon(texts: DataFrame, most_share: float, least_share: float, least_documents: int) -> np.ndarray:
    """Sorted hashes of the terms in the band. ``texts`` has one column, ``text``."""
    total = texts.count()
    counted = texts.mapInArrow(tidy(_count_terms), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    low, high = max(least_documents, math.ceil(least_share * total)), most_share * total
    kept = counted.where(F.col("n").between(low, max(low, high))).select("term").toArrow()
    return np.sort(kept["term"].to_numpy()).view(np.uint64)


def fingerprints(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """A row of ``SUBSETS`` 32-bit parts for each text."""
    n = len(offsets) - 1
    terms, of = document_terms(data, offsets)
    if len(lexicon):
        known = lexicon[np.minimum(np.searchsorted(lexicon, terms), len(lexicon) - 1)] == terms
    else:
        known = np.zeros(len(terms), bool)
    bare = np.bincount(of[known], minlength=n) == 0
    use = known | bare[of]
    terms, of = terms[use], of[use]
    parts = np.zeros((n, SUBSETS), np.uint32)
    for k in range(SUBSETS):
        drawn = mix(terms ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        inside = drawn < np.uint64(2**64 // DENSITIES[k // PER_DENSITY])
        own = of[inside]
        first = np.searchsorted(own, own)
        rank = (np.arange(len(own)) - first + 1).astype(np.uint64)
        if not len(own):
            continue
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums = np.add.reduceat(mix(terms[inside] + rank * np.uint64(0xD6E8FEB86659FD93)), starts)
        parts[own[starts], k] = np.maximum(mix(sums) >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    lonely = bare & (np.bincount(of, minlength=n) > 0) & ~parts.any(axis=1)
    if lonely.any():  # terms, but none in any subset
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        whole = np.zeros(n, np.uint64)
        whole[of[starts]] = mix(np.add.reduceat(mix(terms), starts))
        parts[lonely, 0] = np.maximum(whole[lonely] >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    return parts


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal parts among those where either has terms; 1 where neither has any."""
    there = (a != 0) | (b != 0)
    n = there.sum(axis=1)
    return np.where(n > 0, ((a == b) & there).sum(axis=1) / np.maximum(n, 1), 1.0)


def as_text(parts: np.ndarray) -> list[str]:
    """Fixed-width hexadecimal parts, one after another."""
    digits = parts.astype(">u4").tobytes().hex()
    width = _PART * SUBSETS
    return [digits[i : i + width] for i in range(0, len(digits), width)]


def _of_texts(texts: list[str], lexicon: np.ndarray) -> np.ndarray:
    column = pa.array(texts, pa.large_string())
    return np.concatenate([np.zeros((0, SUBSETS), np.uint32), *[fingerprints(data, at, lexicon) for _, _, data, at in steps(column)]])


def edited(text: str, following: str) -> str:
    """The second half of a text replaced by the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT_TYPES = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(texts: list[str], following: list[str], own: np.ndarray, nexts: np.ndarray, lexicon: np.ndarray) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    other = _of_texts(changed, lexicon)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        pa.array(as_text(own)),
        pa.array(as_text(other)),
        pa.array(likeness(own, other)),
        pa.array(likeness(own, nexts)),
    ]


def _sorted_run(lexicon: np.ndarray):
    """Compare each document of a sorted range with the next. The range's last row is another range's first and only follows."""
    names = ["id", *_RESULT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column("id"), [t or "" for t in batch.column("text").to_pylist()]
            own = _of_texts(texts, lexicon)
            if held is not None:
                ids, texts, own = pa.concat_arrays([held[0], ids]), [held[1], *texts], np.concatenate([held[2], own])
            n = len(texts) - 1
            if n:
                yield pa.RecordBatch.from_arrays([ids.slice(0, n), *_compare(texts[:-1], texts[1:], own[:-1], own[1:], lexicon)], names)
            held = ids.slice(n, 1), texts[-1], own[-1:]

    return run


def _places(cuts: list, splits: int) -> list[tuple]:
    """Where ranges begin, in descending order of ids, each as an id and a least text hash; null ids come last, in ``splits`` ranges.

    An id that fills several ranges is a cut several times, and its rows are dealt to them by their texts' hashes.
    """
    times = Counter(cuts) | Counter({None: max(1, splits)})
    return [(cut, -(1 << 63) + (k << 64) // n) for cut, n in times.items() for k in range(n)]


def _part(places: list[tuple]) -> Column:
    """The number of ranges that begin at or before a row's id and text hash ``h``."""
    known = [(cut, h) for cut, h in places if cut is not None]
    nulls = [h for cut, h in places if cut is None]
    before = F.lit(0)
    if known:
        begins = F.array(*[F.struct(F.lit(cut).alias("id"), F.lit(h).cast("bigint").alias("h")) for cut, h in known])
        before = F.size(F.filter(begins, lambda b: (b["id"] > F.col("id")) | (b["id"] == F.col("id")) & (b["h"] <= F.col("h"))))
    among = F.size(F.filter(F.array(*[F.lit(h).cast("bigint") for h in nulls]), lambda h: h <= F.col("h")))
    return F.when(F.col("id").isNull(), len(known) + among).otherwise(before).cast("int")


def fingerprint_edits(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_share: float = 0.2,
    least_share: float = 1e-4,
    least_documents: int = 2,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document's beginning, and how alike they are.

    The next document is that of the next lower id (ids are numbers); after the last comes the first. Ranges of ids are cut at
    percentiles, and within an id that many rows share, or null, by the hash of the text; only rows equal in id and text must
    stay together. Ranges are sorted apart; each also gets the document that follows it, so texts are shuffled once.
    """
    base = pick(docs, id=id_col, text=text_col)
    kept = lexicon(base.select("text"), most_share, least_share, least_documents)
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(total / range_bytes))
    shares = [i / ranges for i in range(1, ranges)]
    cuts, no_id = base.agg(F.percentile_approx("id", shares or 0.5, 10_000), F.sum(F.when(F.col("id").isNull(), F.octet_length("text")))).first()
    places = _places(sorted(cuts or [], reverse=True) if shares else [], math.ceil((no_id or 0) / range_bytes))
    placed = base.select("id", "text", F.xxhash64("text").alias("h")).select(_part(places).alias("part"), "id", "text", "h")
    # One row for each range from here to the union. The first in a range has the greatest id and then the least hash.
    top = placed.groupBy("part").agg(F.max(F.struct("id", F.bitwise_not("h").alias("not_h"))).alias("top"))
    top = saved(top.select(F.col("part").alias("of"), F.col("top.id").alias("top"), F.bitwise_not("top.not_h").alias("top_h")), "tops")
    tied = placed.join(F.broadcast(top), (F.col("part") == F.col("of")) & same(F.col("id"), F.col("top")) & (F.col("h") == F.col("top_h")))
    first = tied.groupBy("part", "id").agg(F.min(F.struct("h", F.coalesce("text", F.lit("")).alias("text"))).alias("first"))
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = first.select(
        F.coalesce(F.lag("part").over(by_part), F.last("part").over(everything)).alias("part"), "id", "first.text", "first.h", F.lit(True).alias("follower")
    )
    sorted_ranges = (
        placed.withColumn("follower", F.lit(False))
        .unionByName(follows)
        .repartitionById(len(places) + 1, "part")
        .sortWithinPartitions("part", "follower", F.col("id").desc_nulls_last(), "h", "text")
    )
    id_type = base.schema["id"].dataType.simpleString()
    return sorted_ranges.select("id", "text").mapInArrow(tidy(_sorted_run(kept)), f"id {id_type}, {_RESULT_TYPES}").withColumnRenamed("id", id_col)
