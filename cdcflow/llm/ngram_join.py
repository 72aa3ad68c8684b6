"""All pairs of texts whose sets of word n-grams are similar, found by MinHash bands and checked on the full sets.

Equal texts are one class from the start. Each text gets a MinHash signature, cut into bands; texts that agree in a band
meet in that band's bucket. Buckets are cut into units of bounded size: a small bucket is one unit, a large one is cut into
tiles, and every two tiles are a unit. A unit reads the whole texts of its members and compares the full n-gram sets. Two
texts count in the first band in which they agree, so no pair counts twice, and no pair is ever a row: a unit gives one row
for each member. No bucket is dropped or cut, whatever its size.

Nulls and odd rows: a null text is empty; texts without words link to equal texts only; ids may be null or repeat (rows are
told apart by id and text); other columns are ignored; an empty frame gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.arrays import grams, mix, segment_reduce, steps, words
from cdcflow.llm.components import components
from cdcflow.llm.frames import complete_groups, pick, same, saved, text_key, tidy

UNIT_TEXTS = 256


class Bands(NamedTuple):
    count: int
    rows: int


class Similar(NamedTuple):
    """``rows``: id, class_id (least id of all texts reached by links), text_id (least id of equal texts), n_links (other
    documents at or above the threshold, copies included), n_text_links (other texts). ``texts``: text_key, class_key."""

    rows: DataFrame
    texts: DataFrame
    documents: DataFrame


def choose_bands(threshold: float, recall: float, most_hashes: int = 100) -> Bands:
    """The longest bands that find a pair at the threshold with the target recall within a number of hashes.

    More similar pairs are found with higher probability; longer bands let fewer dissimilar texts meet.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        count = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if count * rows <= most_hashes:
            best = Bands(count, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


def _band_hashes(data: np.ndarray, offsets: np.ndarray, n: int, bands: Bands, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of band hashes for each text, and its number of n-grams."""
    hashes, at = grams(*words(data, offsets), n)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    draw = np.random.default_rng(seed)
    flips = draw.integers(0, 2**32, bands.count * bands.rows, dtype=np.uint32)
    factors = draw.integers(0, 2**32, (bands.count * bands.rows, 2), dtype=np.uint32) | np.uint32(1)
    out = np.empty((len(at) - 1, bands.count), np.uint64)
    for band in range(bands.count):
        total = np.full(len(at) - 1, band + 1, np.uint64)
        for k in range(band * bands.rows, (band + 1) * bands.rows):
            h = (short ^ flips[k]) * factors[k, 0]
            h ^= h >> np.uint32(15)
            h *= factors[k, 1]
            total = mix(total + segment_reduce(np.minimum, h, at, 0))
        out[:, band] = total
    return out, np.diff(at)


def _signatures(n: int, bands: Bands, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id"), batch.column("text_key")
            for row, end, data, offsets in steps(batch.column("text")):
                made, count = _band_hashes(data, offsets, n, bands, seed)
                full = np.where(count > 0, bands.count, 0)
                values = pa.array(made[count > 0].ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full)]), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([ids.slice(row, end - row), keys.slice(row, end - row), lists], ["id", "text_key", "bands"])

    return run


def _units(texts: DataFrame, unit_texts: int) -> DataFrame:
    """unit, band, lo, hi, tile, text_key: which texts each unit compares."""
    member = texts.select("text_key", F.posexplode("bands").alias("band", "bucket"))
    crowded = member.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = member.join(crowded, ["band", "bucket"])
    small = (
        member.where(F.col("n") <= unit_texts)
        .groupBy("band", "bucket")
        .agg(F.array_sort(F.collect_list("text_key")).alias("keys"))  # at most unit_texts
        .groupBy("keys")
        .agg(F.min("band").alias("band"))
        .select(F.xxhash64("keys").alias("unit"), "band", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("tile"), F.explode("keys").alias("text_key"))
    )
    tiles = F.ceil(F.col("n") / unit_texts).cast("int")
    large = (
        member.where(F.col("n") > unit_texts)
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("text_key"), "tiles").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(F.col("bucket").alias("unit"), "band", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "text_key")
    )
    return small.unionByName(large)


def _overlaps(sets: np.ndarray, owner: np.ndarray, m: int, columns: int = 4096) -> np.ndarray:
    """How many n-grams each two of ``m`` texts share."""
    _, of, count = np.unique(sets, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[of.ravel()]
    column, row = number[of.ravel()[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((m, m), np.float32)
    for first in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(column, [first, first + columns])
        block = np.zeros((m, columns), np.float32)
        block[row[a:b], column[a:b] - first] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _verify(n: int, threshold: float):
    scale = 1_000_000
    least = round(threshold * scale)

    def unit(table: pa.Table):
        m = table.num_rows
        found, owners = [], []
        for row, _, data, offsets in steps(table["text"].combine_chunks()):
            hashes, at = grams(*words(data, offsets), n)
            own = np.repeat(np.arange(row, row + len(at) - 1), np.diff(at))
            order = np.lexsort((hashes, own))
            own, hashes = own[order], hashes[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
            owners.append(own[new])
            found.append(hashes[new])
        owner = np.concatenate(owners)
        size = np.bincount(owner, minlength=m)
        both = _overlaps(np.concatenate(found), owner, m)
        linked = both * scale >= least * (size[:, None] + size[None, :] - both)
        band = table["band"][0].as_py()
        width = len(table["bands"][0])
        made = table["bands"].combine_chunks().flatten().to_numpy().reshape(m, width)
        linked &= made[:, band][:, None] == made[:, band][None, :]
        for earlier in range(band):
            linked &= made[:, earlier][:, None] != made[:, earlier][None, :]
        tile = table["tile"].to_numpy()
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        if lo != hi:
            linked &= tile[:, None] != tile[None, :]
        np.fill_diagonal(linked, False)
        return linked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in complete_groups(batches, ["unit", "band", "lo", "hi"]):
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                group = table.slice(a, b - a).combine_chunks()
                if b - a < 2:
                    continue
                linked = unit(group)
                rows = np.flatnonzero(linked.any(axis=1))
                if not len(rows):
                    continue
                copies = group["copies"].to_numpy()
                root = _roots(linked)
                keys = group["text_key"].combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows)), keys.take(pa.array(root[rows])), pa.array(linked[rows] @ copies), pa.array(linked[rows].sum(axis=1))],
                    ["text_key", "root", "links", "text_links"],
                )

    return run


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least index that links lead to, for each member."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def similar_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999,
    seed: int = 11,
    unit_texts: int = UNIT_TEXTS,
) -> Similar:
    """Classes and link counts of texts whose word ``n``-gram sets have at least ``threshold`` Jaccard similarity.

    ``recall`` is the least probability with which a pair at the threshold is found. Words are runs between ASCII white
    space, A-Z read as a-z; a text of fewer than ``n`` words is one n-gram.
    """
    bands = choose_bands(threshold, recall)
    base = pick(docs, id=id_col, text=text_col).withColumn("text_key", text_key("text"))
    id_type = base.schema["id"].dataType.simpleString()
    signed = saved(
        base.select("id", "text_key", "text").mapInArrow(tidy(_signatures(n, bands, seed)), f"id {id_type}, text_key binary, bands array<bigint>"), "signatures"
    )
    texts = saved(
        signed.groupBy("text_key").agg(F.min("id").alias("text_id"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "texts"
    )
    units = saved(_units(texts, unit_texts), "units")
    wanted = units.select("text_key").distinct().join(texts, "text_key")
    held = (
        base.join(wanted, (base.text_key == wanted.text_key) & same(base.id, wanted.text_id))
        .select(wanted.text_key, base.text, wanted.copies, wanted.bands)
        .dropDuplicates(["text_key"])
    )
    key = ["unit", "band", "lo", "hi"]
    found = saved(
        units.join(held, "text_key")
        .select(*key, "tile", "text_key", F.coalesce("text", F.lit("")).alias("text"), "copies", "bands")
        .repartition(*key)
        .sortWithinPartitions(*key, "text_key")
        .mapInArrow(tidy(_verify(n, threshold)), "text_key binary, root binary, links bigint, text_links bigint"),
        "links",
    )
    counts = found.groupBy("text_key").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    labels = components(found.where("text_key != root").select(F.col("text_key").alias("a"), F.col("root").alias("b")))
    classes = texts.join(labels.select(F.col("node").alias("text_key"), F.col("label").alias("found_key")), "text_key", "left").select(
        "text_key", "text_id", "copies", F.coalesce("found_key", "text_key").alias("class_key")
    )
    least = classes.groupBy("class_key").agg(F.min("text_id").alias("class_id"))
    info = saved(classes.join(least, "class_key").join(counts, "text_key", "left"), "classes")
    rows = signed.select("id", "text_key").join(info, "text_key").select(
        F.col("id").alias(id_col),
        "class_id",
        "text_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
    )
    return Similar(rows, info.select("text_key", "class_key", "text_id", "class_id"), signed)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near copies: of each class, the row with the least id stays, with all its columns.

    Rows equal in id and text count as one.
    """
    found = similar_texts(docs, id_col, text_col, **options)
    first = found.texts.groupBy("class_key").agg(F.min(F.struct(F.col("text_id").isNull(), "text_id", "text_key")).alias("first"))
    kept = first.select(F.col("first.text_id").alias("_kept_id"), F.col("first.text_key").alias("_kept_key"))
    keyed = docs.withColumn("_kept_key_of_row", text_key(docs[text_col]))
    on = (keyed["_kept_key_of_row"] == kept["_kept_key"]) & same(keyed[id_col], kept["_kept_id"])
    return keyed.join(kept, on, "left_semi").dropDuplicates([id_col, "_kept_key_of_row"]).select(*docs.columns)
