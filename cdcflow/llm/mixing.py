"""A mix of sources at target weights, split among output shards by a multivariate-hypergeometric tree.

Each source's documents stand in a random order (a seeded hash) and are cut into blocks of about ``block_words`` words; a
source that is to give more words than it has goes through its order again. A source's quota of blocks is exact. The tree
halves the shards again and again: at each node the blocks of the left half are drawn, without replacement, from the
node's counts by source, so every shard gets its share of blocks, the shards' counts add up to the quotas, and each shard's
composition is random. A shard's blocks are a range of the source's random order that no other shard has, and its rows
carry a key that shuffles them within the shard.

Positions in a source's order come from sums over many small groups (source and hash bucket), so a source with a third of
all rows never meets in one task. The table of sources has a row for each source.

Nulls and odd rows: a null source is a source, last in order; a null or blank text has size 0 and is never taken; ids may be
null or repeat; rows equal in id and text may swap places; the same rows and seed give the same mix; an empty frame gives an
empty result; other columns stay in the struct ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.frames import same, saved

WEIGHTS = (5.0, 2.0, 1.0)
BUCKET_ROWS = 20_000
MOST_BLOCKS = 500_000_000  # numpy draws from fewer than 10**9
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + _WORD), F.lit(0)), F.lit(1), n.cast("int")), "")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most_repeats: int = 2) -> DataFrame:
    """source, source_size, target from source and source_size, a row for each source.

    Sources by code point, null last, take the weights in turn and share ``share`` times all sizes. No target is above
    ``most_repeats`` times its source's size; what that leaves goes to the others by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    everything = Window.partitionBy()
    s = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most_repeats)) * F.col("source_size"))
    s = s.withColumn("level", F.col("cap") / F.col("weight")).withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
    # Sources fill up in the order of their levels; the water stands at the first level that what is left can't reach.
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("water", (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(later))
    s = s.withColumn("place", F.row_number().over(order))
    open_ = F.when(F.col("level") > F.col("water"), F.struct("place", "water"))
    s = s.withColumn("stands", F.min(open_).over(everything)["water"])
    return s.select("source", "source_size", F.coalesce(F.least("cap", F.col("stands") * F.col("weight")), "cap").alias("target"))


def split_quotas(quotas: np.ndarray, shard: int, shards: int, seed: int) -> np.ndarray:
    """How many blocks of each source fall to ``shard``. All shards walk the same tree, so their shares add up to ``quotas``."""
    total, lo, hi, here = int(quotas.sum()), 0, shards, quotas
    while hi - lo > 1:
        middle = (lo + hi) // 2
        left = middle * total // shards - lo * total // shards
        drawn = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(here, left, method="marginals")
        if shard < middle:
            here, hi = drawn, middle
        else:
            here, lo = here - drawn, middle
    return here


def _shares(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """source, cuts: the shards' first blocks in the source's order."""

    def draw(key: tuple[int, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source_no")
        return pd.DataFrame({"source_no": rows["source_no"], "shard": key[0], "blocks": split_quotas(rows["blocks"].to_numpy(), key[0], shards, seed)})

    drawn = (
        quotas.select("source_no", "blocks", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .groupBy("shard")
        .applyInPandas(draw, "source_no bigint, shard int, blocks bigint")
    )
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = drawn.select("source_no", F.struct(F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("block"), "shard").alias("cut"))
    return first.groupBy("source_no").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))  # one entry for each shard


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most_repeats: int = 2,
    shards: int = 16,
    block_words: int = 4096,
    seed: int = 5,
) -> DataFrame:
    """row (the input row), size, source_size, target, pieces for each row.

    ``pieces`` lists what the mix takes of the row: round (from 0), shard, block, words (from the text's beginning), key
    (order within the shard).
    """
    hashed = F.xxhash64(F.lit(seed), docs[id_col], docs[text_col])
    buckets = max(1, math.ceil(docs.count() / BUCKET_ROWS))
    base = docs.select(F.struct("*").alias("row"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"), hashed.alias("h")).withColumn(
        "bucket", F.pmod(F.shiftright("h", 20), F.lit(buckets))
    )
    sums = saved(base.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "source-sums")
    planned = saved(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most_repeats), "targets")
    planned = planned.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint"))
    wanted = F.round("target").cast("bigint")
    asked = planned.agg(F.sum(wanted)).first()[0] or 0
    block_words = max(block_words, math.ceil(asked / MOST_BLOCKS))
    planned = planned.withColumn("wanted", wanted).withColumn("blocks", F.ceil(F.col("wanted") / block_words).cast("bigint"))
    shares = saved(_shares(planned, shards, seed), "shares")
    planned = planned.join(shares, "source_no").withColumnRenamed("source", "of")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    groups = groups.join(planned, same(groups.source, planned["of"])).select(
        F.col("source").alias("g_source"), F.col("bucket").alias("g_bucket"), "before", "source_size", "target", "wanted", "cuts"
    )
    within = Window.partitionBy("source", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    ordered = base.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    at = ordered.join(groups, same(ordered.source, groups.g_source) & (ordered.bucket == groups.g_bucket)).withColumn(
        "start", F.col("before") + F.col("within")
    )

    def piece(turn: int) -> Column:
        start = F.col("start") + F.lit(turn) * F.col("source_size")
        block = F.floor(start / block_words).cast("bigint")
        shard = F.element_at(F.filter("cuts", lambda c: c["block"] <= block), -1)["shard"]
        return F.struct(
            F.lit(turn).alias("round"),
            shard.alias("shard"),
            block.alias("block"),
            F.greatest(F.lit(0), F.least("size", F.col("wanted") - start)).alias("words"),
            F.xxhash64(F.lit(seed), F.lit(turn), "h").alias("key"),
        )

    pieces = F.filter(F.array(*[piece(turn) for turn in range(most_repeats)]), lambda p: p["words"] > 0)
    return at.select("row", "size", "source_size", "target", pieces.alias("pieces"))


def mixed_rows(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix's rows: shard, key, and the input's columns with the text taken. Sorted by key, a shard is shuffled."""
    taken = mixed.select("row", "size", F.explode("pieces").alias("piece"))
    fields = taken.schema["row"].dataType.names
    text = F.col(f"row.`{text_col}`")
    cut = F.when(F.col("piece.words") < F.col("size"), first_words(text, F.col("piece.words"))).otherwise(text)
    columns = [(cut if name == text_col else F.col(f"row.`{name}`")).alias(name) for name in fields]
    return taken.select(F.col("piece.shard").alias("_shard"), F.col("piece.key").alias("_key"), F.struct(*columns).alias("row")).select("_shard", "_key", "row")


def in_shards(rows: DataFrame) -> DataFrame:
    """``mixed_rows`` dealt so that a write's files, in the order of their names, hold shard after shard, each in key order.

    Ranges cut through a shard, so a shard is no task's whole load.
    """
    return rows.repartitionByRange("_shard", "_key").sortWithinPartitions("_shard", "_key")
