"""From raw documents to packed training sequences: filter, remove near copies, remove repeated passages, mix, pack."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow import files
from cdcflow.llm.frames import saved, scratch, small_batches
from cdcflow.llm.line_dedup import remove_repeats
from cdcflow.llm.mixing import in_shards, mix, mixed_rows
from cdcflow.llm.ngram_join import keep_one_of_each
from cdcflow.llm.packing import pack, token_pieces
from cdcflow.llm.quality import score, train
from cdcflow.llm.queries import SPECIAL_TOKENS, held_out

LEAST_SCORE = 0.3
#: A classifier, MinHash banding and tokenizers are not expressible in SQL.
ORACLE_SQL = None


_tables_before: list[str] = []


def stage(fn: Callable) -> Callable:
    """A stage, with small Arrow batches. What the stage before it saved on its way is removed, as its result is written by now.

    The first stage removes nothing, and what the last one saved stays, as its result may not be read yet.
    """

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        done = [] if fn.__name__ == STAGES[0][1].__name__ else _tables_before[:]
        _tables_before.clear()
        for path in done:
            files.remove(spark, path)
        with scratch(_tables_before):
            return fn(small_batches(spark, most_bytes="2m"), docs, sf_dir)

    return run


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """The struct ``row`` as columns, with another text and its length."""
    new = {"text": text, "n_chars": F.coalesce(F.char_length(text), F.lit(0)).cast("bigint")}
    return rows.select(*[new.get(name, F.col(f"row.`{name}`")).alias(name) for name in rows.schema["row"].dataType.names])


@stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network, trained on the labels outside the held-out fold, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).where(F.col("score") >= LEAST_SCORE).select("row.*")


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by 0.8 similarity of five-word shingles."""
    return keep_one_of_each(docs)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return _with_text(remove_repeats(docs), F.col("kept"))


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, a row for each time, written by shard in the order of their keys."""
    rows = saved(in_shards(mixed_rows(mix(docs))).select("row"), "mixed")
    return _with_text(rows, F.col("row.text"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL_TOKENS)
    return pack(saved(pieces.withColumnRenamed("id", "doc_id"), "pieces"))


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
