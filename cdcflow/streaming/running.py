"""The total of each word so far at every word of a stream, with the totals of a bucket of words as state.

A task first puts the places of each word of a batch of lines into one row, so a frequent word is shuffled as a few rows and not
as one for each time it occurs. Words are dealt to a fixed number of buckets, as most words are rare and a state of its own for each
would cost far more than its few rows. A bucket's state holds the totals of its words. Within a micro-batch words are numbered in
the order of lines and places, whatever tasks read them; micro-batches follow one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators.text import word_rows

_PLACES = "word string, lines array<bigint>, places array<int>"
_ROWS_OUT = 50_000
# Fixed value: the state of a stream is kept by bucket.
_BUCKETS = 4_096


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("word").aggregate([("line", "list"), ("pos", "list")])
        yield from table.select(["word", "line_list", "pos_list"]).rename_columns(["word", "lines", "places"]).to_batches()


def _kept(totals: pd.Series) -> bytes:
    """Totals by word as bytes."""
    table = pa.table({"word": pa.array(totals.index, pa.string()), "n": pa.array(totals.to_numpy(), pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _totals(kept: bytes) -> pd.Series:
    table = pa.ipc.open_stream(kept).read_all()
    return pd.Series(table["n"].to_numpy(), index=pd.Index(table["word"].to_pylist(), dtype=object))


def _number(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    words, lines, places = [], [], []
    for part in parts:
        words += list(part["word"])
        lines += list(part["lines"])
        places += list(part["places"])
    codes, names = pd.factorize(np.array(words, dtype=object))
    code = np.repeat(codes, [len(some) for some in lines])
    line, place = np.concatenate(lines).astype(np.int64), np.concatenate(places).astype(np.int32)
    order = np.lexsort((place, line, code))
    counts = np.bincount(code, minlength=len(names))
    before = _totals(bytes(state.get[0])) if state.exists else pd.Series([], index=pd.Index([], dtype=object), dtype=np.int64)
    earlier = before.reindex(names, fill_value=0).to_numpy()
    after = pd.Series(earlier + counts, index=pd.Index(names, dtype=object))
    state.update((_kept(pd.concat([before.drop(names, errors="ignore"), after])),))
    starts = np.cumsum(counts) - counts
    for start in range(0, len(order), _ROWS_OUT):
        some = order[start : start + _ROWS_OUT]
        word = code[some]
        n = earlier[word] + np.arange(start, start + len(some)) - starts[word] + 1
        yield pd.DataFrame({"line": line[some], "pos": place[some], "word": names[word], "n": n})


def running_words(lines: DataFrame, text: str, line_id: str) -> DataFrame:
    """``line_id``, pos, word, n for each word of a stream of lines; ``line_id`` is a whole number and not null."""
    tokens = word_rows(lines, text, [line_id]).selectExpr(f"cast(`{line_id}` as bigint) line", "pos", "word")
    grouped = tokens.mapInArrow(_by_word, _PLACES).withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(_BUCKETS))).groupBy("bucket")
    counted = grouped.applyInPandasWithState(_number, "line bigint, pos int, word string, n bigint", "totals binary", "append", "NoTimeout")
    kept = lines.schema[line_id].dataType
    return counted.withColumn("line", counted["line"].cast(kept if isinstance(kept, T.IntegralType) else "bigint")).withColumnRenamed("line", line_id)
