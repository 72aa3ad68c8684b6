"""Word counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.text import split_words
from cdcflow.operators.ordered import block, running_sum

# About how many bytes of text are numbered at once, and how many rows come out in one batch.
_AT_ONCE, _OUT_ROWS = 1 << 23, 1 << 16
_COARSE, _CHUNK, _TEXT, _COUNT, _BEFORE = "_coarse", "_chunk", "_text", "_count", "_before"
# The bytes that split_words leaves: ASCII word characters.
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", np.uint8)] = True


def word_rows(lines: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """One row per token with its place in the line; works on batch and streaming frames."""
    return lines.select(*(keep or []), F.posexplode(split_words(F.col(text))).alias("pos", "word")).where(
        F.length("word") > 0
    )


def word_count(lines: DataFrame, text: str) -> DataFrame:
    """Total per word; partial counts are taken before the shuffle."""
    tokens = lines.select(F.explode(split_words(F.col(text))).alias("word")).where(F.length("word") > 0)
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def _words(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """The parts of lower-cased lines that ``split_words`` gives, without the empty ones: line, place in it, word."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets.astype(np.int64) - offsets[0]
    inside = _WORD_BYTES[data]
    apart = np.ones(len(data) + 1, bool)  # nothing joins a byte to the one before
    apart[1:-1] = ~inside[:-1]
    apart[offsets] = True
    begin = np.flatnonzero(inside & apart[:-1])
    apart[:-1] |= ~np.append(inside, False)[:-1]
    end = np.flatnonzero(inside & apart[1:]) + 1
    line = np.searchsorted(offsets, begin, "right") - 1
    number = np.bincount(line, minlength=len(text))
    # A line that starts with a separator has an empty part before its first word.
    place = np.arange(len(line)) - (np.cumsum(number) - number)[line] + ~inside[offsets[line]]
    ends = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    return line, place, pa.StringArray.from_buffers(len(line), pa.py_buffer(ends), pa.py_buffer(data[inside]))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``_AT_ONCE`` bytes of text, a line at least."""
    for batch in batches:
        if batch.num_rows:
            part = np.cumsum(pc.binary_length(batch.column(_TEXT)).to_numpy(zero_copy_only=False)) // _AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                yield batch.slice(a, b - a)


def _keys(chunk: np.ndarray, line: np.ndarray, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """A number for each word's chunk and spelling; the first line of each chunk; the spellings."""
    encoded = words.dictionary_encode()
    first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    number = np.searchsorted(first, line, "right") - 1
    return number * len(encoded.dictionary) + encoded.indices.to_numpy(), first, encoded.dictionary


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines sorted by chunk to one row for each word and chunk."""
    held: list[pa.Table] = []

    def total(parts: list[pa.Table]) -> pa.Table:
        if len(parts) == 1:
            return parts[0]
        summed = pa.concat_tables(parts).group_by(["word", _CHUNK]).aggregate([(_COUNT, "sum")])
        return pa.table({"word": summed["word"], _CHUNK: summed[_CHUNK], _COUNT: summed[f"{_COUNT}_sum"]})

    for batch in _slices(batches):
        chunk = batch.column(_CHUNK).to_numpy()
        line, _, words = _words(batch.column(_TEXT))
        key, first, spelling = _keys(chunk, line, words)
        counts = np.bincount(key, minlength=len(first) * len(spelling)) if len(key) else np.zeros(0, np.int64)
        found = np.flatnonzero(counts)
        of, code = np.divmod(found, max(1, len(spelling)))
        rows = pa.table({"word": spelling.take(pa.array(code)), _CHUNK: chunk[first[of]], _COUNT: counts[found]})
        # The last chunk may go on in the next slice.
        if held and held[0][_CHUNK][0].as_py() != chunk[0]:
            yield from total(held).combine_chunks().to_batches(max_chunksize=_OUT_ROWS)
            held = []
        split = np.searchsorted(of, len(first) - 1)
        if len(first) > 1:
            begun = np.searchsorted(of, 1)
            yield from total([*held, rows.slice(0, begun)]).combine_chunks().to_batches(max_chunksize=_OUT_ROWS)
            yield from rows.slice(begun, split - begun).combine_chunks().to_batches(max_chunksize=_OUT_ROWS)
            held = []
        held = [part for part in (*held, rows.slice(split)) if part.num_rows]
        if len(held) > 8:
            held = [total(held)]
    if held:
        yield from total(held).combine_chunks().to_batches(max_chunksize=_OUT_ROWS)


def _number(lines: pa.Table, line_id: str, alike: np.ndarray) -> tuple[pa.Table, pa.Table]:
    """The count of each word so far within its chunk, on top of what came before; and the totals in the last chunk."""
    chunk, before = lines[_CHUNK].to_numpy(), lines[_BEFORE].fill_null(0).to_numpy()
    line, place, words = _words(lines[_TEXT].combine_chunks())
    key, first, spelling = _keys(chunk, line, words)
    if alike.any():  # words of lines that share an id follow one another by their place
        shared = np.cumsum(np.append(0, ~alike))
        order = np.lexsort((place, shared[line], key))
    else:
        order = np.argsort(key, kind="stable")
    # A count from before is one word of one line.
    ahead = before[line]
    value, key = np.where(ahead > 0, ahead, 1)[order], key[order]
    so_far = np.cumsum(value)
    start = np.flatnonzero(np.diff(key, prepend=-1))
    size = np.diff(np.append(start, len(key)))
    so_far -= np.repeat(so_far[start] - value[start], size)
    n = np.empty(len(key), np.int64)
    n[order] = so_far
    kept = np.flatnonzero(ahead == 0)
    rows = pa.table(
        {
            "word": words.take(pa.array(kept)),
            line_id: lines[line_id].combine_chunks().take(pa.array(line[kept])),
            "pos": place[kept].astype(np.int32),
            "n": n[kept],
        }
    )
    last = (len(first) - 1) * len(spelling)
    end = (start + size - 1)[key[start] >= last]
    totals = {
        _CHUNK: np.full(len(end), chunk[-1]),
        line_id: pa.nulls(len(end), lines.schema.field(line_id).type),
        _TEXT: spelling.take(pa.array(key[end] - last)),
        _BEFORE: so_far[end],
    }
    return rows, pa.table([totals[f.name] for f in lines.schema], schema=lines.schema)


def _number_words(line_id: str):
    """Sorted lines, each chunk's counts from before ahead of them, to a row for each word.

    Holds a slice of lines, the lines that share an id, and the totals of one chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def alike(lines: pa.Table) -> np.ndarray:
            same = ~lines[_BEFORE].is_valid().to_numpy()
            same = same[1:] & same[:-1]
            for name in (_CHUNK, line_id):
                values = lines[name].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                same &= values[1:] == values[:-1]
            return same

        for batch in _slices(batches):
            lines = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
            same = alike(lines)
            # More lines of the last id may come.
            other = np.flatnonzero(~same)
            cut = int(other[-1]) + 1 if len(other) else 0
            held = [lines.slice(cut)]
            if cut:
                rows, totals = _number(lines.slice(0, cut), line_id, same[: cut - 1])
                yield from rows.combine_chunks().to_batches(max_chunksize=_OUT_ROWS)
                if lines[_CHUNK][cut].as_py() == lines[_CHUNK][cut - 1].as_py():
                    held.insert(0, totals)
        if held:
            lines = pa.concat_tables(held).combine_chunks()
            yield from _number(lines, line_id, alike(lines))[0].combine_chunks().to_batches(max_chunksize=_OUT_ROWS)

    return run


def running_word_count(lines: DataFrame, text: str, line_id: str, lines_per_chunk: int = 1_000) -> DataFrame:
    """The count of each word so far, at every occurrence, in line and token order.

    The lines are cut into chunks along their ids. A word's count in the chunks before is worked out on one row for each
    word and chunk and goes ahead of the chunk's lines, which are numbered in order, slice by slice. So lines are
    shuffled, and not each of their words. Ids must not be null.
    """
    chunk = block(F.col(line_id), lines_per_chunk).alias(_CHUNK)
    lower = F.lower(text).alias(_TEXT)
    counted = (
        lines.where(F.col(line_id).isNotNull() & F.col(text).isNotNull())
        .select(chunk, lower)
        .repartition(_CHUNK)
        .sortWithinPartitions(_CHUNK)
        .mapInArrow(_count_words, f"word string, {_CHUNK} bigint, {_COUNT} bigint")
    )
    # Dealt and filtered here, so that both uses of the counts share one shuffle and the words are counted once.
    coarse = block(F.col(_CHUNK), lines_per_chunk)
    per_chunk = counted.repartition("word", coarse).withColumn(_COARSE, coarse).where(F.col("word").isNotNull() & F.col(_COARSE).isNotNull())
    earlier = running_sum(per_chunk, ["word"], [_COARSE], [_CHUNK], F.col(_COUNT), _BEFORE, inclusive=False)
    id_type = lines.schema[line_id].dataType
    ahead = earlier.where(F.col(_BEFORE) > 0).select(_CHUNK, F.lit(None).cast(id_type).alias(line_id), F.col("word").alias(_TEXT), _BEFORE)
    lost = F.exists(split_words(F.col(text)), lambda w: F.length(w) > 0)
    error = F.raise_error(F.lit(f"null in {line_id}")).cast("boolean")
    whole = lines.where(F.when(F.col(line_id).isNotNull(), F.col(text).isNotNull()).when(lost, error))
    here = whole.select(chunk, line_id, lower, F.lit(None).cast("bigint").alias(_BEFORE))
    dealt = here.union(ahead).repartition(_CHUNK).sortWithinPartitions(_CHUNK, F.col(_BEFORE).isNull(), line_id)
    return dealt.mapInArrow(_number_words(line_id), f"word string, {line_id} {id_type.simpleString()}, pos int, n bigint")
