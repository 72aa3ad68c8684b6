"""Removal of lines and passages that repeat across documents, by hashes of normalised words.

A text is cut at line ends, within lines at sentence ends and before words with a capital, and, where ``WINDOW`` words in a row
have no such place, at the least hash of the next ``GRAM`` words among them. All but the line and sentence ends at a passage's
edges depend on its own words, so it has the same cuts wherever it stands; up to ``WINDOW`` + ``GRAM`` words at an edge that is
no line or sentence end may stay.

Two kinds of units are compared. A passage runs from cut to cut and is the shortest with ``min_words`` words that begins or
ends there, so longer ones are unions of such. A shorter line counts as a whole, however short. A unit's digest covers its words
(A-Z as a-z, white space ignored). The occurrence of the least id, earliest in its document, is the original; all others are
removed. In scripts without spaces between words each character is a word, of which two count as one towards ``min_words``.
Removed spans keep their byte offsets in the original text; those with only white space between them are one span.

Only digests and counts of all units are shuffled first; units whose digest occurs once go no further. Counts are taken before
the shuffle. The most frequent units, a fixed number of them, are marked by broadcast, so no task gets all rows of one; their
originals, one row for each, are taken out of the documents' sets of spans. A span travels as one number.

Nulls and odd rows: a null text is empty and stays null; null ids rank last; rows equal in id and text count as one document;
an empty frame gives an empty result; other columns stay in the struct ``row``, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.arrays import fold, mix, powers, prefix_hashes, span_hashes, steps, word_spans
from cdcflow.llm.frames import pick, saved, text_key, tidy

MIN_WORDS = 20
#: Any so many words in a row have a cut, chosen by the hashes of so many words from there on. A passage of
#: ``MIN_WORDS + 2 * WINDOW + GRAM - 1`` words is found wherever it stands.
WINDOW, GRAM = 12, 3
#: Of so many of the most frequent units, the rows stay where they are and their owners are sent to them. Any other unit has less
#: than one row in so many.
HOT_UNITS = 1000
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?")] = True
_FACTORS = [np.uint64(x | 1) for x in (0x9FB21C651E98DF24, 0xC2B2AE3D27D4EB4E, 0x165667B19E3779F8)]


def find_units(data: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """The units of some texts: text, start, end (bytes within it), h1, h2, inner (repeats an earlier unit of its own text)."""
    starts, ends, alone = _words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {k: none for k in ("text", "start", "end", "h1", "h2")} | {"inner": np.zeros(0, bool)}
    text = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    line = np.ones(len(starts), bool)
    line[1:] = (text[1:] != text[:-1]) | (breaks[starts[1:]] != breaks[ends[:-1]])
    new = line.copy()
    new[1:] |= _SENTENCE_END[data[ends[:-1] - 1]] | _capital(data, starts[1:])
    word = span_hashes(prefix_hashes(fold(data)), starts, ends)
    new[_content_cuts(word, text, new)] = True

    # Half words before each word, and the units as first word and end.
    halves = np.concatenate([[0], np.cumsum(np.where(alone, 1, 2))])
    cut, least = np.append(np.flatnonzero(new), len(starts)), 2 * min_words
    at = halves[cut]
    begin = np.arange(len(cut) - 1)
    forward = np.stack([begin, np.maximum(np.searchsorted(at, at[:-1] + least), begin + 1)])
    stop = begin + 1
    backward = np.stack([np.minimum(np.searchsorted(at, at[1:] - least, "right") - 1, stop - 1), stop])
    i, j = np.concatenate([forward, backward], axis=1)
    fits = (i >= 0) & (j < len(cut))
    i, j = i[fits], j[fits]
    inside = text[cut[i]] == text[cut[j] - 1]
    i, j = np.divmod(np.unique(i[inside] * len(cut) + j[inside]), len(cut))
    row = np.append(np.flatnonzero(line), len(starts))
    short = np.flatnonzero(np.diff(halves[row]) < least)
    first, end = np.concatenate([cut[i], row[short]]), np.concatenate([cut[j], row[short + 1]])

    digests = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        up, down = powers(len(word) + 1)
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(mix(word ^ np.uint64(salt)) * up[:-1], out=total[1:])
        digests.append(mix((total[end] - total[first]) * down[first]).view(np.int64))
    h1, h2 = digests[0], digests[1].astype(np.int32)
    of = text[first]
    order = np.lexsort((first, h2, h1, of))
    again = np.zeros(len(first), bool)
    a, b = order[1:], order[:-1]
    again[a] = (of[a] == of[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
    return {"text": of, "start": starts[first] - offsets[of], "end": ends[end - 1] - offsets[of], "h1": h1, "h2": h2, "inner": again}


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and whether it is one character of a script without spaces between words."""
    starts, ends = word_spans(data, offsets)
    if not len(starts) or data.max() < 0xE0:
        return starts, ends, np.zeros(len(starts), bool)
    following = np.append(data[1:], np.uint8(0))
    between = lambda lo, hi: (following >= lo) & (following <= hi)
    single = (data >= 0xE3) & (data <= 0xE9)  # kana, Han
    single |= (data == 0xE0) & between(0xB8, 0xBB) | (data == 0xE1) & (between(0x80, 0x82) | between(0x9E, 0x9F))  # Thai, Lao, Burmese, Khmer
    single |= (data == 0xEF) & (between(0xA4, 0xAB) | between(0xBC, 0xBE)) | (data == 0xF0) & between(0xA0, 0xB3)  # Han, wide forms
    if not single.any():
        return starts, ends, np.zeros(len(starts), bool)
    leads = np.flatnonzero(single)
    begin = np.unique(np.concatenate([starts, leads, leads + np.where(data[leads] == 0xF0, 4, 3)]))
    within = np.searchsorted(starts, begin, "right") - 1
    begin, within = begin[begin < ends[within]], within[begin < ends[within]]
    return begin, np.minimum(np.append(begin[1:], len(data)), ends[within]), single[begin]


def _content_cuts(word: np.ndarray, text: np.ndarray, new: np.ndarray) -> np.ndarray:
    """In each ``WINDOW`` words without a cut, the last with the least hash of the ``GRAM`` words from there on."""
    count = np.concatenate([[0], np.cumsum(new)])
    bare = np.flatnonzero(count[WINDOW:] == count[:-WINDOW])
    if not len(bare):
        return bare
    gram = np.zeros(len(word), np.uint64)
    for k in range(GRAM):
        there = text[k:] == text[: len(text) - k]
        gram[: len(word) - k] += np.where(there, word[k:] * _FACTORS[k], np.uint64(0))
    around = np.lib.stride_tricks.sliding_window_view(mix(gram), WINDOW)
    return np.unique(np.concatenate([at + WINDOW - 1 - around[at, ::-1].argmin(axis=1) for at in np.array_split(bare, len(bare) // 100_000 + 1)]))


def _capital(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a capital (A-Z or Latin-1) and then no other A-Z begin at a byte; words all in capitals don't count."""
    first, second, third = (data[np.minimum(at + k, len(data) - 1)] for k in range(3))
    plain, accented = (first >= 65) & (first <= 90), (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    after = np.where(accented, third, second)
    return (plain | accented) & (after >= 97)


def _units(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in steps(batch.column("text")):
                found = find_units(data, offsets, min_words)
                rows = pa.array(found["text"] + row)
                place = (found["start"] << 32) | (found["end"] << 1) | found["inner"]
                columns = [batch.column("id").take(rows), batch.column("key").take(rows), *map(pa.array, (place, found["h1"], found["h2"]))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "place", "h1", "h2"])

    return run


def joined_spans(places: list[int], raw: bytes) -> list[tuple[int, int]]:
    """The byte spans of places in order, as one where they overlap or have only white space between them."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted((p >> 32, (p & 0xFFFFFFFF) >> 1) for p in places):
        if joined and (start <= joined[-1][1] or not raw[joined[-1][1] : start].strip()):
            joined[-1] = (joined[-1][0], max(joined[-1][1], end))
        else:
            joined.append((start, end))
    return joined


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = [], []
        for text, units in zip(batch.column("text").to_pylist(), batch.column("units").to_pylist(), strict=True):
            gone = []
            if units:
                raw, at, kept = text.encode(), 0, []
                gone = joined_spans(units, raw)
                for start, end in gone:
                    kept.append(raw[at:start])
                    at = end
                text = b"".join([*kept, raw[at:]]).decode()
            texts.append(text)
            spans.append([{"start": a, "end": b} for a, b in gone])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, span)], ["row", "kept", "removed"])


def _inner() -> Column:
    """Whether a unit repeats an earlier one of its own text, the last bit of ``place``, which also holds its start and end."""
    return F.col("place").bitwiseAND(F.lit(1)) == 1


def _owner() -> Column:
    """The document that keeps a unit: the one with the least id."""
    return F.min(F.struct(F.col("id").isNull(), "id", "key"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, hot_units: int = HOT_UNITS) -> DataFrame:
    """row (the input row), kept (its text without repeated lines and passages), removed (array of start, end in bytes) for each row."""
    base = pick(docs, id=id_col, text=text_col)
    key = F.xxhash64("id", text_key("text"))
    id_type = base.schema["id"].dataType.simpleString()
    units = base.select("id", key.alias("key"), "text").mapInArrow(tidy(_units(min_words)), f"id {id_type}, key bigint, place bigint, h1 bigint, h2 int")
    counts = saved(units.where(~_inner()).groupBy("h1").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    hot = counts.orderBy(F.desc("n"), "h1").limit(hot_units).select("h1", F.lit(True).alias("hot"))
    # A hot unit is common whatever it meets, so its rows are dealt by themselves and not by their digest.
    dealt = units.join(F.broadcast(hot), "h1", "left").withColumn("by", F.when(F.col("hot"), F.xxhash64("key", "place")).otherwise(F.col("h1")))
    common = counts.select(F.col("h1").alias("by"), F.lit(True).alias("common"))
    shared = dealt.join(common, "by", "left").where(_inner() | F.col("hot") | F.col("common"))
    # The rows lie by ``by`` already, so the owners are found without another shuffle; those of hot units come after it.
    owner = _owner().over(Window.partitionBy("by", "h1", "h2"))["key"]
    shared = saved(shared.withColumn("owner", owner).where(_inner() | F.col("hot") | (F.col("key") != F.col("owner"))).drop("by", "common"), "units")
    spans = shared.select("key", "h1", "h2", "hot", _inner().alias("inner"), F.col("place").bitwiseAND(F.lit(-2)).alias("span"))
    # All rows of hot units but their owners' are repeats as well: these few, one for each unit, are given back to their documents.
    first = shared.where(F.col("hot") & ~_inner()).groupBy("h1", "h2").agg(_owner().alias("first")).select("h1", "h2", F.col("first.key").alias("key"))
    own = spans.where(F.col("hot") & ~F.col("inner")).join(F.broadcast(first), ["h1", "h2", "key"]).groupBy("key").agg(F.collect_set("span").alias("own"))
    by_doc = spans.groupBy("key").agg(F.collect_set("span").alias("units")).join(F.broadcast(own), "key", "left")  # of one document
    by_doc = by_doc.select("key", F.when(F.col("own").isNull(), F.col("units")).otherwise(F.array_except("units", "own")).alias("units"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(docs[id_col], text_key(docs[text_col])).alias("key"))
    joined = rows.join(by_doc, "key", "left").select("row", F.col(f"row.`{text_col}`").alias("text"), "units")  # the text is shuffled once
    row_type = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(tidy(_cut), f"row {row_type}, kept string, removed array<struct<start: bigint, end: bigint>>")
