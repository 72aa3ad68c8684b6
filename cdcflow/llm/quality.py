"""A byte-level convolutional network in numpy that gives a whole text one probability.

A text's bytes are cut into overlapping chunks that cover all of it. Each byte has a learned vector; learned filters slide over
a chunk two bytes at a time, and each filter's greatest response counts (max-pooling). The chunks' responses are averaged and
their maximum taken over the text, and one linear layer makes the probability.

Training takes a bounded sample: at most ``SAMPLE_ROWS`` labelled texts of each label, those with the least hash of their id,
and at most ``TRAIN_CHUNKS`` random chunks of each in a step. Scoring reads every byte of every text. The model is a few
thousand numbers, whatever the input.

Nulls and odd rows: a null or empty text is one chunk of padding; ids may be null or repeat; rows with a null label don't
train; with labels of one kind or none, all scores are 0.5; other columns are ignored; an empty frame gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.arrays import steps
from cdcflow.llm.frames import pick, tidy

CHUNK, HOP = 256, 192
EMBEDDING, FILTERS, TAPS = 8, 16, 4  # a tap is two bytes
SAMPLE_ROWS = 1500
TRAIN_CHUNKS = 12
EPOCHS = 8
_BLOCK = 64


class Model(NamedTuple):
    embedding: np.ndarray  # 257 x EMBEDDING; the last is padding
    filters: np.ndarray  # TAPS x 2 EMBEDDING x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # 2 FILTERS
    intercept: float


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks of all texts (bytes, 256 beyond a text's end) and the text of each."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-(size - CHUNK) // HOP) + 1)
    of = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][of] + number * HOP
    left = offsets[1:][of] - start
    padded = np.concatenate([data, np.zeros(CHUNK, np.uint8)])
    out = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[np.minimum(start, len(data))].astype(np.uint16)
    short = np.flatnonzero(left < CHUNK)
    out[short] = np.where(np.arange(CHUNK) < left[short][:, None], out[short], 256)
    return out, of


def _responses(model: Model, block: np.ndarray) -> np.ndarray:
    """chunks x positions x filters, before the bias."""
    pairs = model.embedding[block].reshape(len(block) * (CHUNK // 2), 2 * EMBEDDING)
    taps = (pairs @ np.concatenate(list(model.filters), axis=1)).reshape(len(block), CHUNK // 2, TAPS, FILTERS)
    n = CHUNK // 2 - TAPS + 1
    total = taps[:, :n, 0]
    for k in range(1, TAPS):
        total = total + taps[:, k : k + n, k]
    return total


def pooled(model: Model, made: np.ndarray) -> np.ndarray:
    """Each chunk's greatest response of each filter."""
    out = np.empty((len(made), FILTERS), np.float32)
    for i in range(0, len(made), _BLOCK):
        out[i : i + _BLOCK] = _responses(model, made[i : i + _BLOCK]).max(axis=1)
    return np.maximum(out + model.bias, 0)


def _features(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Mean and maximum over each text's chunks; ``of`` is sorted and names every text."""
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    count = np.diff(np.append(starts, len(of)))[:, None]
    return np.concatenate([np.add.reduceat(values, starts) / count, np.maximum.reduceat(values, starts)], axis=1)


def probabilities(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    made, of = chunks(data, offsets)
    z = _features(pooled(model, made), of) @ model.weights + model.intercept
    return 1 / (1 + np.exp(-z.astype(np.float64)))


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 3, epochs: int = EPOCHS, batch: int = 64) -> Model:
    """Gradient descent with Adam on the log loss, labels weighted equally. The same sample gives the same model."""
    draw = np.random.default_rng(seed)
    p = {
        "embedding": draw.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32),
        "filters": draw.normal(0, 0.25, (TAPS, 2 * EMBEDDING, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "weights": draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "intercept": np.zeros(1, np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    made = []
    for text in texts:
        raw = np.frombuffer(text, np.uint8)
        made.append(chunks(raw, np.array([0, len(raw)]))[0])
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            chosen = [made[r] if len(made[r]) <= TRAIN_CHUNKS else made[r][np.sort(draw.choice(len(made[r]), TRAIN_CHUNKS, replace=False))] for r in rows]
            of = np.repeat(np.arange(len(rows)), [len(c) for c in chosen])
            step += 1
            _adam(p, _gradients(p, np.concatenate(chosen), of, labels[rows], weight[rows]), moments, step)
    return Model(p["embedding"], p["filters"], p["bias"], p["weights"], float(p["intercept"][0]))


def _gradients(p: dict, block: np.ndarray, of: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
    model = Model(p["embedding"], p["filters"], p["bias"], p["weights"], 0.0)
    best = np.empty((len(block), FILTERS), np.int64)
    raw = np.empty((len(block), FILTERS), np.float32)
    for i in range(0, len(block), _BLOCK):
        response = _responses(model, block[i : i + _BLOCK])
        best[i : i + _BLOCK] = response.argmax(axis=1)
        raw[i : i + _BLOCK] = response.max(axis=1)
    value = np.maximum(raw + p["bias"], 0)
    x = _features(value, of)
    z = x @ p["weights"] + p["intercept"]
    error = ((1 / (1 + np.exp(-z)) - label) * weight / len(label)).astype(np.float32)
    dx = error[:, None] * p["weights"][None, :]
    count = np.bincount(of)
    top = value == x[of, FILTERS:]
    ties = np.zeros((len(label), FILTERS), np.float32)
    np.add.at(ties, of, top)
    dvalue = dx[of, :FILTERS] / count[of][:, None] + dx[of, FILTERS:] * top / np.maximum(ties, 1)[of]
    dvalue *= raw + p["bias"] > 0
    # Only the window of each filter's greatest response takes part.
    place = 2 * best[:, :, None] + np.arange(2 * TAPS)
    window = np.take_along_axis(block[:, None, :], place.reshape(len(block), 1, -1), axis=2).reshape(len(block), FILTERS, 2 * TAPS)
    vectors = p["embedding"][window].reshape(len(block), FILTERS, TAPS, 2 * EMBEDDING)
    dfilters = np.einsum("cf,cfte->tef", dvalue, vectors)
    dvectors = (dvalue[:, :, None, None] * p["filters"].transpose(2, 0, 1)[None]).reshape(-1, EMBEDDING)
    dembedding = np.stack([np.bincount(window.ravel(), dvectors[:, e], 257) for e in range(EMBEDDING)], axis=1)
    return {
        "embedding": dembedding.astype(np.float32),
        "filters": dfilters,
        "bias": dvalue.sum(axis=0),
        "weights": x.T @ error + 1e-4 * p["weights"],
        "intercept": np.array([error.sum()], np.float32),
    }


def _adam(p: dict, gradients: dict, moments: dict, step: int, rate: float = 0.01) -> None:
    for name, g in gradients.items():
        m, v = moments[name]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from at most ``sample_rows`` labelled texts of each label; None unless there are both labels.

    ``labels`` holds the rows that may be learned from.
    """
    named = pick(labels, id=id_col, label=label_col).where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).dropDuplicates(["id"])
    by_hash = [F.xxhash64(F.lit(17), "id"), F.col("id")]
    chosen = [r for label in (0, 1) for r in named.where(F.col("label") == label).orderBy(*by_hash).limit(sample_rows).collect()]
    label_of = {r["id"]: r["label"] for r in chosen}
    if len(set(label_of.values())) < 2:
        return None
    base = pick(docs, id=id_col, text=text_col)
    ids = docs.sparkSession.createDataFrame([(i,) for i in label_of], docs.select(docs[id_col].alias("id")).schema)
    rows = base.join(F.broadcast(ids), "id").collect()  # at most two samples
    rows = sorted({(r["id"], (r["text"] or "").encode()) for r in rows})
    found = np.array([label_of[i] for i, _ in rows])
    if len(set(found.tolist())) < 2:
        return None
    return fit([text for _, text in rows], found)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """row (the input row) and score for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                made = np.full(batch.num_rows, 0.5)
            else:
                made = np.concatenate([np.zeros(0), *[probabilities(model, data, at) for _, _, data, at in steps(batch.column("text"), 1 << 20)]])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made)], ["row", "score"])

    given = docs.select(F.struct("*").alias("row"), docs[text_col].alias("text"))
    return given.mapInArrow(tidy(run), f"row {given.schema['row'].dataType.simpleString()}, score double")
