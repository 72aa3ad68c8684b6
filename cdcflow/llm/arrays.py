"""Texts of an Arrow column as byte arrays, their words and word n-grams as 64-bit hashes, all without a loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM_FACTORS = [pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(16)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, modulo 2**64, of the hash's base and of its inverse."""
    if len(_powers["up"]) < n:
        size = max(n, STEP_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins in them (one more entry than texts); null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A column's texts in runs of about ``limit`` bytes: first row, end row, bytes, offsets. A longer text is a run of its own."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Entry i covers the first i bytes; ``span_hashes`` takes any span's hash from them."""
    up, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal spans have equal hashes wherever they stand."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word (a run of bytes other than ASCII white space, within one text) begins and ends."""
    n = len(data)
    solid = np.zeros(n + 1, bool)
    np.logical_not(_SPACE[data], out=solid[:n])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = solid[:-1]
    return np.flatnonzero(solid & (edge | ~before)), np.flatnonzero(before & (edge | ~solid))


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z read as a-z, and where each text's words begin."""
    starts, ends = word_spans(data, offsets)
    return span_hashes(prefix_hashes(fold(data)), starts, ends), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` words in a row, and where each text's begin. A text of fewer words has one, of all its words."""
    count = np.diff(at)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_at = np.concatenate([[0], np.cumsum(made)])
    if not len(hashes):
        return np.zeros(0, np.uint64), out_at
    first = np.arange(out_at[-1]) - np.repeat(out_at[:-1], made) + np.repeat(at[:-1], made)
    end = np.repeat(at[1:], made)
    total = np.zeros(len(first), np.uint64)
    for i in range(n):
        there = first + i < end
        total += np.where(there, hashes[np.minimum(first + i, len(hashes) - 1)] + np.uint64(1), np.uint64(0)) * np.uint64(_GRAM_FACTORS[i])
    return mix(total), out_at


def segment_reduce(ufunc: np.ufunc, values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    """One value for each segment; ``empty`` where it holds nothing."""
    out = np.full(len(at) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = ufunc.reduceat(values, at[full])
    return out
