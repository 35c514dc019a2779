"""Words and hashes of whole texts, computed on Arrow string buffers without a loop over words.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Hashes have 64 bits: byte values and
positions are weighted by fixed random odd numbers, so the same word has the same hash in
every task. Texts are handled in chunks of about ``CHUNK_BYTES``, which bounds the arrays made of them (up to
some hundred bytes a byte of text); a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 1 << 20

_random = np.random.Generator(np.random.PCG64(20250101))
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = int(_random.integers(1, 2**62)) * 2 + 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# Texts vary from a few bytes to many megabytes, so Arrow batches are bounded by bytes, not by rows alone.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches; the memory of executors and their Python workers follows them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the offsets of each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of texts of about ``limit`` bytes."""
    if not len(texts):
        return
    data, ends = string_buffers(texts)
    row, last = 0, len(ends) - 1
    while row < last:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


@dataclass
class Runs:
    """Runs of bytes (words or lines) of a chunk, in order: ``first[d]:first[d+1]`` belong to text ``d``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _powers(count: int) -> np.ndarray:
    steps = np.full(max(count, 1), _STEP & (2**64 - 1), np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS = _powers(1 << 16)


def split_runs(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray, lower: bool = False) -> Runs:
    """Maximal runs of ``solid`` bytes that cross no text boundary, with their hashes."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opened = solid.copy()
    opened[1:] &= ~solid[:-1] | edge[1:-1]
    closed = solid.copy()
    closed[:-1] &= ~solid[1:] | edge[1:-1]
    start, end = np.flatnonzero(opened), np.flatnonzero(closed) + 1
    sizes = end - start
    at = np.cumsum(sizes) - sizes
    values = (_BYTE_VALUE[LOWER] if lower else _BYTE_VALUE)[data[solid]]
    longest = int(sizes.max(initial=0))
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    values *= powers[np.arange(len(values)) - np.repeat(at, sizes)]
    hashes = mix(np.add.reduceat(values, at)) if len(at) else np.zeros(0, np.uint64)
    return Runs(start, end, np.searchsorted(start, offsets), hashes)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Runs:
    return split_runs(data, offsets, ~IS_SPACE[data], lower)


def shingles(run_hash: np.ndarray, first: np.ndarray, width: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, and the offsets of each text's windows.

    With ``whole``, a text of fewer words (but one at least) has its whole sequence as one window.
    """
    counts = np.diff(first)
    windows = np.maximum(counts - width + 1, 0)
    if whole:
        windows[(counts > 0) & (counts < width)] = 1
    at = np.concatenate([[0], np.cumsum(windows)])
    begin = np.arange(at[-1]) - np.repeat(at[:-1], windows) + np.repeat(first[:-1], windows)
    room = np.repeat(first[1:], windows) - begin
    out = np.zeros(len(begin), np.uint64)
    padded = np.concatenate([run_hash, np.zeros(width, np.uint64)])
    for j in range(width):
        part = padded[begin + j] * _PLACE[j]
        if whole:
            part[room <= j] = 0
        out += part
    short = np.minimum(room, width).astype(np.uint64)
    return mix(out + short * _PLACE[63]), at
