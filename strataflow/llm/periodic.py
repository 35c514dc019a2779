"""Periodic runs of words: stretches that repeat one period at least four times.

Words are compared by 64-bit hashes. Periods of up to ``SHORT`` words are found by comparing the text with
itself at each lag. Longer ones are found scale by scale: at the scale ``s`` all windows of ``s`` words are
hashed (by doubling: a window is two of half the length), and positions whose hash is the least of some ``s / 2``
neighbours are its minimizers. Inside a run with a period in ``(s / 2, s]`` windows of ``s`` words are equal
exactly at multiples of the period, so a minimizer and its next equal one lie one period apart: every such
pair is extended in both directions, word by word. A run of four periods always holds such a pair.

Several texts are searched at once, parted by marks that equal nothing. Work is ``n log² n`` for n words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import Runs, bound_batches, chunks, mix, words

SHORT = 8
REPEATS = 4
LEAST_WORDS = 6
CHUNK_BYTES = 1 << 19

_MARK = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(0x9E3779B97F4A7C15)


def marked_words(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words in one row with a mark behind each text; ``first[t]:first[t + 1]`` are text ``t``'s words.

    Returns the row and the place of every text in it. Marks differ from each other and from all words
    but for collisions of 64 bits.
    """
    texts = len(first) - 1
    row = np.empty(len(hashes) + texts, np.uint64)
    starts = first[:-1] + np.arange(texts)
    at = np.ones(len(row), bool)
    at[starts + np.diff(first)] = False
    row[at] = hashes
    row[~at] = mix(np.arange(1, texts + 1, dtype=np.uint64) * _MARK)
    return row, starts


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True that have ``least`` entries."""
    edges = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], (end - start)[long]


def _primes(number: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= number:
        if number % factor == 0:
            found.append(factor)
            while number % factor == 0:
                number //= factor
        factor += 1
    return found + [number] * (number > 1)


def _is_smallest(row: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of the period is a period of the stretch too.

    A smaller period of four or more periods divides the period (Fine and Wilf); one period shows it.
    """
    for prime in _primes(period):
        lag = period // prime
        if np.array_equal(row[start:start + period], row[start + lag:start + lag + period]):
            return False
    return True


def _agree(left: np.ndarray, right: np.ndarray, step: int) -> int:
    """Length of the common prefix of two arrays, compared in growing blocks."""
    size, at = min(len(left), len(right)), 0
    while at < size:
        differ = left[at:at + step] != right[at:at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return size


def _extend(row: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` whose words are equal ``lag`` apart."""
    after = _agree(row[at:len(row) - lag], row[at + lag:], 2 * lag)
    before = _agree(row[:at][::-1], row[lag:at + lag][::-1], 2 * lag)
    return at - before, at + after + lag


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """Least (or greatest) value of each window of ``width`` entries, a power of two."""
    have = 1
    while have < width:
        values = least(values[:-have], values[have:])
        have *= 2
    return values


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is the least of some window of ``width`` entries; width is a power of two."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    lowest = _sliding(hashes, width, np.minimum)
    none = np.zeros(width - 1, hashes.dtype)
    return np.flatnonzero(_sliding(np.concatenate([none, lowest, none]), width, np.maximum) == hashes)


def find_runs(row: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All runs in ``row``: rows of (start in row, length, period). ``sizes`` and ``starts`` are the texts' in it."""
    found: set[tuple[int, int, int]] = set()

    def add(start: int, end: int, period: int) -> None:
        if end - start >= max(LEAST_WORDS, REPEATS * period) and _is_smallest(row, start, period):
            found.add((start, end - start, period))

    longest = int(sizes.max(initial=0)) // REPEATS  # no period is longer
    for lag in range(1, min(SHORT, longest) + 1):
        same = row[:-lag] == row[lag:]
        for start, length in zip(*_stretches(same, max(LEAST_WORDS, REPEATS * lag) - lag)):
            add(int(start), int(start + length) + lag, lag)

    scale = 2 * SHORT
    place, grams, own = np.arange(len(row)), row, np.repeat(np.arange(len(sizes)), sizes + 1)
    width = 1
    while scale // 2 < longest:
        # Only texts that have room for four periods of this scale go on.
        enough = sizes >= REPEATS * (scale // 2 + 1)
        keep = enough[own]
        if not keep.all():
            place, grams, own = place[keep], grams[keep], own[keep]
        while width < scale:
            joined = mix(grams[:-width] * _HALF + grams[width:])
            # Windows over the end equal nothing.
            grams = np.concatenate([joined, mix(np.arange(len(grams) - len(joined), dtype=np.uint64) + _MARK)])
            width *= 2
        chosen = minimizers(grams, scale // 2)
        order = np.argsort(grams[chosen], kind="stable")
        chosen = chosen[order]
        values = grams[chosen]
        lag = np.diff(chosen)
        pair = np.flatnonzero((values[1:] == values[:-1]) & (lag > scale // 2) & (lag <= scale))
        lag, at = lag[pair], place[chosen[pair]]
        order = np.lexsort((at, lag))
        done, done_lag = -1, -1
        for d, x in zip(lag[order].tolist(), at[order].tolist()):
            if d == done_lag and x < done:
                continue  # inside the stretch extended last
            start, end = _extend(row, x, d)
            done, done_lag = end - d, d
            add(start, end, d)
        scale *= 2
    return np.array(sorted(found, key=lambda run: (run[0], run[2])), np.int64).reshape(-1, 3)


def _dropped(size: int, runs: np.ndarray) -> np.ndarray:
    """Words that some run holds after its first period."""
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def joined_words(data: np.ndarray, found: Runs, chosen: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per text its chosen words with one space between: ``chosen[bounds[t]:bounds[t + 1]]`` are text ``t``'s."""
    size = found.end[chosen] - found.start[chosen] + 1
    ends = np.cumsum(size)
    begin = ends - size
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = data[np.repeat(found.start[chosen] - begin, size)[inside] + np.flatnonzero(inside)]
    edges = np.concatenate([[0], ends])[bounds]
    text = out.tobytes()
    return pa.array([text[a:max(a, b - 1)].decode("utf-8") for a, b in zip(edges, edges[1:])], pa.string())


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]
    for batch in batches:
        for first_row, data, offsets in chunks(batch["text"], CHUNK_BYTES):
            found = words(data, offsets)
            row, starts = marked_words(found.hash, found.first)
            sizes = np.diff(found.first)
            runs = find_runs(row, sizes, starts)
            text = np.searchsorted(starts, runs[:, 0], "right") - 1
            kept = ~_dropped(len(row), runs)
            kept[starts + sizes] = False  # the marks
            running = np.concatenate([[0], np.cumsum(kept)])
            bounds = np.append(running[starts], running[-1])
            chosen = np.flatnonzero(kept)
            chosen -= np.searchsorted(starts, chosen, "right") - 1
            values = [pa.array(x) for x in (runs[:, 0] - starts[text], runs[:, 1], runs[:, 2])]
            at = pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)).astype(np.int32))
            yield pa.record_batch(
                [batch["doc_id"].slice(first_row, len(sizes)),
                 pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(values, fields=fields)),
                 joined_words(data, found, chosen, bounds)],
                names=["doc_id", "runs", "collapsed"])


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row of ``docs (doc_id, text)``.

    ``runs`` lists ``start, length, period`` in words, by start, then period: maximal stretches with that smallest
    period that hold it four times and six words at least. ``collapsed`` are the words that no run holds behind its
    first period, with one space between. Null, empty and blank texts have no runs and collapse to the empty
    text; rows that repeat and null ids are kept as they are, other columns are ignored, and an empty table
    gives no rows. A text is searched as a whole, whatever its length: memory is about 60 times its words
    in bytes, beside the text itself.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_collapse, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first_row, data, offsets in chunks(batch["text"], CHUNK_BYTES):
            found = words(data, offsets)
            sizes = np.diff(found.first)
            code = batch["code"].slice(first_row, len(sizes))
            planted = pc.fill_null(pc.equal(pc.subtract(code, pc.multiply(pc.divide(code, 10), 10)), 0), False)
            planted = planted.to_numpy(zero_copy_only=False) & (sizes > 0)
            g = pc.fill_null(pc.divide(code, 10), 0).to_numpy()
            a = g % np.maximum(sizes, 1)
            p = 1 + (sizes - a) // (3 + g % 8)
            # Word i of a planted text is its word a + (i - a) % p from a on.
            text = found.text
            i = np.arange(len(found.start)) - found.first[text]
            moved = planted[text] & (i >= a[text])
            source = np.where(moved, a[text] + (i - a[text]) % p[text], i) + found.first[text]
            out = joined_words(data, found, source, found.first)
            own = batch["text"].slice(first_row, len(sizes))
            yield pa.record_batch(
                [batch["doc_id"].slice(first_row, len(sizes)), pc.if_else(pa.array(planted), out, own)], names=["doc_id", "text"])


def with_planted_runs(docs: DataFrame, code: Column) -> DataFrame:
    """``doc_id, text`` where some texts get a periodic tail: those whose ``code`` (a non-negative number) 10 divides.

    With ``g = code / 10`` and n words, the words from ``g % n`` on repeat the first ``1 + (n - g % n) / (3 + g % 8)`` of
    them (whole division). Other texts, and those without words or code, stay as they are.
    """
    bound_batches(docs.sparkSession)
    coded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), code.cast("long").alias("code"))
    return coded.mapInArrow(_plant, "doc_id long, text string")


def digest(collapsed: DataFrame) -> DataFrame:
    """Per row of :func:`collapse_runs`: number of runs, the longest one, and checksums of the runs and the text."""
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))), 0)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return collapsed.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.length")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(-longest.length * 1000) div longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
