"""Benchmark items found inside documents by size-partitioned MinHash containment search.

Items are partitioned by size (powers of two of their shingle count). For every size class
``c`` a document is covered by windows of ``2c`` shingles, ``c`` apart, so that an item of the
class lies whole in one of them and is never lost in a long document. A window and an item
that agree in any of ``HASHES`` min-hashes are a candidate; it counts if the share of the
item's distinct shingles that the *whole* document has reaches the threshold. That is decided on
the words themselves, not on hashes.

The items are the stated query set: they are written to the shared folder in blocks of bounded size, which
the tasks open. The documents are read once and stream past the blocks without any shuffle; no item
passes the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import LOWER, Runs, bound_batches, chunks, shingles, words
from strataflow.storage import new_path, open_table

WIDTH = 5
PERCENT = 80

# A window holds at most four times an item's shingles, so a hash agrees with a chance of 0.8 / 4.2
# or more: all of 48 disagree once in 25,000 times, for an item that has just the least share.
HASHES = 48

# One block of items is at most so many rows and characters (on average over the blocks).
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16 << 20
# While there are several blocks, so many bytes of the documents are held and meet all of them.
HELD_BYTES = 32 << 20

_random = np.random.Generator(np.random.PCG64(5))
_MULTIPLY = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(1, 2**63, HASHES, dtype=np.uint64)


def _size_class(windows: int) -> int:
    return 1 << max(windows - 1, 0).bit_length()


class ItemBlock:
    """Signatures and shingles of some items, by size class."""

    def __init__(self, items: pa.Table, width: int):
        self.width = width
        self.ids = items["item_id"]
        self.copies = items["copies"].to_numpy()
        self.source: list[tuple[np.ndarray, Runs, int]] = []
        self.hashes: list[np.ndarray] = []
        signed: dict[int, list[int]] = defaultdict(list)
        for _, data, offsets in chunks(items["text"]):
            found = words(data, offsets, lower=True)
            hashed, at = shingles(found.hash, found.first, width, whole=True)
            for d in range(len(offsets) - 1):
                own = np.unique(hashed[at[d]:at[d + 1]])
                if len(own):
                    signed[_size_class(int(at[d + 1] - at[d]))].append(len(self.hashes))
                self.source.append((data, found, d))
                self.hashes.append(own)
        # Per class and hash: the sorted minima and the item of each.
        self.classes = {}
        for size, members in sorted(signed.items()):
            values = np.concatenate([self.hashes[i] for i in members])
            first = np.cumsum([0, *(len(self.hashes[i]) for i in members)])[:-1]
            minima = np.array([np.minimum.reduceat((values ^ f) * m, first) for f, m in zip(_FLIP, _MULTIPLY)])
            order = np.argsort(minima, axis=1, kind="stable")
            self.classes[size] = (np.take_along_axis(minima, order, 1), np.array(members)[order])

    def distinct(self, item: int) -> set[tuple[bytes, ...]]:
        data, found, d = self.source[item]
        return _distinct(_words(data, found, int(found.first[d]), int(found.first[d + 1])), self.width)


def _words(data: np.ndarray, runs: Runs, start: int, stop: int) -> list[bytes]:
    return [LOWER[data[runs.start[i]:runs.end[i]]].tobytes() for i in range(start, stop)]


def _distinct(own: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if len(own) < width:
        return {tuple(own)} if own else set()
    return set(zip(*(own[j:] for j in range(width))))


def _candidates(hashed: np.ndarray, at: np.ndarray, block: ItemBlock) -> set[tuple[int, int]]:
    """(text, item) pairs of a chunk that agree in a min-hash of some window."""
    counts, out = np.diff(at), set()
    plans = []
    for size, (minima, items) in block.classes.items():
        cells = -(-counts // size)
        text = np.repeat(np.arange(len(counts)), cells)
        step = np.arange(len(text)) - np.repeat(np.cumsum(cells) - cells, cells)
        # A window is a cell and the next one of the same text.
        plans.append((at[text] + step * size, text, np.append(text[1:] == text[:-1], False), minima, items))
    for h in range(HASHES):
        values = (hashed ^ _FLIP[h]) * _MULTIPLY[h]
        for start, text, joined, minima, items in plans:
            if not len(start):
                continue
            least = np.minimum.reduceat(values, start)
            least[:-1][joined[:-1]] = np.minimum(least[:-1], least[1:])[joined[:-1]]
            low = np.searchsorted(minima[h], least, "left")
            for w in np.flatnonzero(minima[h][np.minimum(low, len(minima[h]) - 1)] == least):
                high = np.searchsorted(minima[h], least[w], "right")
                out.update((int(text[w]), int(i)) for i in items[h][low[w]:high])
    return out


def _hits(texts: pa.Array, block: ItemBlock, percent: int) -> Iterator[tuple[int, int, int, int]]:
    """``(row, item, distinct shingles of the item, those that the text has)`` of items that are contained."""
    wanted_of = cache(block.distinct)
    for row, data, offsets in chunks(texts):
        found = words(data, offsets, lower=True)
        hashed, at = shingles(found.hash, found.first, block.width, whole=True)
        for text, item in sorted(_candidates(hashed, at, block)):
            items = block.hashes[item]
            hit = np.isin(hashed[at[text]:at[text + 1]], items)
            if 100 * len(np.unique(hashed[at[text]:at[text + 1]][hit])) < percent * len(items):
                continue
            wanted, shared, first = wanted_of(item), set(), int(found.first[text])
            last = int(found.first[text + 1])
            for w in np.flatnonzero(hit):
                shared.add(tuple(_words(data, found, first + w, min(first + w + block.width, last))))
            shared &= wanted
            if 100 * len(shared) >= percent * len(wanted):
                yield row + text, item, len(wanted), len(shared)


def _write_blocks(items: DataFrame) -> list[str]:
    """Different items in blocks, each a folder that tasks open; the driver sees their number and size only.

    Rows that repeat an item are one row with ``copies``, so that they do not fill one block.
    """
    spark = items.sparkSession
    single = items.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    total = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    count = max(1, -(-total["n"] // BLOCK_ITEMS), -(-total["chars"] // BLOCK_CHARS))
    path = new_path(spark, "benchmark_blocks")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    single.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={number}" for number in range(count)]


def _held(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _blocks_past(batches: Iterator[pa.RecordBatch], paths: list[str], width: int):
    """``(held batches, their blocks one after the other)``; a single block is opened once a task."""
    opened: tuple[str, ItemBlock | None] = ("", None)

    def block(path: str) -> ItemBlock | None:
        nonlocal opened
        if opened[0] != path:
            table = open_table(path)
            opened = path, None if table is None else ItemBlock(table, width)
        return opened[1]

    for held in _held(batches, HELD_BYTES if len(paths) > 1 else 0):
        yield held, (found for path in paths if (found := block(path)) is not None)


def _search(paths: list[str], width: int, percent: int, item_type: pa.DataType):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", item_type), ("n_item_shingles", pa.int64()),
                        ("n_shared", pa.int64()), ("containment", pa.float64()), ("copies", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, blocks in _blocks_past(batches, paths, width):
            for block in blocks:
                for batch in held:
                    rows = list(_hits(batch["text"], block, percent))
                    if rows:
                        at_row, item, size, shared = (np.array(c) for c in zip(*rows))
                        yield pa.record_batch([
                            batch["doc_id"].take(pa.array(at_row)), block.ids.take(pa.array(item)).combine_chunks(),
                            pa.array(size, pa.int64()), pa.array(shared, pa.int64()), pa.array(shared / size),
                            pa.array(block.copies[item], pa.int64()),
                        ], schema=schema)

    return find


def contained_items(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment`` of every document that contains an item.

    ``docs (doc_id, text)``, ``items (item_id, text)``. Words are runs outside white space with
    A-Z lower-cased; a shingle is ``width`` words, or the whole text if it has fewer. An item is
    contained if ``100 * shared >= percent * its distinct shingles``. Null and empty texts have no
    shingles and neither contain nor are contained. Every row counts for itself, so repeated
    rows give repeated results; null ids are kept. Empty tables give no rows, other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    paths = _write_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text"))
    found = texts.mapInArrow(
        _search(paths, width, percent, pa.int64()),
        "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double, copies long")
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return found.select("*", each.alias("copy")).drop("copies", "copy")


def _without(paths: list[str], width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, blocks in _blocks_past(batches, paths, width):
            clean = [np.ones(batch.num_rows, bool) for batch in held]
            for block in blocks:
                for batch, flags in zip(held, clean):
                    for row, *_ in _hits(batch["text"], block, percent):
                        flags[row] = False
            for batch, flags in zip(held, clean):
                yield batch.filter(pa.array(flags))

    return run


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that contain no item, all columns unchanged.

    Every row is judged by its own text, also where rows share an id or have none. Null and empty
    texts stay; without items everything stays.
    """
    bound_batches(docs.sparkSession)
    paths = _write_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text"))
    return docs.mapInArrow(_without(paths, width, percent), docs.schema)
