"""Long byte strings that occur more than once, found by a depth-limited radix sort of suffixes.

Only the first ``LENGTH`` bytes of a suffix matter, so the sort stops there, and it goes on only
with suffixes that still have company. Most significant digit first:

1. The digit is the smallest ``GRAM``-byte gram (by a hash) of the suffix's window, with its place. Neighbouring
   suffixes share it, so a *run* of suffixes with one anchor is one row. Equal windows have equal anchors, so
   runs without a partner are done.
2. The digit is the part that all of ``BLOCK`` neighbouring suffixes at the same distance from the anchor share.
3. The digit is the whole window of a single suffix. Equal groups are exactly the repeated windows.

In every pass the digits are counted first, combined before they are shuffled; suffixes whose digit is alone leave there.
The others are dealt by digit and content together, so that a digit which a third of all texts share is spread by what
surrounds it, and a task reads its sorted rows once, one row ahead. Rows whose bytes are equal throughout leave
as repeated, and one row of each distinct content goes on if its digit has several. A content that a task has seen
twice is sent once: further rows are repeated for certain and are not dealt at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches, chunks, mix
from strataflow.storage import materialize

LENGTH = 400
GRAM = 32
BLOCK = 16

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_PLACE = np.uint64((1 << 31) - 1)
_TOP = np.uint64(2**64 - 1)


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: prefix minima of one block and suffix minima of the one before."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, _TOP)
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:count], before[width - 1:width - 1 + count])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM):
    """Runs of window starts with one anchor: first and last start, anchor, hash of its gram."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, np.zeros(0, np.uint64)
    buffer = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", buffer, 0, (1,))
    grams = len(data) - gram + 1
    hashed = np.zeros(grams, np.uint64)
    for at in range(0, gram, 8):
        hashed = mix(hashed + eight[at:at + grams] * _ODD[at // 8 % 4])
    # The place in the low bits makes the leftmost of equal grams the smallest.
    least = _sliding_min((hashed & ~_PLACE) | np.arange(grams, dtype=np.uint64), length - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    count = len(anchor)
    depth = np.zeros(count + 1, np.int64)
    np.add.at(depth, np.minimum(np.maximum(offsets[:-1], offsets[1:] - length + 1), count), 1)
    np.add.at(depth, np.minimum(offsets[1:], count), -1)
    inside = np.cumsum(depth[:-1]) == 0  # windows that end in the text where they start
    change = np.ones(count, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    last = np.ones(count, bool)
    last[:-1] = change[1:] | ~inside[1:]
    first = np.flatnonzero(change & inside)
    return first, np.flatnonzero(last & inside), anchor[first], hashed[anchor[first]]


def _hashes(data, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    view = memoryview(data)
    return np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist())),
                       np.uint64, len(starts))


_RUNS = "key long, content long, id long, text_hash long, first int, last int, anchor int, known boolean, sure boolean"

# Working memory of the first pass is some 60 bytes per byte of a chunk.
_RUN_CHUNK = 1 << 20
_REMEMBERED = 500_000


class _Sent:
    """Contents that a task has seen twice. A forgotten one is sent again, which changes no result."""

    def __init__(self) -> None:
        self.contents: set[int] = set()

    def mark(self, key: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``known`` to be repeated, and those of them that are ``sure``: another row stands for their content."""
        both, at, which, copies = np.unique(mix(key) + content, return_index=True, return_inverse=True, return_counts=True)
        before = np.fromiter((b in self.contents for b in both.tolist()), bool, len(both))
        twice = (copies > 1) | before
        if len(self.contents) > _REMEMBERED:
            self.contents.clear()
        self.contents.update(both[twice].tolist())
        known = twice[which]
        sure = known.copy()
        sure[at[twice & ~before]] = False
        return known, sure


def _find_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent()
        for batch in batches:
            ids, texts = batch["id"].to_numpy(), batch["text_hash"].to_numpy()
            for row, data, offsets in chunks(batch["text"], _RUN_CHUNK):
                first, last, anchor, key = anchored_runs(data, offsets, length)
                content = _hashes(data, first, last + length) + mix((anchor - first).astype(np.uint64))
                text = np.searchsorted(offsets, first, "right") - 1
                base = offsets[text]
                known, sure = sent.mark(key, content)
                yield pa.record_batch([
                    key.view(np.int64), content.view(np.int64), ids[row + text], texts[row + text],
                    *((x - base).astype(np.int32) for x in (first, last, anchor)), pa.array(known), pa.array(sure),
                ], names=["key", "content", "id", "text_hash", "first", "last", "anchor", "known", "sure"])

    return run


def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key, content``: ``repeated`` if the content occurs twice or is known to; ``goes_on`` for one
    row of each content of a key with ``several`` contents. Rows with neither are left out."""
    before = None  # key and content of the row before

    def emit(rows: pa.RecordBatch, after) -> pa.RecordBatch:
        nonlocal before
        key, content = rows["key"].to_numpy(), rows["content"].to_numpy()
        same = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
        ends = int(key[-1]), int(content[-1])
        same_before = np.append(before == (int(key[0]), int(content[0])), same)
        same_after = np.append(same, after == ends)
        before = ends
        repeated = same_before | same_after | rows["known"].to_numpy(zero_copy_only=False)
        goes_on = ~same_after & rows["several"].to_numpy(zero_copy_only=False)
        out = pa.record_batch([*rows.columns, pa.array(repeated), pa.array(goes_on)],
                              names=[*rows.schema.names, "repeated", "goes_on"])
        return out.filter(pa.array(repeated | goes_on)).drop_columns(["several"])

    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if waiting is None else pa.concat_batches([waiting, batch])
        waiting = rows.slice(rows.num_rows - 1)
        if rows.num_rows > 1:
            yield emit(rows.slice(0, rows.num_rows - 1), (waiting["key"][0].as_py(), waiting["content"][0].as_py()))
    if waiting is not None:
        yield emit(waiting, None)


def _radix_pass(rows: DataFrame, name: str) -> DataFrame:
    """One pass: count the digits, deal what has company, sort, mark; only repeated rows and those that go on are written."""
    rows = materialize(rows, f"{name}_rows")
    dealt = rows.where("not sure").drop("sure")
    shared = (
        dealt.groupBy("key").agg(F.min("content").alias("least"), F.max("content").alias("most"), F.count("*").alias("size"),
                                 F.max("known").alias("sent_twice"))
        .where("size > 1 or sent_twice").select("key", (F.col("least") != F.col("most")).alias("several"))
    )
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    marked = (
        dealt.join(shared, "key").repartition("key", "content").sortWithinPartitions("key", "content")
        .mapInArrow(_company, f"{ddl}, repeated boolean, goes_on boolean")
    )
    sure = rows.where("sure").drop("sure").withColumn("repeated", F.lit(True)).withColumn("goes_on", F.lit(False))
    return materialize(marked.union(sure), name)


_CONTEXT = "id long, text_hash long, anchor int, first int, last int, key long, single boolean, bytes binary"


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _take_contexts(length: int):
    """Bytes of the runs that go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, id_, text_hash = _unpack(batch["packed"][i].as_py()), batch["id"][i].as_py(), batch["text_hash"][i].as_py()
                runs = batch["runs"][i].as_py()
                yield pa.record_batch([
                    pa.array([id_] * len(runs), pa.int64()), pa.array([text_hash] * len(runs), pa.int64()),
                    *(pa.array([r[c] for r in runs], pa.int32()) for c in ("anchor", "first", "last")),
                    pa.array([r["key"] for r in runs], pa.int64()), pa.array([r["single"] for r in runs], pa.bool_()),
                    pa.array([text[r["first"]:r["last"] + length] for r in runs], pa.binary()),
                ], names=["id", "text_hash", "anchor", "first", "last", "key", "single", "bytes"])

    return run


_DIGITS = "key long, content long, id long, text_hash long, anchor int, low int, high int, single boolean, known boolean, sure boolean"


def _refine(length: int, block: int):
    """Rows of ``block`` neighbouring windows: the shared part is the key, all their bytes the content.

    A block holds the windows whose distance to the anchor has one quotient by ``block``; the part common to
    all such windows lies in each of them, so it is there also if a run ends inside the block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent()
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            columns = zip(*(batch[c].to_pylist() for c in batch.schema.names))
            for row in columns:
                row = dict(zip(batch.schema.names, row))
                view, start, anchor, key = memoryview(row["bytes"]), row["first"], row["anchor"], row["key"]
                number, stop = (anchor - row["high"]) // block, (anchor - row["low"]) // block
                for b in range(number, stop + 1):
                    far, near = min(anchor - row["low"], b * block + block - 1), max(anchor - row["high"], b * block)
                    shared = anchor - b * block - start
                    digit = xxhash.xxh3_64_intdigest(view[shared:shared + length - block + 1], seed=key & (2**64 - 1))
                    digit = (digit + (b + 1) * int(_ODD[0])) & (2**64 - 1)
                    content = xxhash.xxh3_64_intdigest(view[anchor - far - start:anchor - near - start + length],
                                                       seed=far * 65536 + near)
                    for column, value in zip(out, (digit, content, row["id"], row["text_hash"], anchor,
                                                   anchor - far, anchor - near, row["single"])):
                        column.append(value)
            digits, contents = np.array(out[0], np.uint64), np.array(out[1], np.uint64)
            known, sure = sent.mark(digits, contents)
            yield pa.record_batch(
                [pa.array(digits.view(np.int64)), pa.array(contents.view(np.int64)),
                 *(pa.array(c, t) for c, t in zip(out[2:], (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()))),
                 pa.array(known), pa.array(sure)],
                names=["key", "content", "id", "text_hash", "anchor", "low", "high", "single", "known", "sure"])

    return run


def _merge(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for packed, spans in zip(batch["packed"].to_pylist(), batch["spans"].to_pylist()):
            text, removed = _unpack(packed), _merge(spans or [])
            parts, at = [], 0
            for start, end in removed:
                parts.append(text[at:start])
                at = end
            kept = b"".join([*parts, text[at:]])
            rows.append((len(text), len(text) - len(kept), len(removed), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows)) if rows else [()] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.record_batch([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types))],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for row, data, offsets in chunks(batch["text"]):
            view = memoryview(data)
            packed = [compressor.compress(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.record_batch(
                [*(batch[c].slice(row, len(packed)) for c in ("doc_id", "id", "text_hash")), pa.array(packed, pa.binary())],
                names=["doc_id", "id", "text_hash", "packed"])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    Removed is every byte covered by a string of ``length`` bytes (UTF-8) that starts at another place too, in
    the same or another row; strings never cross rows. ``kept`` are the other bytes. A null text is empty;
    shorter texts lose nothing. Rows count as they come: a repeated row repeats its text. Other columns are
    ignored. An empty table gives an empty result; one text takes some 60 bytes of memory per byte.
    """
    bound_batches(docs.sparkSession)
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63) + 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_.alias("id"),
                        F.xxhash64("text").alias("text_hash"), "text")
    runs = texts.select("id", "text_hash", "text").mapInArrow(_find_runs(length), _RUNS)
    live = _radix_pass(runs, "suffix_runs")

    packed = texts.mapInArrow(_pack, "doc_id long, id long, text_hash long, packed binary")
    wanted = live.where("goes_on").groupBy("id", "text_hash").agg(F.collect_list(F.struct(
        "key", "first", "last", "anchor", (~F.col("repeated")).alias("single"))).alias("runs"))
    contexts = materialize(
        packed.select("id", "text_hash", "packed").dropDuplicates(["id", "text_hash"]).join(wanted, ["id", "text_hash"])
        .mapInArrow(_take_contexts(length), _CONTEXT),
        "suffix_contexts",
    )
    blocks = _radix_pass(
        contexts.select("*", F.col("first").alias("low"), F.col("last").alias("high"))
        .mapInArrow(_refine(length, BLOCK), _DIGITS), "suffix_blocks")
    place = ["id", "text_hash", "anchor"]
    narrowed = contexts.drop("single").join(
        blocks.where("goes_on").select(*place, "low", "high", (F.col("single") & ~F.col("repeated")).alias("single")), place)
    windows = _radix_pass(narrowed.mapInArrow(_refine(length, 1), _DIGITS), "suffix_windows")

    def removed(rows: DataFrame, low: str, high: str) -> DataFrame:
        return rows.where("repeated").select("id", "text_hash", F.struct(
            F.col(low).alias("start"), (F.col(high) + length).alias("end")).alias("span"))

    spans = (
        removed(live, "first", "last")
        .union(removed(blocks.where("single"), "low", "high")).union(removed(windows.where("single"), "low", "high"))
        .groupBy("id", "text_hash").agg(F.collect_set("span").alias("spans"))  # a repeated row repeats its spans
    )
    return packed.join(spans, ["id", "text_hash"], "left").select("doc_id", "packed", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
