"""Tokenised documents packed into sequences of fixed capacity by best-two-fit.

Which lengths share a sequence depends on the histogram of lengths alone, which has at most
``capacity`` entries however many documents there are. The plan (:func:`plan_sequences`) is made from it on
the driver: patterns of lengths with the number of sequences that follow each. Pieces then find
their place by their rank among pieces of the same length; ranks are counted in buckets of bounded size.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches, chunks, mix
from strataflow.storage import materialize

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 20_000

# White space and contractions of the byte-level pre-tokenizer's pattern.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ONE_LETTER, _TWO_LETTERS = "stmd", ("re", "ve", "ll")

_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
_CACHED_TOKENS = 1_000_000


@lru_cache(maxsize=1)
def _char_kinds() -> np.ndarray:
    """Kind of every code point. Letters and numbers that only newer Unicode versions know are unsure."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category[0] in "LN":
            kinds[point] = _UNSURE if point >= 0x10000 else _LETTER if category[0] == "L" else _NUMBER
        elif category == "Cn":
            kinds[point] = _UNSURE
    kinds[[ord(c) for c in _SPACES]] = _SPACE
    return kinds


def word_starts(points: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places where pre-tokens start; ``bounds`` are the starts of the texts and the end."""
    size = len(points)
    edge = np.zeros(size + 1, bool)
    edge[bounds] = True
    edge = edge[:-1]
    change = np.append(True, kinds[1:] != kinds[:-1]) | edge
    space, blank = kinds == _SPACE, points == 32
    after_blank = np.append(False, blank[:-1]) & ~edge
    # A blank joins what follows it; of longer white space only the last character stands before a word.
    start = change & (space | ~after_blank)
    last_space = np.zeros(size, bool)
    last_space[:-1] = space[:-1] & ~space[1:] & ~edge[1:]
    start |= last_space
    # Contractions: an apostrophe that starts a run and follows no blank.
    quote = np.flatnonzero((points == 39) & change & ~after_blank)
    if len(quote):
        ends = bounds[np.searchsorted(bounds, quote, "right")]
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in _ONE_LETTER]) & (quote + 1 < ends)
        long = np.zeros(len(quote), bool)
        for pair in _TWO_LETTERS:
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        long &= (quote + 2 < ends) & ~short
        # The letters of the contraction start no word of their own, those behind it do.
        start[quote[short | long] + 1] = False
        behind = np.concatenate([quote[short] + 2, quote[long] + 3])
        behind = behind[behind < size]
        inside = (kinds[behind] == _LETTER) & ~edge[behind]
        start[behind[inside]] = True
    return np.flatnonzero(start)


class _Encoder:
    """Ids of texts; every distinct pre-token is encoded once and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.separator = self._encode(["\n"])[0][0]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, new: list[str]) -> list[list[int]]:
        """Ids of pre-tokens. Those with a visible character are joined by line ends, which they never hold."""
        out: list = [None] * len(new)
        joined = [i for i, w in enumerate(new) if not w.isspace()]
        blocks = [joined[i:i + 2000] for i in range(0, len(joined), 2000)]
        lines = self._encode(["\n".join(new[i] for i in block) for block in blocks])
        for block, ids in zip(blocks, lines):
            ids = np.asarray(ids)
            parts = np.split(ids, np.flatnonzero(ids == self.separator))
            parts = [parts[0], *(p[1:] for p in parts[1:])]
            if len(parts) != len(block):
                parts = self._encode([new[i] for i in block])
            for i, part in zip(block, parts):
                out[i] = part
        rest = [i for i, w in enumerate(out) if w is None]
        for i, ids in zip(rest, self._encode([new[i] for i in rest])):
            out[i] = ids
        return out

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and the bounds of each."""
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        bounds = heads[offsets]
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        kinds = _char_kinds()[points]
        starts = word_starts(points, kinds, bounds)
        ends = np.append(starts[1:], len(points))
        lengths = ends - starts
        values = mix(points.astype(np.uint64) + np.uint64(1))
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        values *= mix((place + 7).astype(np.uint64)) | np.uint64(1)
        hashes = mix(np.add.reduceat(values, starts))
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > _CACHED_TOKENS:
            self._forget()
        near = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[near] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            encoded = self._encode_words([text[starts[i]:ends[i]] for i in example[fresh]])
            size = np.array([len(e) for e in encoded])
            at = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, *(np.asarray(e, np.uint32) for e in encoded)])
            keys = np.concatenate([self.keys, distinct[fresh]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.at, self.size = np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]
        slot = np.searchsorted(self.keys, distinct)[which]
        at, size = self.at[slot], self.size[slot]
        running = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(at - running[:-1], size) + np.arange(running[-1])]
        cuts = running[np.searchsorted(starts, bounds)]
        unsure = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(kinds == _UNSURE)])[bounds]))
        if self.added is not None:
            # Added tokens stand for themselves wherever a text holds them: no pre-token is one.
            holds = [m.start() for m in self.added.finditer(text)]
            unsure = np.union1d(unsure, np.searchsorted(bounds, holds, "right") - 1) if holds else unsure
        if len(unsure):
            parts = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            for i, own in zip(unsure, self._encode([text[bounds[i]:bounds[i + 1]] for i in unsure])):
                parts[i] = np.asarray(own, np.uint32)
            ids, cuts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, cuts


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _cut(path: str, capacity: int, keep_ids: bool):
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch["text"]):
                ids, bounds = _encoder(path).chunk(data, offsets)
                rows = []
                for i in range(len(offsets) - 1):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], END_ID).astype("<u4")
                    first = len(own) % capacity
                    cuts = [0, *range(first or capacity, len(own), capacity), len(own)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((row + i, piece, a, b - a, zlib.crc32(own[a:b].tobytes()), *[own[a:b]] * keep_ids))
                at, *columns = zip(*rows)
                yield pa.record_batch(
                    [batch["doc_id"].take(pa.array(at)), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))],
                    schema=schema)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenised pieces of ``docs (doc_id, text)``: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    A document is the ids of its text (null: empty) and the end id. Longer ones are cut into pieces of
    ``capacity``, where the first piece may be shorter. Every row counts for itself; null ids are kept.
    """
    bound_batches(docs.sparkSession)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_cut(tokenizer_path, capacity, keep_ids), ddl)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-two-fit over a histogram of lengths.

    A sequence takes the longest piece left, then the longest that fits its gap, until nothing fits. Then
    its smallest piece goes back if two other pieces fill its place and the gap more tightly. The pattern is
    repeated while there are pieces for it. Returns slots ``(length, first rank, count, first sequence,
    offset)``: pieces of a length with these ranks lie at this offset of consecutive sequences. Second, the
    number of sequences.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    taken = np.zeros(capacity + 1, np.int64)
    slots, sequences = [], 0
    numbers = np.arange(capacity + 1)

    def longest(free: np.ndarray) -> np.ndarray:
        """For every gap, the longest piece left that fits it (0: none)."""
        return np.maximum.accumulate(np.where(free > 0, numbers, 0))

    while left.any():
        free, content, gap = left.copy(), [], capacity
        while (best := int(longest(free)[gap])) > 0:
            content.append(best)
            free[best] -= 1
            gap -= best
        if gap and len(content) > 1:
            smallest = content[-1]
            room = gap + smallest
            fits = longest(free)
            first = np.flatnonzero(free[:room + 1] > 0)
            second = fits[room - first]
            alone = (second == first) & (free[first] < 2)
            second = np.where(alone, fits[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > smallest:
                pick = int(total.argmax())
                content[-1:] = sorted((int(first[pick]), int(second[pick])), reverse=True)
        used = Counter(content)
        repeat = min(int(left[x]) // k for x, k in used.items())
        offset = 0
        for x in content:
            slots.append((x, int(taken[x]), repeat, sequences, offset))
            taken[x] += repeat
            left[x] -= repeat
            offset += x
        sequences += repeat
    return slots, sequences


_SHIFT = 1 << 44  # ranks of one length stay below


def _place(slots: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    keys = table[:, 0] * _SHIFT + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch["rank"].to_numpy()
            slot = np.searchsorted(keys, batch["length"].to_numpy() * _SHIFT + rank, "right") - 1
            found = table[slot]
            columns = [batch[c] for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.record_batch(
                [*columns, pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])],
                names=[*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """:func:`pieces` with ``sequence_id`` and ``offset``; an empty table gives no rows.

    Pieces of equal length are exchangeable; which of them gets which place follows a hash of the row.
    """
    cut = materialize(pieces(docs, tokenizer_path, capacity, keep_ids), "packing_pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # capacity rows at most
    slots, _ = plan_sequences(counts, capacity)
    buckets = 1 + sum(counts.values()) // BUCKET_ROWS
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.withColumn("bucket", F.pmod(key, F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy(key, "doc_id", "piece")
    ranked = (
        dealt.withColumn("r", F.row_number().over(inside)).join(starts, ["length", "bucket"])
        .select(*cut.columns, (F.col("first") + F.col("r") - 1).alias("rank"))
    )
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(_place(slots), f"{ddl}, sequence_id long, offset long")
