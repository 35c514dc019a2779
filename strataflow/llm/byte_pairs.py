"""Byte-level BPE by longest matches: encoding whole texts to ids and decoding ids to bytes.

Texts are split by the pre-tokenizer's pattern. A piece that is a token is that token. Any other piece is read
as Latin-1, one character a byte, so that an Aho-Corasick automaton over characters matches bytes. Of the
tokens that match at a place the longest is tried first, then its shorter prefixes; a token stands if merging
could leave it beside the token before it. That depends on the two tokens alone (:meth:`Vocabulary.beside`)
and is remembered. If none stands, the place is closed for good and the token before is taken back, so no
place is left twice and the time is linear. The one sequence whose neighbours can all stand side by side
is what merging by rank gives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches

REMEMBERED_PIECES = 400_000
REMEMBERED_LENGTH = 64
REMEMBERED_PAIRS = 500_000
BLOCK_PIECES = 100_000
BLOCK_BYTES = 1 << 20
LONG_TEXT = 1 << 20  # characters; the pieces of longer texts are not all held at once
LAST_BASIC = "\uffff"
IDS = np.dtype("<u4")


class Vocabulary:
    """Tokens of a rank file, how merging makes each of them, and the automaton that matches them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError(f"{path} does not hold all single bytes")
        self.longest = max(map(len, self.token))
        self.size = [len(token) for token in self.token]
        self.made_of: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self._find_merges()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for rank in self.made_of:
            self.automaton.add_word(self.token[rank].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = [self._prefix(token) for token in self.token]

    def _find_merges(self) -> None:
        """The two tokens that are merged into each token; ranks ascend, so both are known before.

        A token that merging never reaches (its bytes come out as others) is matched by whole pieces only.
        """
        for rank, token in enumerate(self.token):
            if len(token) == 1:
                self.made_of[rank] = rank, rank
            for cut in range(1, len(token)):
                pair = self.rank.get(token[:cut], rank), self.rank.get(token[cut:], rank)
                if max(pair) < rank and pair[0] in self.made_of and pair[1] in self.made_of and self._may_stand(*pair):
                    self.made_of[rank], self.merged[pair] = pair, rank
                    break
        self.known.clear()

    def _prefix(self, token: bytes) -> int:
        """The longest proper prefix that is a token of the automaton, or -1."""
        for end in range(len(token) - 1, 0, -1):
            rank = self.rank.get(token[:end], -1)
            if rank in self.made_of:
                return rank
        return -1

    def _may_stand(self, left: int, right: int) -> bool:
        """Whether no merge joins the two: undo merges from the latest on; none across the edge may come earlier."""
        limit = len(self.token) + 1
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            # Of equal ranks the one further left is merged first, hence undone last.
            if left > right:
                undone, inner = left, self.made_of[left][1]
                if inner != left:
                    limit, left = undone, inner
                    continue
                outer = self.made_of[right][0]
                if outer == right:
                    return True
                limit, right = right + 1, outer
            else:
                outer = self.made_of[right][0]
                if outer != right:
                    limit, right = right + 1, outer
                    continue
                inner = self.made_of[left][1]
                if inner == left:
                    return True
                limit, left = left, inner

    def beside(self, pair: tuple[int, int]) -> bool:
        """Whether merging leaves the two tokens next to each other; remembered in ``known``."""
        if len(self.known) >= REMEMBERED_PAIRS:
            self.known.clear()
        found = self.known[pair] = self._may_stand(*pair)
        return found

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        text, end = piece.decode("latin-1"), len(piece)
        matches, longest, size, shorter = self.automaton.iter_long, self.longest, self.size, self.shorter
        known, beside = self.known.get, self.beside
        closed = bytearray(end + 1)
        ids: list[int] = []
        at, token, last = 0, -1, -1
        while at < end:
            if token < 0:
                token = next(matches(text[at:at + longest]))[1]  # single bytes always match
            while token >= 0:
                if not closed[at + size[token]]:
                    if last < 0:
                        break
                    stands = known(pair := (last, token))
                    if stands or (stands is None and beside(pair)):
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at += size[token]
                token, last = -1, token
            else:
                closed[at] = 1
                at -= size[last]
                token = ids.pop()  # its end is closed now: the shorter ones follow
                last = ids[-1] if ids else -1
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _ranges(characters: str) -> str:
    """Ascending characters as the inside of a character class."""
    points = np.array([ord(c) for c in characters], np.int64)
    first = np.flatnonzero(np.diff(points, prepend=-2) > 1)
    last = np.append(first[1:] - 1, len(points) - 1)
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(points[first], points[last]))


class Splitter:
    """Pieces of texts by a pre-tokenizer pattern of letters, numbers, white space and others.

    Which characters these are depends on the Unicode version, so the tokenizer's own pattern engine is asked
    once for all characters.
    """

    def __init__(self, pattern: str):
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        single_bytes = {bytes([i]): i for i in range(256)}
        classes = {}
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            engine = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single_bytes, special_tokens={})
            classes[kind] = bytes(engine.encode_ordinary(every)).decode()
        self.every = self._compile(pattern, classes)
        # Without the many ranges beyond, for texts that do not need them.
        self.basic = self._compile(pattern, {k: "".join(c for c in v if c <= LAST_BASIC) for k, v in classes.items()})

    @staticmethod
    def _compile(pattern: str, classes: dict[str, str]) -> re.Pattern:
        inside = {k: _ranges(v) for k, v in classes.items()}
        spelled, in_class, at = [], False, 0
        while at < len(pattern):
            kind = next((k for k in (*inside, r"\S") if pattern.startswith(k, at)), pattern[at])
            if kind == r"\S":
                spelled.append(f"[^{inside[chr(92) + 's']}]")
            elif kind in inside:
                spelled.append(inside[kind] if in_class else f"[{inside[kind]}]")
            else:
                in_class = kind == "[" or (in_class and kind != "]")
                spelled.append(kind)
            at += len(kind)
        return re.compile("".join(spelled))

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The pieces in order; those of a long text are not all held at once."""
        pattern = self.basic if text.isascii() or max(text) <= LAST_BASIC else self.every
        if len(text) <= LONG_TEXT:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while block := [m.group() for m in islice(found, BLOCK_PIECES)]:
            yield block


class Encoder(dict):
    """Ids of texts as little-endian 32-bit numbers; those of short pieces are remembered for some time."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.vocabulary, self.splitter, self.earlier = vocabulary(path), Splitter(pattern), {}

    def __missing__(self, piece: str) -> bytes:
        out = self.earlier.get(piece)
        if out is None:
            ids = self.vocabulary.encode(piece.encode())
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED_PIECES:
                self.earlier = dict(self)  # pieces in use come back from here
                self.clear()
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, block)) for block in self.splitter.blocks(text))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _texts(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose values have about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    row = 0
    while row < len(sizes):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, stop
        row = stop


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            for row, stop in _texts(batch, "text"):
                ids = [encoder.encode(text) if text else b"" for text in batch["text"].slice(row, stop - row).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), IDS).astype(np.int32))
                yield pa.record_batch(
                    [batch["doc_id"].slice(row, stop - row), pa.ListArray.from_arrays(pa.array(ends), values)],
                    names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs (doc_id, text)``: the ids of the whole text in order.

    ``path`` names a file of tokens in base64 with their ranks, ``pattern`` splits texts before merging; no
    special tokens. Null and empty texts have no ids, null and repeated doc_ids and equal rows are kept
    as they are, other columns are ignored, and an empty table gives no rows. A long text is read in blocks
    of pieces, a long word by backtracking over slices, so time and memory follow the length of the text.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_encode(path, pattern), "doc_id long, ids array<int>")


def _flat(column: pa.ListArray, row: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the rows and their bounds; a null row is empty."""
    part = column.slice(row, stop - row)
    sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
    return part.flatten().to_numpy(zero_copy_only=False).astype(IDS, copy=False), np.concatenate([[0], np.cumsum(sizes)])


def _decode(path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_numpy()
            step = max(1, int(BLOCK_BYTES // max(4 * counts.mean(), 1))) if len(counts) else 1
            for row in range(0, len(counts), step):
                stop = min(row + step, len(counts))
                values, ends = _flat(batch["ids"], row, stop)
                rows = []
                for a, b in zip(ends, ends[1:]):
                    if digest:
                        ids_sum, text_sum = hashlib.sha256(values[a:b].tobytes()), hashlib.sha256()
                        for at in range(a, b, BLOCK_PIECES):
                            text_sum.update(tokens.decode(values[at:min(at + BLOCK_PIECES, b)].tolist()))
                        rows.append((b - a, ids_sum.hexdigest(), text_sum.hexdigest()))
                    else:
                        rows.append((tokens.decode(values[a:b].tolist()),))
                yield pa.record_batch(
                    [batch["doc_id"].slice(row, stop - row), *map(pa.array, zip(*rows))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "bytes"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, bytes`` of every row of ``encoded (doc_id, ids)``; null ids give no bytes.

    Ids cut anywhere decode to bytes that need not be whole characters. An id outside the vocabulary fails.
    """
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode(path, False), "doc_id long, bytes binary")


def digest(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of :func:`encode`: number of ids, checksum of the ids, checksum of the bytes they decode to."""
    return encoded.mapInArrow(_decode(path, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
