"""Manifest, byte-pair encoding and periodic runs against plain versions."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from cases import DOCS, LONG, frame, prose
from pyspark.sql import functions as F

from strataflow.llm import byte_pairs, manifest, periodic, tokens
from strataflow.llm.queries import ORACLE_SQL, QUERIES, RANKS

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


# 11 --------------------------------------------------------------------------------------------

def _rows(n, seed, groups):
    rng = random.Random(seed)
    return [(rng.choice([None, rng.randrange(10 ** 6), 7]), rng.choice(groups), brute.leaf(rng.randrange(n))) for _ in range(n)]


def _proved(spark, rows, changed=lambda i: None):
    table = spark.createDataFrame(
        [(*r, changed(i), "x") for i, r in enumerate(rows)], "k long, name string, h string, new string, pos string")
    got = manifest.prove(table.repartition(3), F.col("k"), F.col("name"), F.col("h"), F.col("new"))
    return [(r["key"], r["leaf"], r["subroot"], r["root"], hashlib.sha256(r["siblings"].hex().encode()).hexdigest(),
             r["version_root"], r["verified"]) for r in got.collect()]


@pytest.mark.parametrize("n", [1, 2, 7, 61])
def test_proofs_equal_brute_force(spark, n):
    rows = _rows(n, n, [None, "", "b", "é", "z"])
    changed = lambda i: brute.leaf("other", i) if i % 3 == 0 else None
    assert sorted(_proved(spark, rows, changed), key=str) == sorted(brute.manifest(rows, changed), key=str)


def test_proofs_over_several_levels_of_blocks(spark):
    rows = [(i, "a" if i % 3 else None, brute.leaf(i)) for i in range(2500)] + [(5, "a", brute.leaf(5))] * 3
    changed = lambda i: brute.leaf(-i) if i % 7 == 0 else None
    assert sorted(_proved(spark, rows, changed), key=str) == sorted(brute.manifest(rows, changed), key=str)


def test_versions_share_all_untouched_nodes():
    tree = manifest.Tree()
    root = tree.build([brute.leaf(i) for i in range(100)], 7)
    before = len(tree.digest)
    path = manifest.block_paths(100, 7)[37]
    new = tree.replaced(root, path, brute.leaf("new"))
    assert len(tree.digest) - before == 8  # the leaf and its seven ancestors
    assert tree.siblings(new, path) == tree.siblings(root, path)
    again = manifest.Tree()
    rebuilt = again.build([brute.leaf("new" if i == 37 else i) for i in range(100)], 7)
    assert tree.digest[new] == again.digest[rebuilt] and tree.digest[root] != tree.digest[new]


def test_manifest_of_an_empty_table(spark):
    assert _proved(spark, _rows(1, 1, ["a"])[:0]) == []


def _manifest_query(rows):
    def at(r, more):
        return brute.leaf(r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"])

    def changed(i):
        d = rows[i]["doc_id"]
        return at(rows[i], 1) if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else None

    return brute.manifest([(r["doc_id"], r["lang"], at(r, 0)) for r in rows], changed)


def _digests(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@needs_tables
def test_op11(spark):
    import duckdb

    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = sorted(_manifest_query(rows), key=str)
    assert _digests(QUERIES["op11_path_copying_manifest"](spark, SF_DIR), *MANIFEST) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF_DIR}/documents.parquet')")
    sql = con.execute(f"select {', '.join(MANIFEST)} from ({ORACLE_SQL['op11_path_copying_manifest']})").fetchall()
    assert sorted(sql, key=str) == want


def _written(spark, tmp_path, rows=DOCS):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_op11_on_awkward_rows(spark, tmp_path):
    folder = _written(spark, tmp_path)
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = _digests(QUERIES["op11_path_copying_manifest"](spark, folder), *MANIFEST)
    assert got == sorted(_manifest_query(rows), key=str)


# 12 --------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_pairs.Encoder(RANKS, public_tokenizers.PATTERN)


def _ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_random_texts_are_encoded_as_the_library_does(library, encoder):
    rng = random.Random(12)
    points = [lambda: rng.randint(32, 0x2ff), lambda: rng.randint(0x400, 0x4ff), lambda: rng.randint(0x4e00, 0x9fff),
              lambda: rng.randint(0x1f300, 0x1f9ff), lambda: rng.choice([0x558, 0x11de0, 0x10d4a, 0x1c, 0x85, 0xa0, 0x2028, 0xb2, 0xbd])]
    for _ in range(4000):
        kind = rng.randrange(4)
        if kind == 0:
            text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 40)))
        elif kind == 1:
            text = rng.choice("ax =-._éñ日 \n\t") * rng.randint(1, 150)
        elif kind == 2:
            text = "".join(rng.choice(["'s", "'ll", "'", "S", " ", "  ", "\n", "the", "1", "²", "_", "."]) for _ in range(30))
        else:
            text = "".join(chr(rng.choice(points)()) for _ in range(rng.randint(1, 20)))
        assert _ids(encoder, text) == library.encode_ordinary(text), repr(text)


def test_every_token_is_reached_from_its_own_text(library, encoder):
    for token in encoder.vocabulary.token[::7]:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert _ids(encoder, text) == library.encode_ordinary(text)


def test_tokens_that_merging_does_not_reach_are_whole_pieces_only(tmp_path):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259, b"cd": 260, b"abcd": 261}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_pairs.Encoder(str(path), public_tokenizers.PATTERN)
    assert 259 not in encoder.vocabulary.made_of
    rng = random.Random(5)
    for text in ["xyz", "axyz", "xyzxyz", "abc", "abcd", "bcd", *("".join(rng.choice("abcdxyz") for _ in range(n)) for n in range(60))]:
        assert _ids(encoder, text) == own.encode_ordinary(text), text


def test_long_texts_are_read_in_blocks_in_linear_time(library, encoder, monkeypatch):
    monkeypatch.setattr(byte_pairs, "LONG_TEXT", 1000)
    monkeypatch.setattr(byte_pairs, "BLOCK_PIECES", 77)
    assert _ids(encoder, LONG) == library.encode_ordinary(LONG)
    word = "abcdefghij" * 40_000
    found = encoder.vocabulary.encode(word.encode())
    assert encoder.vocabulary.decode(found) == word.encode()
    assert found == library.encode_ordinary(word)


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED_PIECES", 5)
    monkeypatch.setattr(byte_pairs, "REMEMBERED_PAIRS", 3)
    small = byte_pairs.Encoder(RANKS, public_tokenizers.PATTERN)
    assert _ids(small, LONG[:4000]) == library.encode_ordinary(LONG[:4000])


def test_op12_on_awkward_rows(spark, tmp_path, library):
    got = _digests(QUERIES["op12_latin1_backtracking"](spark, _written(spark, tmp_path)),
                   "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == _token_rows(DOCS, library)


def _token_rows(docs, library):
    out = []
    for d, text in docs:
        ids = library.encode_ordinary(text or "")
        out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@needs_tables
def test_op12(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = _digests(QUERIES["op12_latin1_backtracking"](spark, SF_DIR), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == _token_rows(docs, library)


def test_round_trip_and_empty_table(spark):
    docs = frame(spark)
    back = byte_pairs.decode(byte_pairs.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert sorted(bytes(r["bytes"]).decode() for r in back.collect()) == sorted(t or "" for _, t in DOCS)
    none = byte_pairs.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN)
    assert none.count() == 0 and byte_pairs.digest(none, RANKS).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["bytes"]) for r in byte_pairs.decode(odd, RANKS).collect()] == [b"", b""]


# 13 --------------------------------------------------------------------------------------------

def _periodic_words(rng):
    n, size = rng.randint(0, 260), rng.choice((1, 2, 3, 5, 50))
    w = [f"w{rng.randrange(size)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 8:
            a = rng.randrange(n)
            p, end = 1 + (n - a) // rng.randint(3, 10), rng.randint(a, n)
            for i in range(a + p, end):
                w[i] = w[i - p]
            if rng.random() < 0.3:
                w[rng.randrange(n)] = "é"
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = [_periodic_words(rng) for _ in range(rng.randint(1, 10))]
        for _, data, offsets in tokens.chunks(pa.array([" ".join(w) for w in texts])):
            found = tokens.words(data, offsets)
            row, starts = periodic.marked_words(found.hash, found.first)
            got = periodic.find_runs(row, np.diff(found.first), starts)
        owner = np.searchsorted(starts, got[:, 0], "right") - 1
        for i, w in enumerate(texts):
            own = got[owner == i] - [starts[i], 0, 0]
            assert [tuple(r) for r in own.tolist()] == brute.runs(w)


@pytest.mark.parametrize("period", [1, 8, 9, 16, 17, 31, 32, 33, 250])
def test_exactly_four_periods_are_a_run_at_every_scale(period):
    rng = random.Random(period)
    w = [rng.randrange(10 ** 6) for _ in range(period)] * 6
    for size in range(max(6, 4 * period) - 1, 4 * period + 3):
        text = [-1, *w[:size], -2]
        hashes = tokens.mix(np.array(text, np.int64).astype(np.uint64))
        row, starts = periodic.marked_words(hashes, np.array([0, len(text)]))
        found = periodic.find_runs(row, np.array([len(text)]), starts).tolist()
        assert found == ([[1, size, period]] if size >= max(6, 4 * period) else [])


RUN_ROWS = [(1000 + i, " ".join(_periodic_words(random.Random(100 + i)))) for i in range(60)]
RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def _run_rows(docs):
    return sorted(((d, *brute.run_digest(brute.planted(d, t))) for d, t in docs), key=str)


def test_op13_on_awkward_rows(spark, tmp_path):
    rows = DOCS + RUN_ROWS
    got = _digests(QUERIES["op13_periodic_runs"](spark, _written(spark, tmp_path, rows)), *RUN_COLUMNS)
    short = [(d, t) for d, t in rows if len(brute.WORD.findall(t or "")) < 2000]
    assert [r for r in got if r[0] not in (20, 21)] == _run_rows(short)


@needs_tables
def test_op13(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    short = [(d, t) for d, t in docs if len(brute.WORD.findall(t or "")) < 400]
    got = {r[0]: r for r in _digests(QUERIES["op13_periodic_runs"](spark, SF_DIR), *RUN_COLUMNS)}
    assert len(got) == len(docs) and len(short) > 100
    assert sorted((got[d] for d, _ in short), key=str) == _run_rows(short)


def test_collapsed_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x  " * 9 + "end"), (2, None), (3, "\n"), (4, "a b " * 4)], "doc_id long, text string")
    got = {r["doc_id"]: (r["collapsed"], [tuple(x) for x in r["runs"]]) for r in periodic.collapse_runs(docs).collect()}
    assert got == {1: ("x end", [(0, 9, 1)]), 2: ("", []), 3: ("", []), 4: ("a b", [(0, 8, 2)])}
    assert periodic.digest(periodic.collapse_runs(docs.limit(0))).count() == 0


def test_a_long_text_is_searched_as_a_whole(spark):
    half = prose(60_000, 3)
    w = half.split(" ")
    text = " ".join(w[:100] + w[200:50_200] * 4 + w[300:400])
    row = periodic.collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert any(r["period"] == 50_000 and r["length"] >= 200_000 for r in row["runs"])
    assert len(row["collapsed"].split(" ")) < 51_000
