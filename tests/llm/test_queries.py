"""Registered queries and the pipeline on the smallest tables, against plain versions."""

from __future__ import annotations

import os
import zlib

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from cases import DOCS, frame
from strataflow.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def _rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_op1(spark, docs):
    import duckdb

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.contained(docs, items)
    got = sorted(((r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_shared"]) for r in _rows(spark, "op1_containment_search")), key=str)
    assert got == want and want
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    assert sorted((r[:4] for r in con.execute(ORACLE_SQL["op1_containment_search"]).fetchall()), key=str) == want


def test_op2(spark, docs):
    got = {r["doc_id"]: r for r in _rows(spark, "op2_disclosure_spans")}
    for d, text in docs:
        s = brute.private_spans(text)
        assert got[d]["base_sha256"] == brute.checksum(s) and got[d]["spans"].startswith(brute.written(s))


def test_op3(spark, docs):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in _rows(spark, "op3_radix_repeats")), key=str)
    assert got == brute.repeats(docs, 400)


def test_op4(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = _rows(spark, "op4_best_two_fit")
    want = sorted((d, *p) for d, t in docs for p in brute.token_pieces(t, tokenizer, 2048))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want


def test_op5(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]
    got = _rows(spark, "op5_capture_index")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == brute.captures(pages)


def test_op6(spark, docs):
    want = brute.near_components(docs, 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in _rows(spark, "op6_lsh_forest_dedup")}
    assert got == want


def test_op7(spark, docs):
    got = {r["doc_id"]: r for r in _rows(spark, "op7_sketch_thresholds")}
    for d, text in docs:
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.counts(text)


def test_op8(spark):
    got = {r["doc_id"]: r for r in _rows(spark, "op8_attention_quality")}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [d for d in labels if got[d]["held_out"]]
    assert sum(got[d]["predicted"] == labels[d] for d in held) >= 0.9 * len(held)


def test_op9(spark):
    import html
    import re

    for r, page in zip(sorted(_rows(spark, "op9_tree_extraction")), sorted(spark.read.parquet(f"{SF_DIR}/pages.parquet").collect())):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.S)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article[1])]
        assert r["text"] == "\n\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_op10(spark, docs):
    got = {r["doc_id"]: r for r in _rows(spark, "op10_markov_secrets")}
    for d, text in docs:
        assert got[d]["base_sha256"] == brute.checksum(brute.secret_spans(text))


def test_pipeline_stages(spark):
    """Every stage keeps the columns and does to its input what a plain version does."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, texts = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        texts[name] = before, after
    before, after = texts["near-duplicate removal"]
    want = brute.near_components(list(before.items()), 5, 80)
    assert set(after) == {d for d, (_, c) in want.items() if d == c}
    before, after = texts["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(before) - set(after) == {d for d, *_ in brute.contained(list(before.items()), items)}
    before, after = texts["secret redaction"]
    assert set(before) == set(after) and not any(brute.secret_spans(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not brute.secret_spans(t) and "[SECRET]" not in after[d])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in last.collect()} == set(after)


def _with_tables(spark, tmp_path, docs, source=SF_DIR):
    """A folder with ``docs`` as documents and the other tables of the pipeline."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and columns with clashing names pass every stage."""
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").selectExpr("doc_id + 1000 as doc_id", "text")
    docs = frame(spark, [*DOCS, *(tuple(r) for r in source.collect())])
    folder, columns = _with_tables(spark, tmp_path, docs), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns, name
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_pipeline_on_empty_tables(spark, tmp_path):
    folder = _with_tables(spark, tmp_path, spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_runs_all_stages(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100
