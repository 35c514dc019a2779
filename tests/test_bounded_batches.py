from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import bounded_batches
from strataflow.operators.bounded_batches import assign_bounded_batches, next_starts
from strataflow.operators.documents import batch_manifest, write_batches


def plain(sizes, count, limit):
    out, held, docs, batch = [], 0, 0, -1
    for size in sizes:
        if batch < 0 or docs == count or held + size > limit:
            held, docs, batch = 0, 0, batch + 1
        held, docs = held + size, docs + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("count,limit,n", [(5, 100, 1), (5, 100, 4), (5, 100, 333), (7, 30, 2000), (3, 10 ** 6, 500), (4, 0, 50)])
def test_batches_equal_a_loop_over_all_documents(spark, tmp_path, monkeypatch, count, limit, n):
    monkeypatch.setattr(bounded_batches, "PART_BATCHES", 3)  # many parts, several levels of them
    monkeypatch.setattr(bounded_batches, "FAN", 4)
    rng = np.random.default_rng(n)
    sizes = np.where(rng.random(n) < 0.1, 0, np.minimum(rng.pareto(0.8, n) * 5, 400)).astype(int)
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame([(i if i % 97 else None, "x" * int(s) if s else None) for i, s in enumerate(sizes)],
                                  "id bigint, text string").coalesce(1)
    frame.write.parquet(path)
    batched = assign_bounded_batches(spark, path, F.octet_length("text"), count, limit)
    got = batched.groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).collect()
    want = plain(sizes.tolist(), count, limit)
    assert {r["batch_id"]: (r["n"], r["b"]) for r in got} == {
        b: (want.count(b), sum(s for s, w in zip(sizes.tolist(), want) if w == b)) for b in set(want)}
    ids = {r["id"]: r["batch_id"] for r in batched.where("id is not null").collect()}
    assert ids == {i: b for i, b in enumerate(want) if i % 97}


def test_a_batch_ends_at_the_first_bound():
    assert next_starts(np.array([1, 1, 9, 1]), 4, 2, 3).tolist() == [2, 2, 3, -1]
    assert next_starts(np.array([9, 9]), 1, 2, 3).tolist() == [1]


def test_bounded_batches_are_written_like_others(spark, tmp_path):
    spark.createDataFrame([(1, "aa"), (2, "bb"), (None, "c")], "id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    batched = assign_bounded_batches(spark, str(tmp_path / "in"), F.octet_length("text"), 10, 4)
    assert [tuple(r) for r in batch_manifest(batched).orderBy("batch_id").collect()] == [(0, 2, 0, "ok"), (1, 1, 1, "failed")]
    write_batches(batched, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "id bigint, text string").write.parquet(str(tmp_path / "in"))
    assert assign_bounded_batches(spark, str(tmp_path / "in"), F.octet_length("text")).count() == 0
