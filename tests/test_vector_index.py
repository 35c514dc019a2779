from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import retrieve, vector_index


@pytest.fixture(scope="module")
def data(spark):
    """Vectors around 40 points, one of them with a third of all rows, some copies, a null and a zero."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(40, 16))
    which = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 40, 3000))
    rows = [(i, (points[w] + rng.normal(scale=0.35, size=16)).tolist()) for i, w in enumerate(which)]
    rows += [(4000 + i, rows[0][1]) for i in range(30)] + [(5000, None), (5001, [0.0] * 16)]
    vectors = spark.createDataFrame(rows, "id bigint, content_vector array<double>").repartition(4).cache()
    asked = vectors.where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("content_vector").alias("question_vector"))
    return vectors, asked


def test_recall_with_few_cells_probed(spark, data):
    vectors, asked = data
    index = vector_index.build(vectors)
    assert index.table(spark).count() == 3031 and len(index.centres) == 55  # all but the null vector
    assert index.probes < 20
    got = vector_index.recall(vector_index.search(asked, index), retrieve.vector_topk(asked, vectors)).first()
    assert got["n_exact"] > 250 and got["recall"] >= 0.9


def test_probes_follow_the_data(spark):
    """Vectors without any structure need many cells, and get them."""
    rng = np.random.default_rng(8)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1500, 24)))],
                                    "id bigint, content_vector array<double>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 24)))],
                                  "qid bigint, question_vector array<double>")
    index = vector_index.build(vectors)
    assert index.probes > 8
    got = vector_index.recall(vector_index.search(asked, index), retrieve.vector_topk(asked, vectors)).first()
    assert got["recall"] >= 0.9


def test_all_cells_give_the_exact_answer(spark, data):
    vectors, asked = data
    index = vector_index.build(vectors, cells=7, sample_rows=200)
    shown = lambda df: sorted(map(tuple, df.collect()))
    assert shown(vector_index.search(asked, index, probes=7)) == shown(retrieve.vector_topk(asked, vectors))
    one = vector_index.search(asked, index, k=1, probes=1)
    assert one.count() == asked.where("qid <> 5000").count()  # each finds itself or an equal one


def test_only_probed_cells_are_opened(spark, data):
    vectors, asked = data
    index = vector_index.build(vectors, cells=30)
    found = vector_index.search(asked.where("qid = 100"), index, probes=2)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 5


def test_empty_tables(spark, data):
    vectors, asked = data
    nothing = vector_index.build(vectors.where("false"))
    assert vector_index.search(asked, nothing).count() == 0
    assert vector_index.search(asked.where("false"), vector_index.build(vectors, cells=3)).count() == 0
