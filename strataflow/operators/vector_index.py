"""Vector search over cells: every vector lies in the directory of its nearest centre, questions open a few of them.

Centres are fitted by spherical k-means on a bounded sample; every vector is then assigned and written. A question
probes the cells whose centres are nearest to it, so an answer may miss a near vector of another cell: recall
rises with ``probes`` and is 1 when all cells are probed. How many are needed depends on the data, so the index
measures it: the fewest that hold ``RECALL`` of the neighbours of some of the sample. :func:`retrieve.vector_topk`
scans everything and stays the exact way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.retrieve import TOP_K, rank_hits, stream_blocks
from strataflow.operators.scoring import Best, VectorBlock, unit_rows
from strataflow.storage import new_path

# Centres are fitted on so many vectors at most (those with the smallest hashes of their ids), and there are
# at most so many of them: both are held by the driver and sent to tasks.
SAMPLE_ROWS = 20_000
MAX_CELLS = 1024
ROUNDS = 10
RECALL = 0.95
MEASURED = 400  # vectors of the sample whose neighbours are looked up

CELL = "cell"


@dataclass(frozen=True)
class VectorIndex:
    """Folder of the cells, their centres (unit rows), the probes a question needs, and the columns of the vectors."""

    path: str
    centres: np.ndarray
    probes: int
    schema: T.StructType

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField(CELL, T.IntegerType())])).parquet(self.path)


def fit_centres(vectors: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit rows; a centre that loses all its rows stays where it was."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(vectors, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:cells]]
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def needed_probes(vectors: np.ndarray, centres: np.ndarray, k: int = TOP_K, recall: float = RECALL) -> int:
    """Fewest cells that hold a share of ``recall`` of the ``k`` nearest other rows of some of the unit rows.

    Neighbours in a sample are further away than those among all rows, so rather too many come out than too few.
    """
    asked = vectors[np.linspace(0, len(vectors) - 1, min(MEASURED, len(vectors))).astype(int)]
    cell = (vectors @ centres.T).argmax(axis=1)
    rank = np.argsort(np.argsort(-(asked @ centres.T), axis=1, kind="stable"), axis=1)
    near = np.argsort(-(asked @ vectors.T), axis=1, kind="stable")[:, 1:k + 1]  # the first is the row itself
    ranks = np.sort(rank[np.arange(len(asked))[:, None], cell[near]].ravel())
    return 1 + int(ranks[min(int(math.ceil(recall * len(ranks))), len(ranks)) - 1]) if len(ranks) else 1


def _nearest(centres: np.ndarray, column: str, count: int, name: str):
    """Adds to each row the ``count`` cells nearest to its vector, as one number or a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = np.nan_to_num(unit_rows(batch[column])) @ centres.T
            if count == 1:
                cells = pa.array(close.argmax(axis=1).astype(np.int32))
            else:
                cells = pa.array(list(np.argsort(-close, axis=1, kind="stable")[:, :count].astype(np.int32)))
            yield pa.record_batch([*batch.columns, cells], names=[*batch.schema.names, name])

    return run


def build(vectors: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, path: str | None = None) -> VectorIndex:
    """Index of all rows of ``vectors (id, content_vector, …)`` whose vector is not null.

    ``cells`` is by default the square root of the number of rows, up to ``MAX_CELLS``. Other columns are kept.
    """
    spark = vectors.sparkSession
    path = path or new_path(spark, "vector_cells")
    rows = vectors.where(F.col("content_vector").isNotNull())
    sample = rows.select("content_vector", F.xxhash64("id").alias("h")).orderBy("h").limit(sample_rows).toArrow()
    units = unit_rows(sample["content_vector"]) if sample.num_rows else np.zeros((0, 0))
    units = units[~np.isnan(units).any(axis=1)]
    wanted = cells or min(MAX_CELLS, max(1, math.isqrt(rows.count())))
    centres = fit_centres(units, wanted) if len(units) else np.zeros((1, 1))
    probes = needed_probes(units, centres) if len(units) else 1
    schema = T.StructType([*rows.schema.fields, T.StructField(CELL, T.IntegerType())])
    assigned = rows.mapInArrow(_nearest(centres, "content_vector", 1, CELL), schema) if len(units) else rows.withColumn(CELL, F.lit(0))
    assigned.write.partitionBy(CELL).parquet(path)
    return VectorIndex(path, centres, probes, rows.schema)


class _CellBlock(VectorBlock):
    """Questions ``qid, question_vector, cells``: rows of a cell meet the questions that probe it."""

    def __init__(self, block: pa.Table):
        super().__init__(block)
        lists = block["cells"].combine_chunks()
        owner = np.repeat(np.arange(len(self.qids)), np.diff(lists.offsets.to_numpy()))
        cell = lists.flatten().to_numpy()
        order = np.argsort(cell, kind="stable")
        self.cell, self.owner = cell[order], owner[order]

    def score(self, rows: pa.RecordBatch, best: Best) -> None:
        cells = rows[CELL].to_numpy()
        for cell in np.unique(cells):
            asked = self.owner[np.searchsorted(self.cell, cell):np.searchsorted(self.cell, cell, "right")]
            if len(asked):
                self.score_some(rows.take(pa.array(np.flatnonzero(cells == cell))), asked, best)


def search(queries: DataFrame, index: VectorIndex, k: int = TOP_K, probes: int | None = None) -> DataFrame:
    """Best ``k`` vectors by cosine among the nearest cells of each question: ``qid, id, score, rank``.

    As many cells are opened as the index has found to be needed, or ``probes``.
    """
    probes = min(probes or index.probes, len(index.centres))
    asked = queries.where(F.col("question_vector").isNotNull()).select("qid", "question_vector")
    if index.centres.shape[1] == 1:  # nothing is indexed
        asked = asked.where("false")
    with_cells = T.StructType([*asked.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    found = asked.mapInArrow(_nearest(index.centres, "question_vector", probes, "cells"), with_cells) if probes > 1 else (
        asked.mapInArrow(_nearest(index.centres, "question_vector", 1, "cell_"), T.StructType(
            [*asked.schema.fields, T.StructField("cell_", T.IntegerType())])).withColumn("cells", F.array("cell_")).drop("cell_"))
    opened = found.select(F.explode("cells").alias(CELL)).distinct().where(F.col(CELL) >= 0)
    rows = index.table(asked.sparkSession).join(opened, CELL, "left_semi").select("id", "content_vector", CELL)
    size = (F.size("question_vector") + F.size("cells")) * F.lit(8)
    return rank_hits(stream_blocks(rows, found, size, _CellBlock, k), k).select("qid", "id", "score", "rank")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: answers of the exact search, how many of them were found, and their share."""
    both = exact.select("qid", "id").join(found.select("qid", "id").withColumn("hit", F.lit(1)), ["qid", "id"], "left")
    return both.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found"),
                    (F.count("hit") / F.count("*")).alias("recall"))
