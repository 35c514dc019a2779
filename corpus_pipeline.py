"""A training corpus from raw documents: judge, deduplicate, decontaminate, redact, pack.

Every stage takes the documents that the one before kept and returns them with the same columns; the
last returns packed pieces. Decisions of a stage take effect in its rows. Between stages the
documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import decontaminate, near_dedup, packing, quality_model, secrets
from strataflow.llm.queries import TOKENIZER
from strataflow.storage import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model keeps."""
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.good_documents(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8); rows without id stay."""
    return near_dedup.distinct_documents(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicate removal", one_of_each),
    ("benchmark decontamination", without_benchmarks),
    ("secret redaction", without_secrets),
    ("best-fit packing", packed),
]

# Trained models and MinHash decide here; tests/llm compares the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline_stage_{number}")
    return docs
