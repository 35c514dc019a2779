"""Intermediate tables in the cluster's shared folder.

A written table cuts the lineage, survives lost executors, fixes the result of
steps that are not deterministic (approximate quantiles), and gives Catalyst an
exact size: whether the next join broadcasts it is then decided by
``spark.sql.autoBroadcastJoinThreshold`` against bytes that were really written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_scratch: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strataflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, or of the open :func:`scratch`."""
    return _scratch[-1] if _scratch else f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are dropped at the end; results must be written elsewhere by then."""
    path = f"{run_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch.append(path)
    try:
        yield
    finally:
        _scratch.remove(path)
        drop_folder(spark, path)


def release(spark: SparkSession) -> None:
    """Drop all intermediate tables of this application; frames that read them are void."""
    drop_folder(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it is done, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ordered_parts(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``order``; ``_part`` numbers the ranges in that order.

    A running total is the sum inside a row's range plus the totals of the ranges below, so no
    window spans a whole group, however large.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return materialize(ranged.withColumn("_part", F.spark_partition_id()), name)


def open_table(path: str) -> pa.Table | None:
    """A small written table of the shared folder, opened inside a task; None where nothing was written."""
    scheme, _, rest = path.partition(":")
    if path.startswith("/") or scheme == "file":
        files, inner = pafs.LocalFileSystem(), path if path.startswith("/") else "/" + rest.lstrip("/")
    else:
        files, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    try:
        return pq.read_table(inner, filesystem=files, partitioning=None)
    except FileNotFoundError:
        return None


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"
