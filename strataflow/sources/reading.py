"""Scans: registered sources, layer tables, year/month slices, audit columns."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources.bindings import SourceConfig
from strataflow.storage import is_missing_path

log = logging.getLogger(__name__)

# Directories of a raw table, below the one of the ingest: rows that keep the contract apart from those that break
# it, and the month a row belongs to. Rows without a time have a month of their own.
VALID = "_valid"
EVENT_MONTH = "_event_month"
NO_MONTH = "none"


class IngestionError(RuntimeError):
    """A source or layer table cannot be read or written."""


def _scan(spark: SparkSession, cfg: SourceConfig, path: str) -> DataFrame:
    reader = spark.read.format(cfg.format)
    if cfg.schema is not None:
        reader = reader.schema(cfg.schema)
    if cfg.format == "csv":
        reader = reader.option("header", "true")
    # Partition directories stay visible (no recursive lookup), so slices prune files.
    return reader.load(path)


def read_source(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Scan of the primary path, or of the fallback when the primary one does not exist.

    ``load`` already checks the path, so each path is listed (and inferred) once at most. Other
    errors are not hidden.
    """
    try:
        return _scan(spark, cfg, cfg.path)
    except AnalysisException as error:
        if cfg.fallback_path is None or not is_missing_path(error):
            raise IngestionError(f"Cannot read source {cfg.path!r} as {cfg.format}: {error}") from error
    log.warning("source %s: %s is missing, reading %s", cfg.name, cfg.path, cfg.fallback_path)
    try:
        return _scan(spark, cfg, cfg.fallback_path)
    except AnalysisException as error:
        raise IngestionError(f"Cannot read source {cfg.fallback_path!r} as {cfg.format}: {error}") from error


def slice_source(df: DataFrame, cfg: SourceConfig, year: int, month: int | None = None) -> DataFrame:
    """Year (and month) slice on the partition columns: becomes ``PartitionFilters``."""
    for name in (cfg.year_col,) if month is None else (cfg.year_col, cfg.month_col):
        if name not in df.columns:
            raise IngestionError(f"Cannot slice source {cfg.name!r}: no column {name!r}")
    sliced = df.where(F.col(cfg.year_col) == F.lit(year))
    return sliced if month is None else sliced.where(F.col(cfg.month_col) == F.lit(month))


def with_audit(df: DataFrame, cfg: SourceConfig, run_ts: datetime | str) -> DataFrame:
    """One run timestamp, the file each row came from, and the source name."""
    return df.select(
        "*",
        F.lit(str(run_ts)).cast("timestamp").alias("_ingested_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(cfg.name).alias("_source_name"),
    )


def event_month(cfg: SourceConfig, by_columns: bool = False) -> Column:
    """Month of a row by its own time, or by the columns that its source is sliced by."""
    month = F.date_format(cfg.ts_col, "yyyy-MM")
    if by_columns:
        year, number = F.col(cfg.year_col).cast("int"), F.col(cfg.month_col).cast("int")
        month = F.when(year.isNotNull() & number.isNotNull(), F.format_string("%04d-%02d", year, number))
    return F.coalesce(month, F.lit(NO_MONTH))


def in_months(year: int, month: int | None = None, column: str = EVENT_MONTH) -> Column:
    """Directories of a year or month."""
    if month is not None:
        return F.col(column) == f"{year:04d}-{month:02d}"
    return F.col(column).between(f"{year:04d}-01", f"{year:04d}-12")


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}_{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType) -> DataFrame:
    """Layer table by path, columns as in ``schema``, which keeps date-like directory names as strings."""
    path = layer_path(root, layer, table)
    try:
        return spark.read.schema(schema).parquet(path).select(schema.names)
    except AnalysisException as error:
        raise IngestionError(f"Cannot read table {path!r}: {error}") from error


def _read_raw(spark: SparkSession, root: str, table: str, contract: T.StructType) -> DataFrame:
    extra = T.StructType().add("violations", T.ArrayType(T.StringType())).add("_raw", "string").add("_ingest_id", "string")
    extra = extra.add(VALID, "boolean").add(EVENT_MONTH, "string")
    return read_layer(spark, root, "bronze", table, T.StructType([*contract.fields, *extra.fields]))


def read_raw(spark: SparkSession, root: str, table: str, contract: T.StructType, year: int | None = None,
             month: int | None = None) -> DataFrame:
    """Rows of a raw table that keep the contract, of all ingests; with a year (and month) only its directories."""
    rows = _read_raw(spark, root, table, contract).where(VALID)
    if year is not None:
        rows = rows.where(in_months(year, month))
    return rows.select(contract.names)


def read_quarantine(spark: SparkSession, root: str, table: str, contract: T.StructType) -> DataFrame:
    """Rows that break the contract: ``_ingest_id, violations, _raw`` (the row as it was read, as JSON)."""
    return _read_raw(spark, root, table, contract).where(~F.col(VALID)).select("_ingest_id", "violations", "_raw")


def read_optional(
    spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType
) -> DataFrame | None:
    """Layer table, or None when it was never written."""
    try:
        return spark.read.schema(schema).parquet(layer_path(root, layer, table)).select(schema.names)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        log.warning("optional table %s_%s not found", layer, table)
        return None
