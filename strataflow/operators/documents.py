"""Documents for a search index: building them from the daily summary, and batching them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.storage import materialize, ordered_parts

# Fixed value: documents per upload batch.
BATCH_SIZE = 500

def gold_documents(gold: DataFrame, digits: int = 2) -> DataFrame:
    """One document per daily-summary row: ``id``, a sentence, and its metadata."""
    def _number(column: str) -> Column:
        shown = F.format_string(f"%.{digits}f", F.round(F.col(column), digits))
        return F.when(F.col(column).isNull(), F.lit("n/a")).otherwise(shown)

    location = F.coalesce("pu_location_id", F.lit("unknown"))
    content = F.concat(
        F.lit("On "), "summary_date", F.lit(", "), "taxi_type", F.lit(" trips from zone "), location,
        F.lit(": "), F.col("trip_count").cast("string"), F.lit(" trips, average fare "), _number("avg_fare"),
        F.lit(", tip "), _number("avg_tip"), F.lit(", distance "), _number("avg_distance"),
        F.lit(", duration "), _number("avg_duration_min"), F.lit(" min, temperature "),
        _number("avg_temperature_c"), F.lit(" C, precipitation "), _number("avg_precip_depth_mm"), F.lit(" mm."),
    )
    key = F.concat_ws("|", "summary_date", "taxi_type", F.coalesce("pu_location_id", F.lit("")))
    return gold.select(
        F.sha2(key, 256).alias("id"),
        content.alias("content"),
        F.create_map(
            F.lit("summary_date"), F.col("summary_date"),
            F.lit("taxi_type"), F.col("taxi_type"),
            F.lit("pu_location_id"), location,
        ).alias("metadata"),
    )


def assign_batches(spark: SparkSession, path: str, id_col: str = "id", size: int = BATCH_SIZE) -> DataFrame:
    """Written documents with a ``batch_id``: consecutive runs of ``size`` rows, in order of the files' names.

    A row's number is the rows of the files before it plus its position in its own file, so
    no documents are sorted or gathered, however often an id repeats. Reading the same files
    again, or a copy of them elsewhere, gives the same numbers.
    """
    rows = numbered(spark, path)
    return rows.select(
        F.floor(F.col("_number") / F.lit(size)).cast("bigint").alias("batch_id"),
        F.col(id_col).isNull().alias("missing_id"),
        *(c for c in rows.columns if c != "_number"),
    )


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """Written documents with their ``_number``, from 0 on, in order of the files' names."""
    rows = spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    return rows.join(_rows_before(rows), "_file").withColumn("_number", F.col("_before") + F.col("_row")).drop(
        "_file", "_row", "_before")


def _rows_before(rows: DataFrame) -> DataFrame:
    """Per file, the rows of all files before it: a small written table, broadcast if its size allows."""
    files = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    parts = ordered_parts(files, ["_file"], "batch_files")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range of files
    starts = parts.groupBy("_part").agg(F.sum("_n").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(parts.join(starts, "_part").select(
        "_file", (F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_before")), "batch_starts")


def write_batches(batched: DataFrame, path: str) -> DataFrame:
    """Write the documents as JSON lines; return the manifest with failed batches marked.

    A batch that holds a document without id fails as a whole and is not written. Every
    batch lies in one file, next to its neighbours.
    """
    manifest = materialize(batch_manifest(batched), "batch_manifest")
    failed = manifest.where("status = 'failed'").select("batch_id")
    good = batched.join(failed, "batch_id", "left_anti").drop("missing_id")
    good.repartitionByRange("batch_id").sortWithinPartitions("batch_id").write.mode("overwrite").json(path)
    return manifest


def batch_manifest(batched: DataFrame) -> DataFrame:
    return batched.groupBy("batch_id").agg(
        F.count("*").alias("n_docs"),
        F.count_if("missing_id").alias("n_missing_id"),
        F.when(F.bool_or("missing_id"), "failed").otherwise("ok").alias("status"),
    )


def n_indexed(manifest: DataFrame) -> DataFrame:
    """Documents in batches that succeeded; 0 for an empty corpus."""
    return manifest.agg(F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("n_docs"))), F.lit(0)).alias("n_indexed"))
