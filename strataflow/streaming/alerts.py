"""Alert rule over metric rows: maximum drift score per window above the threshold.

The rule reads ``(ts, feature, psi)``; :func:`psi_rows` makes such rows from the metric table
that the drift job writes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.storage import is_missing_path

# Fixed values of the alert rule.
ALERT_THRESHOLD = 0.2
ALERT_WINDOW = "5 minutes"
PSI_METRIC = "drift.psi"

METRICS = "metric string, attr_key string, attr_value string, value double, ts timestamp, run string"
ALERTS = "window_start timestamp, window_end timestamp, feature string, max_psi double"


def read_metrics(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The metric table of the job, one directory per run, as it is or as a stream of the runs to come."""
    return (spark.readStream if stream else spark.read).schema(METRICS).parquet(path)


def psi_rows(metrics: DataFrame) -> DataFrame:
    """Metric rows ``(metric, attr_key, attr_value, value, ts)`` of the drift score, as the rule reads them."""
    chosen = metrics.where((F.col("metric") == PSI_METRIC) & (F.col("attr_key") == "feature"))
    return chosen.select("ts", F.col("attr_value").alias("feature"), F.col("value").alias("psi"))


def drift_alerts(
    metrics: DataFrame,
    threshold: float = ALERT_THRESHOLD,
    window: str = ALERT_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Windows of ``metrics (ts, feature, psi)`` whose maximum exceeds the threshold.

    The same plan serves tables and streams. The watermark bounds a stream's state; rows later
    than it are dropped.
    """
    rows = metrics.withWatermark("ts", watermark) if watermark else metrics
    return (
        rows.groupBy(F.window("ts", window), "feature")
        .agg(F.max("psi").alias("max_psi"))
        .where((F.col("max_psi") > threshold) & ~F.isnan("max_psi"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "feature",
            "max_psi",
        )
    )


def write_alerts(alerts: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Start the alert stream into a table of updates.

    A window is written as soon as it exceeds the threshold, open or closed, and again when its maximum
    rises. Every micro-batch has a directory of its own that a repeated batch overwrites, so
    restarts lose and double nothing; :func:`read_alerts` shows the last state of each window.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={number}")

    writer = (
        alerts.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """One row per window and feature: a window's maximum only rises, so the largest is the last."""
    try:
        updates = spark.read.schema(f"{ALERTS}, _batch long").parquet(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], ALERTS)
    return updates.groupBy("window_start", "window_end", "feature").agg(F.max("max_psi").alias("max_psi"))
