"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC pins every timestamp <-> string conversion (surrogate keys hash such a string);
# AQE picks join strategies from measured sizes and splits skewed join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``master`` is only given for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
