"""The whole job: raw ×3 → cleansed ×3 → drift (optional, not fatal) → daily summary."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators import clean, drift, evaluate, gold, sinks
from strataflow.sources import contracts
from strataflow.sources.bindings import WEATHER, SourceConfig, trip_binding
from strataflow.sources.reading import (
    event_month, in_months, layer_path, read_layer, read_optional, read_raw, read_source, slice_source, with_audit,
)
from strataflow.storage import scratch

log = logging.getLogger(__name__)

TRIP_SOURCES = {"nyctaxi_yellow": "yellow", "nyctaxi_green": "green"}
WEATHER_SOURCE = "noaa_weather"

RESULT = T.StructType([
    *(T.StructField(n, T.LongType()) for n in (
        "bronze_yellow_rows", "bronze_green_rows", "bronze_weather_rows", "silver_rows", "gold_rows",
    )),
    T.StructField("partition_date", T.StringType()),
    T.StructField("drift_status", T.StringType()),
])


@dataclass(frozen=True)
class JobParams:
    """``sources`` maps source names to their locations; ``dates`` default to today."""

    root: str
    sources: Mapping[str, SourceConfig]
    year: int
    month: int | None = None
    dates: tuple[str, ...] = ()
    run_drift: bool = True
    reference_year: int = drift.REFERENCE_YEAR
    psi_threshold: float = drift.PSI_THRESHOLD
    ks_threshold: float = drift.KS_THRESHOLD
    run_ts: str = field(default_factory=lambda: datetime.now(UTC).isoformat(sep=" "))
    run_id: str | None = None
    shared_trip_key: bool = False  # True: key is trip_id alone, across trip types

    @property
    def raw_run_id(self) -> str:
        """Own id, or one made of slice and run time: a later run of the same slice adds to the raw history."""
        return self.run_id or f"{self.year}-{self.month or 'all'}-{re.sub('[^0-9]', '', self.run_ts)}"

    @property
    def summary_dates(self) -> tuple[str, ...]:
        return self.dates or (date.today().isoformat(),)


def ingest(spark: SparkSession, p: JobParams, name: str) -> int:
    """Slice, audit, check against the contract, append: one pass over the source.

    Rows that break the contract lie in directories of their own (:func:`read_quarantine`) and are not counted.
    Trips are laid out by the month of their pickup, whatever slice they came with; weather by its slice columns.
    """
    cfg = p.sources[name]
    rows = with_audit(slice_source(read_source(spark, cfg), cfg, p.year, p.month), cfg, p.run_ts)
    checked = clean.checked(rows, cfg.contract or rows.schema)
    month = event_month(cfg, by_columns=name == WEATHER_SOURCE)
    return sinks.append_checked(checked, layer_path(p.root, "bronze", name), p.raw_run_id, month)


def raw_trips(spark: SparkSession, p: JobParams, name: str) -> DataFrame:
    """All ingested trips with a pickup in the run's slice; other months are not opened."""
    raw = read_raw(spark, p.root, name, p.sources[name].contract, p.year, p.month)
    return clean.slice_event_time(raw, trip_binding(TRIP_SOURCES[name]).pickup, p.year, p.month)


def raw_weather(spark: SparkSession, p: JobParams) -> DataFrame:
    cfg = p.sources[WEATHER_SOURCE]
    return slice_source(read_raw(spark, p.root, WEATHER_SOURCE, cfg.contract, p.year, p.month), cfg, p.year, p.month)


def cleanse_trips(spark: SparkSession, p: JobParams, name: str) -> int:
    rows = clean.silver_trips(raw_trips(spark, p, name), trip_binding(TRIP_SOURCES[name]), p.run_ts)
    # A key shared by the types may match a row of the other one, so these lie in one directory then.
    keys, split_by = (["trip_id"], []) if p.shared_trip_key else (["taxi_type", "trip_id"], ["taxi_type"])
    # The trip id is a hash over the pickup time among others.
    return sinks.write_upsert(layer_path(p.root, "silver", "nyctaxi"), rows, keys, "pickup_date", True, ["trip_id"], split_by)


def cleanse_weather(spark: SparkSession, p: JobParams) -> int:
    rows = clean.silver_weather(raw_weather(spark, p), WEATHER, p.run_ts)
    return sinks.write_upsert(
        layer_path(p.root, "silver", "weather"), rows, ["station_name", "weather_ts"], "weather_date", True, ["weather_ts"]
    )


COUNTS = T.StructType([
    T.StructField("taxi_type", T.StringType()), T.StructField("feature", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField(sinks.MONTH, T.StringType()),
])


def update_counts(spark: SparkSession, p: JobParams) -> DataFrame:
    """The stored counts of values per month, after counting the months of this run and those never counted.

    A month outside the run's slice has not changed since it was counted: the baseline year is counted once.
    """
    path = layer_path(p.root, "gold", "value_counts")
    both = in_months(p.reference_year, column=sinks.MONTH) | in_months(p.year, column=sinks.MONTH)
    trips = read_layer(spark, p.root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS)).where(both)
    counted = read_optional(spark, p.root, "gold", "value_counts", COUNTS)
    # At most the 24 months of two years; no column of the trips is read.
    months = {r[0] for r in trips.select(sinks.MONTH).distinct().collect()}
    known = set() if counted is None else {r[0] for r in counted.where(both).select(sinks.MONTH).distinct().collect()}
    changed = {m for m in months if m.startswith(f"{p.year:04d}-{'' if p.month is None else f'{p.month:02d}'}")}
    if due := sorted((months - known) | changed):
        rows = trips.where(F.col(sinks.MONTH).isin(due))
        sinks.replace_months(drift.value_counts(rows, drift.DRIFT_FEATURES, ["taxi_type", sinks.MONTH]), path)
    stored = read_optional(spark, p.root, "gold", "value_counts", COUNTS)
    return spark.createDataFrame([], COUNTS) if stored is None else stored


def check_drift(spark: SparkSession, p: JobParams) -> str:
    """Report and metric tables for the run; a failure is recorded and does not stop the job."""
    try:
        freq = drift.merged_frequency(
            update_counts(spark, p), in_months(p.reference_year, column=sinks.MONTH), in_months(p.year, column=sinks.MONTH))
        report = drift.report_of(freq, drift.DRIFT_FEATURES, p.psi_threshold, p.ks_threshold)
        path = layer_path(p.root, "gold", f"drift_report/run={p.raw_run_id}")
        report.write.mode("overwrite").parquet(path)
        metrics = evaluate.drift_metrics(spark.read.schema(report.schema).parquet(path), p.run_ts)
        metrics.write.mode("overwrite").parquet(layer_path(p.root, "gold", f"metrics/run={p.raw_run_id}"))
        return "ok"
    except Exception as error:  # noqa: BLE001 - any drift failure is reported, none is fatal
        log.exception("drift check failed")
        return f"failed: {type(error).__name__}"


def summarize(spark: SparkSession, p: JobParams) -> int:
    trips = read_layer(spark, p.root, "silver", "nyctaxi", sinks.monthly(contracts.SILVER_TRIPS))
    weather = read_optional(spark, p.root, "silver", "weather", sinks.monthly(contracts.SILVER_WEATHER))
    summary = gold.gold_daily_summary(trips, weather, p.summary_dates, p.run_ts)
    return sinks.replace_dates(layer_path(p.root, "gold", "daily_trip_summary"), summary, p.summary_dates)


def run(spark: SparkSession, p: JobParams) -> DataFrame:
    """One row: rows per layer, rebuilt dates, drift status. ``silver_rows`` counts trips only.

    Intermediate tables are dropped when the job ends.
    """
    with scratch(spark):
        return _run(spark, p)


def _run(spark: SparkSession, p: JobParams) -> DataFrame:
    bronze = {name: ingest(spark, p, name) for name in (*TRIP_SOURCES, WEATHER_SOURCE)}
    silver = sum(cleanse_trips(spark, p, name) for name in TRIP_SOURCES)
    cleanse_weather(spark, p)
    drift_status = check_drift(spark, p) if p.run_drift else "skipped"
    rows = summarize(spark, p)
    result = (
        *(bronze[name] for name in (*TRIP_SOURCES, WEATHER_SOURCE)),
        silver, rows, ",".join(p.summary_dates), drift_status,
    )
    return spark.createDataFrame([result], RESULT)
