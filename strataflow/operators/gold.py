"""Daily aggregates. Both sides are aggregated first; the join sees one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.clean import run_time
from strataflow.operators.sinks import MONTH
from strataflow.sources.contracts import GOLD_DAILY


def _on_dates(df: DataFrame, column: str, dates: Sequence[str] | None) -> DataFrame:
    """The given dates; a table split by month also skips its other months."""
    if dates is None:
        return df
    if MONTH in df.columns:
        df = df.where(F.col(MONTH).isin(sorted({day[:7] for day in dates})))
    return df.where(F.col(column).isin(list(dates)))


def trip_daily(trips: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Count and means per (date, type, pickup location); a NULL location is its own group."""
    return (
        _on_dates(trips, "pickup_date", dates)
        .groupBy(F.col("pickup_date").alias("summary_date"), "taxi_type", "pu_location_id")
        .agg(
            F.count("*").alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg("trip_distance").alias("avg_distance"),
            F.avg("trip_duration_min").alias("avg_duration_min"),
        )
    )


def weather_daily(weather: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Mean temperature and precipitation per date over all stations."""
    return (
        _on_dates(weather, "weather_date", dates)
        .groupBy("weather_date")
        .agg(
            F.avg("temperature_c").alias("avg_temperature_c"),
            F.avg("precip_depth_mm").alias("avg_precip_depth_mm"),
        )
    )


def gold_daily_summary(
    trips: DataFrame,
    weather: DataFrame | None = None,
    dates: Sequence[str] | None = None,
    run_ts: str | None = None,
) -> DataFrame:
    """Trip summary left-joined to the day's weather; any number of dates in one pass."""
    daily = trip_daily(trips, dates)
    if weather is None:
        joined = daily.select(
            "*",
            F.lit(None).cast("double").alias("avg_temperature_c"),
            F.lit(None).cast("double").alias("avg_precip_depth_mm"),
        )
    else:
        context = weather_daily(weather, dates).withColumnRenamed("weather_date", "summary_date")
        joined = daily.join(context, "summary_date", "left")
    return joined.withColumn("_gold_ts", run_time(run_ts)).select(*GOLD_DAILY.names)


def daily_operations_summary(
    events: DataFrame, ts: str, source: str, category: str, critical: str, value: str
) -> DataFrame:
    """Events per (date, source system, category): count, critical count, mean value."""
    return events.groupBy(
        F.to_date(F.col(ts)).cast("string").alias("summary_date"),
        F.col(source).alias("source_system"),
        F.col(category).alias("category"),
    ).agg(
        F.count("*").alias("event_count"),
        F.count_if(F.col(critical)).alias("critical_count"),
        F.avg(value).alias("avg_numeric_value"),
    )
