"""Reporting views over the daily summary, as Spark SQL with named parameters."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.sinks import MONTH

# Dates are ISO strings, so the bound is compared as a string and stays a partition filter.
_SINCE = "cast(date_sub(to_date(:as_of), {days}) as string)"

DAILY_TRIP_SUMMARY = f"""
select summary_date, taxi_type, pu_location_id, trip_count, avg_fare, avg_tip,
       case when avg_fare > 0 then avg_tip / avg_fare end as tip_rate,
       avg_distance, avg_duration_min, avg_temperature_c, avg_precip_depth_mm,
       _gold_ts as refreshed_at
from {{gold}}
where summary_date >= {_SINCE.format(days=':days')}
"""

KPI_LAST_DAYS = f"""
select taxi_type, pu_location_id,
       sum(trip_count) as total_trips,
       avg(avg_fare) as avg_fare_7d,
       avg(try_divide(avg_tip, avg_fare)) as avg_tip_rate_7d,
       avg(avg_distance) as avg_distance_7d,
       avg(avg_duration_min) as avg_duration_7d,
       avg(avg_temperature_c) as avg_temp_c_7d,
       max(_gold_ts) as last_refresh
from {{gold}}
where summary_date >= {_SINCE.format(days=':days')}
group by taxi_type, pu_location_id
"""

YEARLY_FARE_DISTRIBUTION = """
select left(summary_date, 4) as pickup_year, taxi_type,
       count(*) as day_count,
       avg(avg_fare) as mean_fare, min(avg_fare) as min_fare, max(avg_fare) as max_fare
from {gold}
group by left(summary_date, 4), taxi_type
"""

FACT_OPERATIONS = """
select cast(summary_date as date) as `Date`, source_system as `Source System`,
       category as `Category`, event_count as `Event Count`,
       critical_count as `Critical Count`, avg_numeric_value as `Avg Numeric Value`
from {operations}
"""


def _today(as_of: str | None) -> str:
    return as_of or date.today().isoformat()


def _recent(gold: DataFrame, as_of: str, days: int) -> DataFrame:
    """A table split by month also skips the months before the window."""
    if MONTH not in gold.columns:
        return gold
    first = (date.fromisoformat(as_of) - timedelta(days=days)).isoformat()
    return gold.where(F.col(MONTH) >= first[:7])


def view_daily_trip_summary(gold: DataFrame, as_of: str | None = None, days: int = 90) -> DataFrame:
    day = _today(as_of)
    return gold.sparkSession.sql(
        DAILY_TRIP_SUMMARY, args={"as_of": day, "days": days}, gold=_recent(gold, day, days)
    )


def view_kpi(gold: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Unweighted means of the daily means, per type and location."""
    day = _today(as_of)
    return gold.sparkSession.sql(
        KPI_LAST_DAYS, args={"as_of": day, "days": days}, gold=_recent(gold, day, days)
    )


def view_yearly_fare_distribution(gold: DataFrame) -> DataFrame:
    """``day_count`` counts (day, location) rows, as the source view does."""
    return gold.sparkSession.sql(YEARLY_FARE_DISTRIBUTION, gold=gold)


def fact_operations(operations: DataFrame) -> DataFrame:
    return operations.sparkSession.sql(FACT_OPERATIONS, operations=operations)


def dim_date(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """One row per calendar day between ``bounds`` (one row: first_day, last_day)."""
    day = F.explode(F.sequence(F.col("first_day"), F.col("last_day"))).alias("date_key")
    return bounds.select(day).select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        F.weekofyear("date_key").alias("week"),
        (F.weekday("date_key") < 5).alias("is_weekday"),
    )


def register_views(gold: DataFrame, as_of: str | None = None) -> None:
    """Expose the three views by name for SQL users."""
    view_daily_trip_summary(gold, as_of).createOrReplaceTempView("daily_trip_summary")
    view_kpi(gold, as_of).createOrReplaceTempView("kpi_last_7_days")
    view_yearly_fare_distribution(gold).createOrReplaceTempView("yearly_fare_distribution")
