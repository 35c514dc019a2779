"""Cleansing: slices, quality filter, surrogate key, deduplication, contracts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources.bindings import TripBinding, WeatherBinding
from strataflow.sources.contracts import SILVER_TRIPS, SILVER_WEATHER


def period(year: int, month: int | None = None) -> tuple[str, str]:
    """First day of the year or month, and first day after it."""
    if month is None:
        return date(year, 1, 1).isoformat(), date(year + 1, 1, 1).isoformat()
    after = date(year + month // 12, month % 12 + 1, 1)
    return date(year, month, 1).isoformat(), after.isoformat()


def within(ts_col: str, year: int, month: int | None = None) -> Column:
    """Half-open range on the raw timestamp, so it reaches the scan as a pushed filter."""
    start, end = (F.lit(day).cast("timestamp") for day in period(year, month))
    return (F.col(ts_col) >= start) & (F.col(ts_col) < end)


def slice_event_time(df: DataFrame, ts_col: str, year: int, month: int | None = None) -> DataFrame:
    return df.where(within(ts_col, year, month))


def filter_quality(df: DataFrame, b: TripBinding) -> DataFrame:
    """Keep rows with non-negative fare and distance; NULL measures fail as well."""
    return df.where(
        (F.col(b.fare) >= 0) & (F.col(b.distance) >= 0) & F.col(b.pickup).isNotNull()
    )


def rejects(df: DataFrame, b: TripBinding) -> DataFrame:
    """Rows ``filter_quality`` drops, with every reason that applies."""
    checks = {
        "null_fare": F.col(b.fare).isNull(),
        "negative_fare": F.col(b.fare) < 0,
        "null_distance": F.col(b.distance).isNull(),
        "negative_distance": F.col(b.distance) < 0,
        "null_pickup": F.col(b.pickup).isNull(),
    }
    reasons = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in checks.items())))
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def key_text(b: TripBinding) -> Column:
    """Vendor, pickup time (as UTC text) and pickup location in one string: equal where the surrogate keys are."""
    return F.concat_ws(
        "|",
        F.coalesce(F.col(b.vendor), F.lit("")),
        F.col(b.pickup).cast("string"),
        F.coalesce(F.col(b.pu_location), F.lit("")),
    )


def surrogate_key(b: TripBinding) -> Column:
    """SHA-256 over :func:`key_text`."""
    return F.sha2(key_text(b), 256)


def dedup_latest(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str], ingested: str | None = None
) -> DataFrame:
    """One row per key: latest ingest first, then a total order over the payload.

    ``row_number() = 1`` plans as a window group limit that already runs before the
    shuffle, so a key holding a large share of the rows sends one row per map task.
    """
    order = [F.desc_nulls_last(ingested)] if ingested else []
    order += [F.asc_nulls_last(name) for name in tie_break]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def minutes_between(start: str, end: str) -> Column:
    """Whole seconds / 60; may be negative, NULL when either end is NULL."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return seconds.cast("double") / F.lit(60.0)


def _ingested(df: DataFrame, name: str | None) -> str | None:
    return name if name in df.columns else None


def silver_trips(df: DataFrame, b: TripBinding, run_ts: str | None = None, ranged: bool = False) -> DataFrame:
    """Quality filter → key → dedup → derived columns → contract columns, by name.

    ``ranged`` deals the rows for deduplication by ranges of pickup time and key instead of hashes, so the result is
    clustered without another shuffle; rows of one key are then not limited before they are dealt.
    """
    tag = F.col(b.tag_col) if b.tag_col else F.lit(b.tag)
    # Rows are dealt with the key's text and what the result needs; the hash, twice as long and not compressible, is
    # formed of the rows that stay.
    keyed = filter_quality(df, b)
    ingested = _ingested(df, b.ingested)
    needed = dict.fromkeys([b.pickup, b.pu_location, *b.tie_break, *([ingested] if ingested else [])])
    keyed = keyed.select(*needed, key_text(b).alias("_key"), tag.alias("_tag"))
    # The key determines the pickup time; naming it lets filters on dates pass the window.
    keys = [b.pickup, "_key", "_tag"]
    keyed = keyed.repartitionByRange(b.pickup, "_key") if ranged else keyed
    unique = dedup_latest(keyed, keys, b.tie_break, ingested)
    return unique.select(
        F.sha2("_key", 256).alias("trip_id"),
        F.col(b.pickup).alias("pickup_ts"),
        F.col(b.dropoff).alias("dropoff_ts"),
        minutes_between(b.pickup, b.dropoff).alias("trip_duration_min"),
        F.col(b.passengers).cast("int").alias("passenger_count"),
        F.col(b.distance).alias("trip_distance"),
        F.col(b.pu_location).alias("pu_location_id"),
        F.col(b.do_location).alias("do_location_id"),
        F.col(b.payment).alias("payment_type"),
        F.col(b.fare).alias("fare_amount"),
        F.col(b.tip).alias("tip_amount"),
        F.col(b.total).alias("total_amount"),
        F.col("_tag").alias("taxi_type"),
        F.to_date(F.col(b.pickup)).cast("string").alias("pickup_date"),
        run_time(run_ts).alias("_silver_ts"),
    ).select(*SILVER_TRIPS.names)


def silver_weather(df: DataFrame, b: WeatherBinding, run_ts: str | None = None) -> DataFrame:
    """Observations with a time, one per (station, time), in contract columns."""
    unique = dedup_latest(
        df.where(F.col(b.ts).isNotNull()), [b.station, b.ts], b.tie_break, _ingested(df, b.ingested)
    )
    return unique.select(
        F.col(b.station).alias("station_name"),
        F.col(b.ts).alias("weather_ts"),
        F.col(b.latitude).alias("latitude"),
        F.col(b.longitude).alias("longitude"),
        F.col(b.temperature).alias("temperature_c"),
        F.col(b.wind_speed).alias("wind_speed_ms"),
        F.col(b.precip_depth).alias("precip_depth_mm"),
        F.to_date(F.col(b.ts)).cast("string").alias("weather_date"),
        run_time(run_ts).alias("_silver_ts"),
    ).select(*SILVER_WEATHER.names)


def run_time(run_ts: str | None) -> Column:
    """The job's one timestamp; query start time when none is given."""
    return F.current_timestamp() if run_ts is None else F.lit(str(run_ts)).cast("timestamp")


def as_of(df: DataFrame, ts: str, ingested: str = "_ingested_ts") -> DataFrame:
    """The append-only raw table as it was at ``ts``."""
    return df.where(F.col(ingested) <= F.lit(ts).cast("timestamp"))


def _contract_columns(df: DataFrame, schema: T.StructType) -> tuple[list[Column], list[Column]]:
    """The contract's columns in its types, and a reason (or null) for each way to break it.

    Absent nullable columns become NULL; unknown columns and absent required ones are errors.
    """
    extra = [name for name in df.columns if name not in schema.names]
    absent = [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
    if extra or absent:
        raise ValueError(f"schema mismatch: unexpected columns {extra}, missing required {absent}")

    present = set(df.columns)
    casts, checks = [], []
    for field in schema.fields:
        if field.name not in present:
            casts.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(field.name)
        value = raw if df.schema[field.name].dataType == field.dataType else raw.try_cast(field.dataType)
        casts.append(value.alias(field.name))
        if value is not raw:
            checks.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"bad_type:{field.name}")))
        if not field.nullable:
            checks.append(F.when(raw.isNull(), F.lit(f"null:{field.name}")))
    return casts, checks


def _violations(checks: list[Column]) -> Column:
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid in contract types, quarantine with the violations)."""
    casts, checks = _contract_columns(df, schema)
    violations = _violations(checks)
    valid = df.where(F.size(violations) == 0).select(*casts)
    quarantine = df.withColumn("violations", violations).where(F.size("violations") > 0)
    return valid, quarantine


def checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows in contract types, for one pass over the source.

    A row that breaks the contract has its ``violations`` and, as JSON in ``_raw``, its values as they were
    read; both are null in a valid row.
    """
    casts, checks = _contract_columns(df, schema)
    found = F.when(F.size(_violations(checks)) > 0, _violations(checks))
    raw = F.when(F.size(_violations(checks)) > 0, F.to_json(F.struct(*(F.col(c) for c in df.columns))))
    return df.select(*casts, found.alias("violations"), raw.alias("_raw"))
