from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from strataflow.catalog import queries
from strataflow.operators import clean
from strataflow.sources.bindings import WEATHER, SourceConfig, trip_binding
from strataflow.sources.contracts import BRONZE_YELLOW, SILVER_TRIPS, contract

SCHEMA = (
    "vendorID string, tpepPickupDatetime string, tpepDropoffDatetime string, passengerCount int,"
    "tripDistance double, puLocationId string, doLocationId string, paymentType string, fareAmount double,"
    "tipAmount double, totalAmount double, _ingested_ts string"
)
YELLOW = trip_binding("yellow")


def raw(spark, *rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tpepPickupDatetime", "tpepDropoffDatetime", "_ingested_ts"):
        df = df.withColumn(name, F.col(name).cast("timestamp"))
    return df


def row(vendor="1", pickup="2023-01-01 10:00:00", dropoff="2023-01-01 10:30:30", distance=1.5, pu="7",
        fare=10.0, ingested="2023-02-01 00:00:00"):
    return (vendor, pickup, dropoff, 1, distance, pu, "9", "card", fare, 1.0, 11.0, ingested)


def test_quality_filter_keeps_zero_and_drops_null_and_negative(spark):
    df = raw(spark, row(fare=0.0), row(fare=None), row(fare=-1.0), row(distance=None), row(distance=-0.5),
             row(pickup=None))
    assert clean.filter_quality(df, YELLOW).count() == 1
    reasons = {r for x in clean.rejects(df, YELLOW).collect() for r in x["reasons"]}
    assert reasons == {"null_fare", "negative_fare", "null_distance", "negative_distance", "null_pickup"}
    assert clean.rejects(df, YELLOW).count() + clean.filter_quality(df, YELLOW).count() == df.count()


def test_surrogate_key_is_sha256_of_vendor_time_location(spark):
    got = raw(spark, row(vendor=None)).select(clean.surrogate_key(YELLOW)).first()[0]
    assert got == hashlib.sha256(b"|2023-01-01 10:00:00|7").hexdigest()


def test_latest_ingest_survives_and_ties_are_total(spark):
    df = raw(spark, row(fare=1.0), row(fare=2.0, ingested="2023-03-01 00:00:00"), row(fare=3.0))
    assert [r["fare_amount"] for r in clean.silver_trips(df, YELLOW).collect()] == [2.0]
    tied = raw(spark, row(fare=5.0), row(fare=4.0), row(fare=None))
    assert [r["fare_amount"] for r in clean.silver_trips(tied, YELLOW).collect()] == [4.0]


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = clean.silver_trips(raw(spark, row()), YELLOW)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert "Python" not in plan


def test_duration_may_be_negative_or_null(spark):
    df = raw(spark, row(), row(pu="8", dropoff="2023-01-01 09:59:00"), row(pu="9", dropoff=None))
    got = {r["pu_location_id"]: r["trip_duration_min"] for r in clean.silver_trips(df, YELLOW).collect()}
    assert got == {"7": 30.5, "8": -1.0, "9": None}


def test_silver_has_the_contract_columns(spark):
    out = clean.silver_trips(raw(spark, row()), YELLOW, "2024-01-01 00:00:00")
    assert out.columns == SILVER_TRIPS.names
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in SILVER_TRIPS.fields]
    assert out.first()["taxi_type"] == "yellow" and out.first()["pickup_date"] == "2023-01-01"


def test_unknown_taxi_type_is_an_error():
    with pytest.raises(ValueError, match="purple"):
        trip_binding("purple")


@pytest.mark.parametrize("year,month,want", [
    (2023, None, ("2023-01-01", "2024-01-01")),
    (2023, 4, ("2023-04-01", "2023-05-01")),
    (2023, 12, ("2023-12-01", "2024-01-01")),
])
def test_period(year, month, want):
    assert clean.period(year, month) == want


def test_event_time_slice_is_half_open(spark):
    df = raw(spark, row(pickup="2022-12-31 23:59:59"), row(pickup="2023-01-01 00:00:00"),
             row(pickup="2023-12-31 23:59:59"), row(pickup="2024-01-01 00:00:00"))
    assert clean.slice_event_time(df, "tpepPickupDatetime", 2023).count() == 2
    assert clean.slice_event_time(df, "tpepPickupDatetime", 2023, 1).count() == 1


def test_weather_is_unique_per_station_and_time(spark):
    schema = ("stationName string, datetime timestamp, latitude double, longitude double, temperature double,"
              "windSpeed double, precipDepth double")
    df = spark.createDataFrame([], schema).unionByName(spark.sql("""
        select * from values ('a', timestamp '2023-01-01 01:00:00', 1d, 2d, 5d, 1d, 0d),
                             ('a', timestamp '2023-01-01 01:00:00', 1d, 2d, 4d, 1d, 0d),
                             ('b', timestamp '2023-01-01 01:00:00', 1d, 2d, 6d, 1d, 0d),
                             ('b', null, 1d, 2d, 6d, 1d, 0d)
        as t(stationName, datetime, latitude, longitude, temperature, windSpeed, precipDepth)"""))
    got = {(r["station_name"], r["temperature_c"]) for r in clean.silver_weather(df, WEATHER).collect()}
    assert got == {("a", 4.0), ("b", 6.0)}


def test_as_of_ignores_later_ingests(spark):
    df = raw(spark, row(fare=1.0), row(fare=2.0, ingested="2023-03-01 00:00:00"))
    assert clean.as_of(df, "2023-02-15 00:00:00").count() == 1


def test_enforce_schema_splits_rows(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "1"), ("2", "oops"), ("3", None)], "a string, b string")
    valid, bad = clean.enforce_schema(df, contract("a! int, b double, c string"))
    assert [tuple(r) for r in valid.orderBy("a").collect()] == [(1, 2.5, None), (3, None, None)]
    assert {r["a"]: r["violations"] for r in bad.collect()} == {
        "x": ["bad_type:a"], None: ["null:a"], "2": ["bad_type:b"]}


def test_enforce_schema_rejects_unknown_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    with pytest.raises(ValueError, match="z"):
        clean.enforce_schema(df, contract("a int"))
    with pytest.raises(ValueError, match="b"):
        clean.enforce_schema(df.drop("z"), contract("a int, b! int"))


def test_bindings():
    assert SourceConfig("x", "p").month_col == "puMonth"
    assert SourceConfig("x", "p", year_col="year", month_col="month").month_col == "month"
    assert len(BRONZE_YELLOW.fields) == 22
    with pytest.raises(ValueError):
        SourceConfig("x", "p", format="avro")


def test_the_hashed_key_is_not_shuffled(spark):
    plan = clean.silver_trips(raw(spark, row()), YELLOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sha2(") < plan.index("Exchange") and "sha2(" not in plan[plan.index("Exchange"):]


def test_all_ingests_come_from_one_pass(spark, tmp_path):
    spark.sql("""select 1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 2D l_quantity, 10D l_extendedprice, 0D l_tax,
        'R' l_returnflag, x l_linestatus, timestamp'1998-02-01' l_shipdate from values ('F'), ('O') t(x)""").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.sql("select 1L o_orderkey, timestamp'1998-01-01' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    history = queries._raw_history(spark, str(tmp_path))
    got = sorted((r["taxi_type"], r["fareAmount"], r["_ingested_ts"].month) for r in history.collect())
    assert got == [("green", 10.0, 1), ("green", 11.0, 2), ("yellow", 10.0, 1)]
    assert history._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_ranged_trips_are_the_same_rows_clustered_by_one_shuffle(spark):
    rows = raw(spark, *(row(fare=float(i % 5), vendor=str(i % 3)) for i in range(20)))
    plain, ranged = (clean.silver_trips(rows, YELLOW, "2024-01-01 00:00:00", ranged) for ranged in (False, True))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    assert sorted(map(tuple, ranged.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
