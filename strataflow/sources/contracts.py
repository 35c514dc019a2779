"""Table contracts, one ``StructType`` per layer table.

Fixed values: the column names, types, order and nullability are the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def contract(ddl: str) -> T.StructType:
    """``"name type, name! type"`` → StructType; ``!`` marks a column that may not be null."""
    fields = []
    for item in ddl.split(","):
        name, type_name = item.split()
        fields.append(T.StructField(name.rstrip("!"), _TYPES[type_name], not name.endswith("!")))
    return T.StructType(fields)


_AUDIT = "_ingested_ts! timestamp, _source_file! string, _source_name! string"

BRONZE_YELLOW = contract(
    "vendorID string, tpepPickupDatetime! timestamp, tpepDropoffDatetime timestamp,"
    "passengerCount int, tripDistance double, puLocationId string, doLocationId string,"
    "rateCodeId int, storeAndFwdFlag string, paymentType string, fareAmount double,"
    "extra double, mtaTax double, improvementSurcharge double, tipAmount double,"
    "tollsAmount double, totalAmount double, puYear int, puMonth int," + _AUDIT
)

BRONZE_GREEN = contract(
    "vendorID string, lpepPickupDatetime! timestamp, lpepDropoffDatetime timestamp,"
    "passengerCount int, tripDistance double, puLocationId string, doLocationId string,"
    "rateCodeId int, storeAndFwdFlag string, paymentType string, fareAmount double,"
    "extra double, mtaTax double, tipAmount double, tollsAmount double, totalAmount double,"
    "tripType string, puYear int, puMonth int," + _AUDIT
)

BRONZE_WEATHER = contract(
    "stationName string, datetime! timestamp, latitude double, longitude double,"
    "elevation double, windAngle double, windSpeed double, temperature double,"
    "dewPoint double, seaLvlPressure double, precipTime double, precipDepth double,"
    "snowDepth double, year int, month int, day int," + _AUDIT
)

SILVER_TRIPS = contract(
    "trip_id! string, pickup_ts! timestamp, dropoff_ts timestamp, trip_duration_min double,"
    "passenger_count int, trip_distance double, pu_location_id string, do_location_id string,"
    "payment_type string, fare_amount double, tip_amount double, total_amount double,"
    "taxi_type! string, pickup_date! string, _silver_ts! timestamp"
)

SILVER_WEATHER = contract(
    "station_name string, weather_ts! timestamp, latitude double, longitude double,"
    "temperature_c double, wind_speed_ms double, precip_depth_mm double,"
    "weather_date! string, _silver_ts! timestamp"
)

GOLD_DAILY = contract(
    "summary_date! string, taxi_type! string, pu_location_id string, trip_count! bigint,"
    "avg_fare double, avg_tip double, avg_distance double, avg_duration_min double,"
    "avg_temperature_c double, avg_precip_depth_mm double, _gold_ts! timestamp"
)
