"""Adapters: the generated star-schema tables in the shape of the table contracts.

The tables hold no NULLs and no negative prices, so some are derived by fixed rules.
"""

from __future__ import annotations

from dataclasses import replace
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.clean import enforce_schema
from strataflow.sources.bindings import SOURCES, SourceConfig, TripBinding, WeatherBinding
from strataflow.sources.contracts import contract
from strataflow.storage import new_path

ADAPTED_TRIPS = TripBinding("pickup", "dropoff", tag_col="taxi_type", ingested=None)
ADAPTED_WEATHER = WeatherBinding(tie_break=("o_totalprice", "o_custkey"), ingested=None)
RUN_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips: both types in one scan, told apart by ``taxi_type``."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part, quantity = F.col("l_partkey"), F.col("l_quantity")
    pickup = F.col("o_orderdate").cast("timestamp")
    negative = (F.col("l_linenumber") == 7) & (quantity < 10)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green").alias("taxi_type"),
        F.when(part % 50 != 0, F.col("l_suppkey").cast("string")).alias("vendorID"),
        pickup.alias("pickup"),
        F.when(part % 40 != 0, F.col("l_shipdate").cast("timestamp")).alias("dropoff"),
        F.col("l_linenumber").cast("int").alias("passengerCount"),
        F.when(quantity != 50, quantity).alias("tripDistance"),
        F.when(part % 30 != 0, (part % 10).cast("string")).alias("puLocationId"),
        (F.col("l_suppkey") % 10).cast("string").alias("doLocationId"),
        F.col("l_returnflag").alias("paymentType"),
        F.when(negative, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("fareAmount"),
        (quantity * F.col("l_linenumber") / 4).alias("tipAmount"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("totalAmount"),
        F.year(pickup).alias("puYear"),
        F.month(pickup).alias("puMonth"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as station observations; on every 13th of a month all measurements failed."""
    customer = F.col("o_custkey")
    observed = F.col("o_orderdate").cast("timestamp")
    measured = F.dayofmonth(observed) != 13
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("stationName"),
        observed.alias("datetime"),
        F.lit(40.7).alias("latitude"),
        F.lit(-74.0).alias("longitude"),
        F.when(measured, (customer % 400) / F.lit(8.0)).alias("temperature"),
        F.when(measured, (customer % 30).cast("double")).alias("windSpeed"),
        F.when(measured & (customer % 7 != 0), (customer % 7).cast("double")).alias("precipDepth"),
        F.year(observed).alias("year"),
        F.month(observed).alias("month"),
        "o_totalprice",
        "o_custkey",
    )


def landing_schema(cfg: SourceConfig):
    """The source's own columns: its raw contract without the audit columns."""
    fields = [f for f in cfg.contract.fields if not f.name.startswith("_")]
    return type(cfg.contract)(fields)


def _landing_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "noaa_weather":
        rows = weather(spark, sf_dir).drop("o_totalprice", "o_custkey")
        return rows.withColumn("day", F.dayofmonth("datetime"))
    cfg, taxi_type = SOURCES[name], name.removeprefix("nyctaxi_")
    dropoff = cfg.ts_col.replace("Pickup", "Dropoff")
    return (
        trips(spark, sf_dir)
        .where(F.col("taxi_type") == taxi_type)
        .drop("taxi_type")
        .withColumnsRenamed({"pickup": cfg.ts_col, "dropoff": dropoff})
    )


@lru_cache(maxsize=None)
def _land(spark: SparkSession, sf_dir: str, name: str) -> str:
    cfg = SOURCES[name]
    rows, _ = enforce_schema(_landing_rows(spark, sf_dir, name), landing_schema(cfg))
    path = new_path(spark, f"landing_{name}")
    # One shuffle by month; AQE splits a month that is too large and merges small ones.
    rebalanced = rows.hint("rebalance", F.col(cfg.year_col), F.col(cfg.month_col))
    rebalanced.write.partitionBy(cfg.year_col, cfg.month_col).parquet(path)
    return path


def landed_source(spark: SparkSession, sf_dir: str, name: str) -> SourceConfig:
    """A registered source whose files were derived from the tables, split by year and month."""
    cfg = SOURCES[name]
    return replace(cfg, path=_land(spark, sf_dir, name), schema=landing_schema(cfg))


# Column list of the orders table, given to readers of formats that carry no types.
ORDERS_SCHEMA = contract(
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    "o_orderdate timestamp, o_orderpriority string"
)
