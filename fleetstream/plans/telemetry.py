"""The events table read as telemetry: truck events, traffic readings, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetstream.config import FeatureScaling, FleetConfig
from fleetstream.functions.lines import render
from fleetstream.operators.render import raw_truck_lines, traffic_lines
from fleetstream.schemas import ENRICHED_TRUCK_FIELDS, names

# One batch per hour keeps the default proportions of 2 : 6 : 2 seconds at the
# table's pace of one event every few minutes or faster.
HOURLY = FleetConfig(
    batch_interval="1 hour", window_length="3 hours", window_slide="1 hour"
)

# Ranges of the derived columns, so that training with the default step converges.
SCALING = FeatureScaling(
    offsets=(0.0, 30.0, -90.0, 0.0, 0.0, 0.0, 0.0),
    scales=(10.0, 10.0, 1.0, 500.0, 1.0, 1.0, 3.0),
)
SCALED = FleetConfig(
    batch_interval="1 hour",
    window_length="3 hours",
    window_slide="1 hour",
    scaling=SCALING,
)


def events(spark: SparkSession, sf_dir: str, slice: Column | None = None) -> DataFrame:
    # Arrival is a UTC clock reading; the table stores it without a zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    rows = rows.withColumn("arrival", F.col("ts").cast("timestamp"))
    return rows if slice is None else rows.where(slice)


def truck_of(events: DataFrame) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    kind = F.col("event_type")
    return events.where(kind != "view").select(
        "arrival",
        event,
        F.unix_millis("arrival").alias("event_time"),
        (event % 50).cast("int").alias("truck_id"),
        user.cast("int").alias("driver_id"),
        F.concat(F.lit("driver "), user).alias("driver_name"),
        (user % 10).cast("int").alias("route_id"),
        F.concat(F.lit("route "), user % 10).alias("route_name"),
        (F.lit(30) + (event % 1000) / F.lit(100.0)).alias("latitude"),
        (F.lit(-90) - (user % 7) / F.lit(8.0)).alias("longitude"),
        F.floor("value").cast("int").alias("speed"),
        F.when(kind == "click", "Normal")
        .when(kind == "error", "Speeding")
        .when(kind == "purchase", "Lane Departure")
        .otherwise("Violation")
        .alias("event_type"),
        (event % 2).cast("int").alias("foggy"),
        (user % 2).cast("int").alias("rainy"),
        (event % 4).cast("int").alias("windy"),
    )


def traffic_of(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "view").select(
        "arrival",
        "event_id",
        F.unix_millis("arrival").alias("event_time"),
        (F.col("user_id") % 10).cast("int").alias("route_id"),
        (F.floor("value").cast("int") % 10).alias("congestion_level"),
    )


def truck(spark: SparkSession, sf_dir: str, slice: Column | None = None) -> DataFrame:
    return truck_of(events(spark, sf_dir, slice))


def traffic(spark: SparkSession, sf_dir: str, slice: Column | None = None) -> DataFrame:
    return traffic_of(events(spark, sf_dir, slice))


def truck_raw(spark: SparkSession, sf_dir: str, slice: Column | None = None) -> DataFrame:
    """The truck events as the lines trucks send."""
    return raw_truck_lines(truck(spark, sf_dir, slice), carry=("arrival",))


def traffic_raw(spark: SparkSession, sf_dir: str, slice: Column | None = None) -> DataFrame:
    return traffic_lines(traffic(spark, sf_dir, slice), carry=("arrival",))


def broken_truck_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All truck lines; some event types send a fractional speed or no last field."""
    kind = F.col("event_type")
    speed = F.when(kind == "Speeding", F.concat("speed", F.lit(".5"))).otherwise(
        F.col("speed").cast("string")
    )
    last = F.when(kind == "Violation", F.lit("")).otherwise(F.lit("0"))
    parts = [speed if c == "speed" else c for c in names(ENRICHED_TRUCK_FIELDS)]
    return truck(spark, sf_dir).select("arrival", render(*parts, last).alias("value"))
