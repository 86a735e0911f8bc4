"""Typed rows to lines. Columns other than the record's are carried along."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetstream.functions.lines import render
from fleetstream.schemas import (
    ENRICHED_FIELDS,
    ENRICHED_TRUCK_FIELDS,
    TRAFFIC_FIELDS,
    TRUCK_FIELDS,
    names,
)


def _lines(df: DataFrame, columns, carry) -> DataFrame:
    return df.select(*carry, render(*columns).alias("value"))


def traffic_lines(df: DataFrame, carry=()) -> DataFrame:
    return _lines(df, names(TRAFFIC_FIELDS), carry)


def truck_lines(df: DataFrame, carry=()) -> DataFrame:
    """Ten fields: the record without weather."""
    return _lines(df, names(TRUCK_FIELDS), carry)


def enriched_truck_lines(df: DataFrame, carry=()) -> DataFrame:
    """Thirteen fields: the record with weather."""
    return _lines(df, names(ENRICHED_TRUCK_FIELDS), carry)


def raw_truck_lines(df: DataFrame, unknown=None, carry=()) -> DataFrame:
    """Fourteen fields, as trucks send them."""
    last = F.lit("0") if unknown is None else unknown
    return _lines(df, [*names(ENRICHED_TRUCK_FIELDS), last], carry)


def enriched_lines(df: DataFrame, carry=()) -> DataFrame:
    return _lines(df, names(ENRICHED_FIELDS), carry)


def stats_lines(df: DataFrame, carry=()) -> DataFrame:
    """Seven fields, the four averages in single precision."""
    averages = [
        F.col(c).cast("float") for c in ("average_speed", "fog", "rain", "wind")
    ]
    return _lines(
        df,
        [F.col("driver_id"), *averages, F.col("total_violations"), F.col("total_events")],
        carry,
    )


def prediction_lines(df: DataFrame, carry=()) -> DataFrame:
    return _lines(df, [F.col("prediction")], carry)
