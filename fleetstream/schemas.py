"""Record layouts, event vocabulary and feature order."""

from __future__ import annotations

from pyspark.sql import types as T

# The wire layouts, event vocabulary and feature order below are
# the data contract and must not change.

LONG, INT, DOUBLE, STRING = "long", "int", "double", "string"

SPARK_TYPES = {
    LONG: T.LongType(),
    INT: T.IntegerType(),
    DOUBLE: T.DoubleType(),
    STRING: T.StringType(),
}

TRAFFIC_FIELDS = (
    ("event_time", LONG),
    ("route_id", INT),
    ("congestion_level", INT),
)

TRUCK_FIELDS = (
    ("event_time", LONG),
    ("truck_id", INT),
    ("driver_id", INT),
    ("driver_name", STRING),
    ("route_id", INT),
    ("route_name", STRING),
    ("latitude", DOUBLE),
    ("longitude", DOUBLE),
    ("speed", INT),
    ("event_type", STRING),
)

WEATHER_FIELDS = (("foggy", INT), ("rainy", INT), ("windy", INT))

ENRICHED_TRUCK_FIELDS = TRUCK_FIELDS + WEATHER_FIELDS
ENRICHED_FIELDS = ENRICHED_TRUCK_FIELDS + (("congestion_level", INT),)

# A truck line carries one more field than the record keeps.
TRUCK_LINE_FIELDS = ENRICHED_TRUCK_FIELDS + (("unknown", STRING),)

NORMAL = "Normal"
KNOWN_VIOLATIONS = (
    "Speeding",
    "Lane Departure",
    "Unsafe Follow Distance",
    "Unsafe Tail Distance",
)

FEATURES = (
    "route_id",
    "latitude",
    "longitude",
    "speed",
    "foggy",
    "rainy",
    "windy",
)


def struct_of(fields) -> T.StructType:
    return T.StructType([T.StructField(n, SPARK_TYPES[k]) for n, k in fields])


def names(fields) -> list[str]:
    return [n for n, _ in fields]


LINES = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("arrival", T.TimestampType()),
    ]
)
TRAFFIC = struct_of(TRAFFIC_FIELDS)
TRUCK = struct_of(TRUCK_FIELDS)
ENRICHED_TRUCK = struct_of(ENRICHED_TRUCK_FIELDS)
ENRICHED = struct_of(ENRICHED_FIELDS)

# A row of the ingest log: typed fields, whether its group is hot, and its place.
def _logged(fields) -> T.StructType:
    return T.StructType(
        [
            T.StructField("arrival", T.TimestampType()),
            *struct_of(fields).fields,
            T.StructField("hot", T.BooleanType()),
            T.StructField("pos", T.LongType()),
            T.StructField("epoch", T.StringType()),
        ]
    )


LOGGED = {"truck": _logged(ENRICHED_TRUCK_FIELDS), "traffic": _logged(TRAFFIC_FIELDS)}
REJECTED = T.StructType([*LINES.fields, T.StructField("reason", T.StringType()), T.StructField("day", T.DateType())])

DRIVER_STATS = T.StructType(
    [
        T.StructField("driver_id", T.IntegerType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("fog", T.DoubleType()),
        T.StructField("rain", T.DoubleType()),
        T.StructField("wind", T.DoubleType()),
        T.StructField("total_violations", T.IntegerType()),
        T.StructField("total_events", T.LongType()),
    ]
)

# One row per trained logical batch. `weights_before` scores the batch,
# `weights` is what training on it left behind.
WEIGHTS = T.StructType(
    [
        T.StructField("bw", T.TimestampType()),
        T.StructField("weights_bw", T.TimestampType()),
        T.StructField("weights_before", T.ArrayType(T.DoubleType())),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("rows", T.DoubleType()),
        T.StructField("finite", T.BooleanType()),
    ]
)
