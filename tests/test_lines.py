import random
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetstream.functions.lines import _at_most, line_pattern
from fleetstream.operators import parse, render
from fleetstream.schemas import TRAFFIC_FIELDS
from support import traffic_df, traffic_rows, truck_df, truck_rows

TRUCK_LINE = "1486669632837|30|5|A Driver|5|Joplin to Kansas City|75|42|68|Violation|1|0|3|17"

TRAFFIC_LINES = [
    ("1|5|3", None),
    ("1|5|", "expected 3 fields, found 2"),
    ("1|5|3|", None),
    ("1|5|3|||", None),
    ("1|5|3|9", "expected 3 fields, found 4"),
    ("", "expected 3 fields, found 1"),
    ("1| 5|3", "bad route_id"),
    ("1|5 |3", "bad route_id"),
    ("1|5.0|3", "bad route_id"),
    ("1|+5|3", None),
    ("1|-5|3", None),
    ("1|x|3", "bad route_id"),
    ("1||3", "bad route_id"),
    ("|5|3", "bad event_time"),
    ("1|2147483647|3", None),
    ("1|2147483648|3", "bad route_id"),
    ("1|-2147483648|3", None),
    ("1|-2147483649|3", "bad route_id"),
    ("1|00000000000005|3", None),
    ("9223372036854775807|5|3", None),
    ("9223372036854775808|5|3", "bad event_time"),
    ("-9223372036854775808|5|3", None),
    ("1|5|3\n", "bad congestion_level"),
    (None, "expected 3 fields, found 1"),
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("line, reason", TRAFFIC_LINES)
def test_traffic_edges(spark, line, reason):
    df = lines(spark, [line])
    good = parse.parse_traffic(df, "permissive").collect()
    bad = parse.quarantine_traffic(df).collect()
    if reason is None:
        assert len(good) == 1 and not bad
        assert None not in good[0]
        assert good[0]["route_id"] == int(line.split("|")[1])
    else:
        assert not good and [r["reason"] for r in bad] == [reason]
        with pytest.raises(PySparkException, match="malformed line"):
            parse.parse_traffic(df, "strict").collect()


def test_strict_check_survives_pruning(spark):
    df = lines(spark, ["1|5|3", "1|x|3"])
    with pytest.raises(PySparkException, match="malformed line"):
        parse.parse_traffic(df).count()


def test_truck_line(spark):
    row = parse.parse_truck(lines(spark, [TRUCK_LINE])).first()
    assert tuple(row) == (
        1486669632837, 30, 5, "A Driver", 5, "Joplin to Kansas City", 75.0, 42.0, 68,
        "Violation", 1, 0, 3,
    )


@pytest.mark.parametrize(
    "position, text, reason",
    [
        (13, "", "expected 14 fields, found 13"),
        (13, "x||", None),
        (3, "", None),
        (9, "", None),
        (6, "1e3", None),
        (6, " 1.5 ", None),
        (6, ".5", None),
        (6, "5.", None),
        (6, "1.5f", None),
        (6, "NaN", None),
        (6, "-Infinity", None),
        (6, "nan", "bad latitude"),
        (6, "inf", "bad latitude"),
        (6, "1,5", "bad latitude"),
        (8, "6.8", "bad speed"),
    ],
)
def test_truck_edges(spark, position, text, reason):
    parts = TRUCK_LINE.split("|")
    parts[position] = text
    df = lines(spark, ["|".join(parts)])
    good = parse.parse_truck(df, "permissive").collect()
    bad = parse.quarantine_truck(df).collect()
    if reason is None:
        assert len(good) == 1 and not bad and None not in good[0]
    else:
        assert not good and [r["reason"] for r in bad] == [reason]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**12), st.integers(10, 10**10))
def test_number_pattern(value, limit):
    assert bool(re.fullmatch(_at_most(limit), str(value))) == (value <= limit)


def test_every_line_is_kept_or_quarantined(spark):
    rng = random.Random(5)
    values = ["".join(rng.choice("019|x +-.") for _ in range(rng.randrange(12))) for _ in range(2000)]
    df = lines(spark, values)
    good = parse.parse_traffic(df, "permissive").count()
    bad = parse.quarantine_traffic(df).count()
    assert good + bad == len(values)
    pattern = re.compile(line_pattern(TRAFFIC_FIELDS).replace(r"\z", r"\Z"))
    assert good == sum(bool(pattern.match(v)) for v in values)


def test_render_then_parse_is_identity(spark):
    truck = truck_df(spark, truck_rows(200, 1))
    again = parse.parse_truck(render.raw_truck_lines(truck, carry=("arrival",)))
    assert sorted(again.collect()) == sorted(truck.collect())
    traffic = traffic_df(spark, traffic_rows(200, 2))
    again = parse.parse_traffic(render.traffic_lines(traffic, carry=("arrival",)))
    assert sorted(again.collect()) == sorted(traffic.collect())


def test_enriched_round_trip(spark):
    rows = truck_df(spark, truck_rows(50, 3)).withColumn("congestion_level", F.lit(4)).drop("arrival")
    again = parse.parse_enriched(render.enriched_lines(rows))
    assert sorted(again.collect()) == sorted(rows.collect())


def test_field_counts(spark):
    row = truck_df(spark, truck_rows(1, 4)).withColumn("congestion_level", F.lit(4))
    for to_lines, fields in (
        (render.truck_lines, 10), (render.enriched_truck_lines, 13),
        (render.raw_truck_lines, 14), (render.enriched_lines, 14),
    ):
        assert len(to_lines(row).first()["value"].split("|")) == fields


def test_parsing_is_one_scan_stage(spark):
    plan = parse.parse_truck(lines(spark, [TRUCK_LINE]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    assert plan.count("split(") == 1


def test_line_without_arrival(spark):
    """It belongs to no batch, so it must not vanish silently."""
    df = spark.createDataFrame([("1|5|3", None)], "value string, arrival timestamp")
    assert parse.parse_traffic(df, "permissive").count() == 0
    assert [r["reason"] for r in parse.quarantine_traffic(df).collect()] == ["no arrival"]
    with pytest.raises(PySparkException, match="malformed line"):
        parse.parse_traffic(df).collect()


@pytest.mark.parametrize("digits", ["1" * 200_000 + "x", "0" * 200_000 + "x", "1." + "5" * 200_000 + "e"])
def test_long_malformed_fields_take_one_pass(spark, digits):
    line = f"1486669632837|30|5|A Driver|5|A to B|{digits}|42|68|Violation|1|0|3|17"
    df = lines(spark, [line]).cache()
    df.count()
    parse.quarantine_truck(lines(spark, [TRUCK_LINE])).collect()
    begin = time.perf_counter()
    (row,) = parse.quarantine_truck(df).collect()
    assert row["reason"] == "bad latitude"
    assert time.perf_counter() - begin < 1


def test_hexadecimal_doubles(spark):
    for text, value in (("0x1.8p3", 12.0), ("-0X.8P-1", -0.25), ("0x1p0", 1.0)):
        (row,) = parse.parse_truck(lines(spark, [TRUCK_LINE.replace("|75|", f"|{text}|")])).collect()
        assert row["latitude"] == value
    for text in ("0x1.8", "0xp1", "x1p1", "0x1p"):
        df = lines(spark, [TRUCK_LINE.replace("|75|", f"|{text}|")])
        assert [r["reason"] for r in parse.quarantine_truck(df).collect()] == ["bad latitude"]
