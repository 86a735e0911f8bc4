import random

import pytest
from pyspark.sql import functions as F

from fleetstream import FleetConfig
from fleetstream.functions.violations import is_known_violation, violation_flag
from fleetstream.operators import enrich, stats
from fleetstream.operators.parse import parse_enriched
from fleetstream.operators.render import enriched_lines, stats_lines
from fleetstream.schemas import DRIVER_STATS, ENRICHED_FIELDS, names
from support import at, join, stats_dict, traffic_df, traffic_rows, truck_df, truck_rows, windows

CFG = FleetConfig()


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def joined_rows(df):
    return sorted(
        (int((r["bw"] - at(0)).total_seconds()), r["event_time"], r["driver_id"], r["speed"], r["congestion_level"])
        for r in df.collect()
    )


def expected_join(truck, traffic):
    return sorted((b, t[1], t[3], t[9], c) for b, t, c in join(truck, traffic))


@pytest.mark.parametrize("salts", [None, (4, 1), (1, 3), (4, 3)])
def test_join(spark, salts):
    truck, traffic = truck_rows(300, 1), traffic_rows(120, 2)
    out = enrich.enrich_join(truck_df(spark, truck), traffic_df(spark, traffic), CFG, salts)
    assert joined_rows(out) == expected_join(truck, traffic)


def hot_inputs():
    """A third of all rows are copies of one row, in one route and batch."""
    truck, traffic = truck_rows(400, 3), traffic_rows(100, 4)
    return truck + [truck[0]] * 200, traffic + [(truck[0][0], 7, truck[0][5], 3)] * 50


@pytest.mark.parametrize("salts", [None, (8, 4)])
def test_join_hot_group(spark, salts):
    truck, traffic = hot_inputs()
    out = enrich.enrich_join(truck_df(spark, truck), traffic_df(spark, traffic), CFG, salts)
    assert joined_rows(out) == expected_join(truck, traffic)


@pytest.mark.parametrize("salts", [None, (8, 4)])
def test_groups_meet_equal_readings_once(spark, salts, monkeypatch):
    monkeypatch.setattr(enrich, "_MOST_COPIES", 7)
    truck, traffic = hot_inputs()
    traffic += [(*traffic[0][:3], None)] * 9
    groups = enrich.enriched_groups(truck_df(spark, truck), traffic_df(spark, traffic), CFG, salts)
    want = [(b, t[1], t[3], t[9], c) for b, t, c in join(truck, traffic)]
    assert groups.count() < len(want) / 3
    got = enrich.repeat_rows(groups).select("bw", "event_time", "driver_id", "speed", "congestion_level")
    assert got.groupBy(*got.columns).count().count() == len(set(want))
    assert got.count() == len(want)
    got = got.fillna({"congestion_level": -1})
    assert joined_rows(got) == sorted((*r[:4], -1 if r[4] is None else r[4]) for r in want)


def test_rows_are_made_in_even_tasks(spark, tmp_path):
    """Of a file that one task reads the rows are made by many."""
    truck, traffic = truck_df(spark, truck_rows(800, 3)), traffic_df(spark, traffic_rows(400, 4))
    stored = []
    for name, df in (("truck", truck), ("traffic", traffic)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    out = enrich.enrich_join(*stored, CFG)
    made = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(made) >= spark.sparkContext.defaultParallelism
    assert max(made) < sum(made) / 4


def test_groups_are_scored_before_they_are_repeated(spark):
    """What depends on a row alone is below the generator in the plan."""
    truck, traffic = hot_inputs()
    groups = enrich.enriched_groups(truck_df(spark, truck), traffic_df(spark, traffic), CFG)
    lines = parse_enriched(enriched_lines(groups, carry=(enrich.COPIES,)))
    out = enrich.repeat_rows(lines)
    assert sorted(out.columns) == sorted(names(ENRICHED_FIELDS))
    plain = enrich.enrich_join(truck_df(spark, truck), traffic_df(spark, traffic), CFG)
    assert sorted(map(tuple, out.collect())) == sorted(
        map(tuple, plain.select(out.columns).collect())
    )
    plan = plan_of(out)
    assert plan.index("Generate explode(array_repeat") < plan.index("concat_ws")


def test_salts_spread_equal_rows(spark):
    """Copies of one row from the ingest log do not all land in the same slot."""
    rows = spark.range(1000).select(F.lit("7").alias("epoch"), F.col("id").alias("pos"), F.lit(1).alias("x"))
    slots = rows.select(enrich.own_slot(rows, F.lit(True), 8).alias("s"))
    assert slots.distinct().count() == 8
    assert slots.collect() == rows.repartition(3).orderBy("pos").select(enrich.own_slot(rows, F.lit(True), 8)).collect()
    assert rows.select(enrich.own_slot(rows, F.lit(False), 8).alias("s")).distinct().collect() == [(0,)]


def logged(df, hot):
    """As the ingest log has rows: with a place and whether the group is hot."""
    return (
        df.withColumn("hot", F.col("route_id").isin(*hot))
        .withColumn("epoch", F.lit("0"))
        .withColumn("pos", F.monotonically_increasing_id())
    )


def test_only_hot_routes_are_salted(spark):
    truck, traffic = hot_inputs()
    t, f = logged(truck_df(spark, truck), [1]), logged(traffic_df(spark, traffic), [1])
    assert joined_rows(enrich.enrich_join(t, f, CFG, (4, 3))) == expected_join(truck, traffic)
    copies = f.withColumn("slot", enrich.every_slot(enrich.is_hot(f, CFG), 4)).groupBy("route_id").count()
    raw = dict(f.groupBy("route_id").count().collect())
    assert {r[0]: r[1] / raw[r[0]] for r in copies.collect()} == {0: 1, 1: 4, 2: 1}
    check_stats(stats.driver_window_stats(t, f, CFG, (4, 3)), truck, traffic)
    named = FleetConfig(salted_routes=(1,))
    t, f = truck_df(spark, truck), traffic_df(spark, traffic)
    assert joined_rows(enrich.enrich_join(t, f, named, (4, 3))) == expected_join(truck, traffic)


def test_retried_task_deals_rows_alike(spark, tmp_path):
    """Slots depend on what is stored of a row, not on the task that reads it."""
    truck, _ = hot_inputs()
    path = str(tmp_path / "log")
    logged(truck_df(spark, truck), [0, 1, 2]).repartition(6).write.parquet(path)
    runs = []
    for parts in (1, 4):
        t = spark.read.parquet(path).repartition(parts, "driver_id")
        slot = enrich.own_slot(t, enrich.is_hot(t, CFG), 8)
        runs.append(sorted(map(tuple, t.select("pos", slot).collect())))
    assert runs[0] == runs[1] and len({s for _, s in runs[0]}) == 8


def test_salts_replace_aqe(spark):
    """Without run-time splitting a batch join is salted like a stream's."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    truck, traffic = truck_rows(100, 1), traffic_rows(50, 2)
    t, f = truck_df(session, truck), traffic_df(session, traffic)
    assert enrich.default_salts(CFG, t, f) == (1, 1)
    session.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    assert enrich.default_salts(CFG, t, f) == (8, 2)
    assert joined_rows(enrich.enrich_join(t, f, CFG)) == expected_join(truck, traffic)


def test_aqe_splits_a_hot_group(spark):
    """Without a broadcast, the hot group's partition is read in several pieces."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }.items():
        session.conf.set(key, value)
    truck = truck_rows(4000, 5, seconds=400)
    first = truck[0]
    # Differing rows of one route and batch: equal ones would compress to nothing.
    truck += [(first[0], *t[1:5], first[5], *t[6:]) for t in truck_rows(3000, 12)]
    traffic = traffic_rows(300, 6, seconds=400)
    left = truck_df(session, truck).repartition(8)
    out = enrich.enrich_join(left, traffic_df(session, traffic), CFG)
    assert "skew=true" in plan_of(out)
    assert joined_rows(out) == expected_join(truck, traffic)


def test_join_edges(spark):
    t = truck_rows(1, 1)[0]
    truck = [(at(1.0), *t[1:5], 1, *t[6:])]
    cases = [
        ([(at(1.9), 1, 1, 4)], 1),
        ([(at(0.0), 1, 1, 4), (at(1.5), 1, 1, 4)], 2),
        ([(at(2.0), 1, 1, 4)], 0),
        ([(at(1.0), 1, 2, 4)], 0),
        ([], 0),
    ]
    for traffic, n in cases:
        out = enrich.enrich_join(truck_df(spark, truck), traffic_df(spark, traffic), CFG)
        assert out.count() == n


def check_stats(out, truck, traffic, **kw):
    got, want = stats_dict(out.collect()), windows(join(truck, traffic), **kw)
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, abs=1e-9)


@pytest.mark.parametrize("salts", [None, (4, 1)])
@pytest.mark.parametrize(
    "length, slide", [(6, 2), (2, 2), (6, 4), (10, 4), (200, 2), (8, 8)]
)
def test_stats(spark, length, slide, salts):
    cfg = FleetConfig(window_length=f"{length} seconds", window_slide=f"{slide} seconds")
    truck, traffic = truck_rows(250, 7), traffic_rows(100, 8)
    t, f = truck_df(spark, truck), traffic_df(spark, traffic)
    out = stats.driver_window_stats(t, f, cfg, salts)
    check_stats(out, truck, traffic, length=length, slide=slide)
    direct = stats.driver_window_stats_direct(enrich.enrich_join(t, f, cfg), cfg)
    check_stats(direct, truck, traffic, length=length, slide=slide)


def test_stats_hot_group(spark):
    truck, traffic = hot_inputs()
    check_stats(
        stats.driver_window_stats(truck_df(spark, truck), traffic_df(spark, traffic), CFG),
        truck, traffic,
    )


def test_stats_match_spark_window(spark):
    """The generator agrees with window() on which windows hold a batch."""
    panes = stats.driver_panes(
        truck_df(spark, truck_rows(300, 9)), traffic_df(spark, traffic_rows(90, 10)), CFG
    )
    w = F.window("bw", CFG.window_length, CFG.window_slide)
    want = panes.groupBy(w.alias("w"), "driver_id").agg(F.sum("total_events").alias("n"))
    got = stats.window_panes(panes, CFG)
    assert sorted(got.select("window_start", "window_end", "driver_id", "total_events").collect()) == sorted(
        want.select("w.start", "w.end", "driver_id", "n").collect()
    )


def test_stats_never_fan_out(spark):
    """Panes shuffle before they are copied into windows: the window aggregate
    reads the repartitioned panes with no exchange in between."""
    out = stats.driver_window_stats(
        truck_df(spark, truck_rows(50, 9)), traffic_df(spark, traffic_rows(50, 10)), CFG
    )
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" not in plan
    physical = plan_of(out).split("Initial Plan")[-1]
    top = physical[: physical.index("REPARTITION_BY_COL")]
    assert top.count("Exchange") == 1


def merge(a, b):
    """The count-weighted integer mean of two violation values."""
    (x, n), (y, m) = a, b
    return ((x * n + y * m) // (n + m), n + m)


def test_violation_mean_is_min():
    """Whatever the merge order, the truncated mean of 0/1 flags is their minimum."""
    rng = random.Random(11)
    for _ in range(2000):
        flags = [rng.randrange(2) if rng.random() < 0.3 else 1 for _ in range(rng.randrange(1, 9))]
        parts = [(f, 1) for f in flags]
        while len(parts) > 1:
            b = parts.pop(rng.randrange(len(parts)))
            a = parts.pop(rng.randrange(len(parts)))
            parts.append(merge(a, b))
        assert parts[0] == (min(flags), len(flags))


def test_violation_predicates(spark):
    types = ["Normal", "Speeding", "Lane Departure", "Unsafe Follow Distance",
             "Unsafe Tail Distance", "Violation", "normal", " Normal", "", None]
    df = spark.createDataFrame([(t,) for t in types], "event_type string")
    assert [r[0] for r in df.select(violation_flag()).collect()] == [0] + [1] * 9
    assert df.where(is_known_violation()).count() == 4


def test_stats_line(spark):
    df = spark.createDataFrame(
        [(7, 68.25, 1.0, 1 / 3, 3.0, 0, 4)],
        "driver_id int, average_speed double, fog double, rain double, wind double,"
        " total_violations int, total_events long",
    )
    assert stats_lines(df).first()["value"] == "7|68.25|1.0|0.33333334|3.0|0|4"


def test_stats_schema(spark):
    out = stats.driver_window_stats(
        truck_df(spark, truck_rows(5, 1)), traffic_df(spark, traffic_rows(5, 2)), CFG
    )
    types = {f.name: f.dataType for f in out.schema}
    assert all(types[f.name] == f.dataType for f in DRIVER_STATS)


def test_latest_traffic(spark):
    rows = [
        (at(1), 5, 1, 3), (at(2), 1, 1, 4), (at(2), 9, 1, 6), (at(2), -8, 1, 5),
        (at(0), 2**62, 2, 7), (at(0), -(2**62), 2, 8),
    ]
    # Equal times: the higher level, wherever the rows lie.
    rows += [(at(9), 4, 3, level) for level in (2, 9, -1, 5)] * 3
    for parts in (1, 5):
        out = enrich.latest_traffic(traffic_df(spark, rows).repartition(parts, "congestion_level"))
        assert {(r["route_id"], r["congestion_level"], r["arrival"]) for r in out.collect()} == {
            (1, 6, at(2)), (2, 7, at(0)), (3, 9, at(9)),
        }


def test_preview_is_ordered_and_bounded(spark):
    joined = enrich.enrich_join(
        truck_df(spark, truck_rows(200, 1)), traffic_df(spark, traffic_rows(80, 2)), CFG
    )
    rows = enrich.preview(joined).collect()
    assert len(rows) == 10 and rows == sorted(rows)
    assert "TakeOrderedAndProject" in plan_of(enrich.preview(joined))
