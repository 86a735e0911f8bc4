"""Every operator as a query over the events table."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetstream.functions.violations import is_known_violation, violation_flag
from fleetstream.operators import parse, render, scoring, stats, training
from fleetstream.operators.enrich import (
    COPIES,
    enrich_join,
    enriched_groups,
    enriched_levels,
    latest_traffic,
    preview,
    repeat_rows,
)
from fleetstream.plans import telemetry as tel
from fleetstream.plans.replay import Replay
from fleetstream.schemas import ENRICHED_FIELDS, ENRICHED_TRUCK_FIELDS, FEATURES, names
from fleetstream.sinks.outputs import append_history
from fleetstream.sources.history import read_groups, read_history, read_snapshot
from fleetstream.sources.weights import (
    WeightsTable,
    publish_weights,
    train_history,
)
from fleetstream.sources.workdir import shared_dir

# The weights the scoring queries use, in feature order.
DEMO_WEIGHTS = (0.01, -0.002, 0.003, 0.004, 0.05, -0.06, 0.07)
LOGISTIC_STEP = 1.0
LOGISTIC_ITERATIONS = 12

_STATS = [
    "driver_id",
    "average_speed",
    "fog",
    "rain",
    "wind",
    "total_violations",
    "total_events",
]


def _clock(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def _rounded(column: str | Column, name: str) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    # Adding zero turns a negative zero into a plain one.
    return (F.round(col, 6) + F.lit(0.0)).alias(name)


def _enriched(spark: SparkSession, sf: str, extra=()) -> DataFrame:
    return enrich_join(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.HOURLY, extra=extra
    )


def _groups(spark: SparkSession, sf: str, extra=()) -> DataFrame:
    """The enriched rows before equal ones are repeated."""
    return enriched_groups(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.HOURLY, extra=extra
    )


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched rows before they are taken apart by level."""
    return enriched_levels(tel.truck(spark, sf), tel.traffic(spark, sf), tel.HOURLY)


def _position_rows(weights: DataFrame) -> DataFrame:
    return weights.select(F.posexplode("weights").alias("position", "w")).select(
        "position", _rounded("w", "weight")
    )


def source_truck_lines(spark, sf):
    return tel.truck_raw(spark, sf).select(_clock("arrival"), "value")


def source_traffic_lines(spark, sf):
    return tel.traffic_raw(spark, sf).select(_clock("arrival"), "value")


def parse_truck(spark, sf):
    rows = parse.parse_truck(tel.truck_raw(spark, sf))
    return rows.withColumn("arrival", _clock("arrival"))


def parse_traffic(spark, sf):
    rows = parse.parse_traffic(tel.traffic_raw(spark, sf))
    return rows.withColumn("arrival", _clock("arrival"))


def parse_enriched(spark, sf):
    # Equal lines are rendered and parsed once.
    lines = render.enriched_lines(_groups(spark, sf), carry=(COPIES,))
    return repeat_rows(parse.parse_enriched(lines))


def parse_truck_permissive(spark, sf):
    rows = parse.parse_truck(tel.broken_truck_raw(spark, sf), mode="permissive")
    return rows.withColumn("arrival", _clock("arrival"))


def quarantine(spark, sf):
    return parse.quarantine_truck(tel.broken_truck_raw(spark, sf)).select(
        _clock("arrival"), "value", "reason"
    )


def truck_lines(spark, sf):
    return render.truck_lines(tel.truck(spark, sf))


def enriched_truck_lines(spark, sf):
    return render.enriched_truck_lines(tel.truck(spark, sf))


def traffic_lines(spark, sf):
    return render.traffic_lines(tel.traffic(spark, sf))


def violation_flags(spark, sf):
    return tel.truck(spark, sf).select(
        "event_id", "event_type", violation_flag().alias("is_violation")
    )


def known_violation_filter(spark, sf):
    return (
        tel.truck(spark, sf)
        .where(is_known_violation())
        .select("event_id", "event_type")
    )


def enriched(spark, sf):
    return repeat_rows(_groups(spark, sf).withColumn("bw", _clock("bw")))


def enriched_lines(spark, sf):
    return repeat_rows(render.enriched_lines(_groups(spark, sf), carry=(COPIES,)))


def enriched_history(spark, sf):
    path = shared_dir(spark, "enriched")
    append_history(_levels(spark, sf), path, rebalance=True)
    return read_history(spark, path, select=[_clock("bw"), *names(ENRICHED_FIELDS)])


def preview_enriched(spark, sf):
    return preview(_enriched(spark, sf), tel.HOURLY.preview_rows)


def _stats(spark, sf) -> DataFrame:
    return stats.driver_window_stats(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.HOURLY
    )


def driver_window_stats(spark, sf):
    return _stats(spark, sf).select(_clock("window_start"), *_STATS)


def driver_window_stats_direct(spark, sf):
    return stats.driver_window_stats_direct(_enriched(spark, sf), tel.HOURLY).select(
        _clock("window_start"), *_STATS
    )


def driver_window_violation_count(spark, sf):
    return stats.driver_window_violation_count(_stats(spark, sf)).withColumn(
        "window_start", _clock("window_start")
    )


def window_stats_lines(spark, sf):
    return render.stats_lines(_stats(spark, sf))


def window_stats_history(spark, sf):
    path = shared_dir(spark, "stats")
    append_history(_stats(spark, sf), path, time="window_start", rebalance=True)
    return read_history(spark, path).select(_clock("window_start"), *_STATS)


def latest_traffic_state(spark, sf):
    return latest_traffic(tel.traffic(spark, sf), "event_id").withColumn(
        "arrival", _clock("arrival")
    )


def feature_vectors(spark, sf):
    points = training.labeled_points(
        _groups(spark, sf, extra=("event_id",)),
        tel.HOURLY,
        carry=("event_id", "congestion_level", COPIES),
    )
    vectors = points.select(
        "event_id",
        "congestion_level",
        *[F.get("features", F.lit(i)).alias(f"x_{n}") for i, n in enumerate(FEATURES)],
        COPIES,
    )
    return repeat_rows(vectors)


def labeled_points(spark, sf):
    points = training.labeled_points(
        _groups(spark, sf, extra=("event_id",)),
        tel.HOURLY,
        carry=("event_id", "congestion_level", COPIES),
    )
    positions = points.select(
        "event_id",
        "congestion_level",
        "label",
        F.posexplode("features").alias("position", "feature"),
        COPIES,
    )
    return repeat_rows(positions)


def _scored(spark: SparkSession, sf: str, extra=(), **model) -> DataFrame:
    """Truck rows are scored before the join multiplies them; the rows come as groups."""
    truck = scoring.predict(tel.truck(spark, sf), DEMO_WEIGHTS, tel.HOURLY, **model)
    traffic = tel.traffic(spark, sf)
    return enriched_groups(truck, traffic, tel.HOURLY, extra=(*extra, "prediction"))


def predict(spark, sf):
    scored = _scored(spark, sf, extra=("event_id",)).select(
        "event_id", "congestion_level", _rounded("prediction", "prediction"), COPIES
    )
    return repeat_rows(scored)


def predict_logistic(spark, sf):
    scored = _scored(spark, sf, extra=("event_id",), intercept=0.25, link="logistic")
    scored = scored.select(
        "event_id", "congestion_level", _rounded("prediction", "prediction"), COPIES
    )
    return repeat_rows(scored)


def prediction_lines(spark, sf):
    rows = _scored(spark, sf)
    text = rows.select(
        F.round("prediction", 6).cast("decimal(20,6)").alias("prediction"), COPIES
    )
    return repeat_rows(render.prediction_lines(text, carry=(COPIES,)))


def training_moments(spark, sf):
    moments = training.batch_moments(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.SCALED
    )
    return moments.select(
        _clock("bw"), *[_rounded(c, c) for c in moments.columns if c != "bw"]
    )


def sgd_train_step(spark, sf):
    cfg = tel.SCALED
    moments = training.total_moments(
        tel.truck(spark, sf), tel.traffic(spark, sf), cfg
    ).first()
    batch = training.Moments.from_row(moments, cfg.num_weights)
    weights = training.sgd_step([0.0] * cfg.num_weights, batch, cfg)
    return _position_rows(
        spark.createDataFrame([(weights,)], "weights array<double>")
    )


def _trained(spark, sf, cfg=tel.SCALED) -> WeightsTable:
    table = WeightsTable(spark, shared_dir(spark, "weights"))
    train_history(
        tel.truck(spark, sf),
        tel.traffic(spark, sf),
        cfg,
        table,
        shared_dir(spark, "moments"),
    )
    return table


def weights_history(spark, sf):
    return (
        _trained(spark, sf)
        .read()
        .select("bw", "rows", F.posexplode("weights").alias("position", "w"))
        .select(_clock("bw"), "rows", "position", _rounded("w", "weight"))
    )


def model_weights_init(spark, sf):
    """The weights a job restarted after training on the table begins with."""
    newest = _trained(spark, sf).read().orderBy(F.col("bw").desc()).limit(1)
    return _position_rows(newest)


def prequential_scores(spark, sf):
    scored = scoring.prequential_scores(
        tel.truck(spark, sf),
        tel.traffic(spark, sf),
        _trained(spark, sf).read(),
        tel.SCALED,
        extra=("event_id",),
        grouped=True,
    )
    scored = scored.select(
        _clock("bw"),
        "event_id",
        "congestion_level",
        _clock("weights_bw"),
        _rounded("prediction", "prediction"),
        COPIES,
    )
    return repeat_rows(scored)


def train_logistic_batch(spark, sf):
    points = training.weighted_points(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.SCALED
    )
    return _position_rows(_logistic_weights(spark, points))


def _logistic_weights(spark: SparkSession, points: DataFrame) -> DataFrame:
    path = shared_dir(spark, "points")
    points.write.parquet(path)
    weights = training.train_logistic_sgd(
        spark.read.parquet(path), tel.SCALED, LOGISTIC_STEP, LOGISTIC_ITERATIONS
    )
    return spark.createDataFrame([(weights,)], "weights array<double>")


def weights_from_pretrained(spark, sf):
    """Save a logistic model, load it as the job does, and train on from there."""
    from pyspark.ml.functions import array_to_vector

    points = training.weighted_points(
        tel.truck(spark, sf), tel.traffic(spark, sf), tel.SCALED
    )
    saved = shared_dir(spark, "model")
    _logistic_weights(spark, points).select(
        array_to_vector("weights").alias("weights"), F.lit(0.0).alias("intercept")
    ).write.parquet(f"{saved}/data")
    table = _trained(spark, sf, dataclasses.replace(tel.SCALED, pretrained_path=saved))
    return (
        table.read()
        .select("bw", "rows", F.posexplode("weights").alias("position", "w"))
        .select(_clock("bw"), "rows", "position", _rounded("w", "weight"))
    )


def _replayed(spark: SparkSession, sf: str) -> Replay:
    return Replay(spark, sf).admitted()


def stream_enriched_history(spark, sf):
    path = _replayed(spark, sf).enriched()
    return read_history(spark, path, select=[_clock("bw"), *names(ENRICHED_FIELDS)])


def stream_window_stats(spark, sf):
    path = _replayed(spark, sf).stats()
    return read_history(spark, path).select(_clock("window_start"), *_STATS)


def stream_weights(spark, sf):
    table = WeightsTable(spark, _replayed(spark, sf).trained().path)
    return (
        table.read()
        .select("bw", "rows", F.posexplode("weights").alias("position", "w"))
        .select(_clock("bw"), "rows", "position", _rounded("w", "weight"))
    )


def stream_scores(spark, sf):
    columns = [
        _clock("bw"),
        "event_time",
        "truck_id",
        "driver_id",
        "congestion_level",
        _clock("weights_bw"),
        _rounded("prediction", "prediction"),
    ]
    return read_history(spark, _replayed(spark, sf).scored(), select=columns)


def stream_latest_traffic(spark, sf):
    updates = read_history(spark, _replayed(spark, sf).latest_traffic())
    newest = updates.groupBy("route_id").agg(
        F.max_by("congestion_level", "arrival").alias("congestion_level"),
        F.max("arrival").alias("arrival"),
    )
    return newest.withColumn("arrival", _clock("arrival"))


# Slices that all span the whole time, so that many rows of the later ones are late.
LATE_SLICES = 3
LATE_DELAY = "20 days"


def stream_late_rows(spark, sf):
    """Every line that came in: admitted, or rejected as late."""
    cfg = dataclasses.replace(tel.SCALED, watermark_delay=LATE_DELAY)
    slices = [F.col("event_id") % LATE_SLICES == k for k in range(LATE_SLICES)]
    replay = Replay(spark, sf, cfg).admitted(slices)
    found = None
    for name, to_lines in (("truck", render.raw_truck_lines), ("traffic", render.traffic_lines)):
        good = to_lines(replay.log.rows(name, streaming=False), carry=("arrival",))
        rows = (
            good.withColumn("reason", F.lit("admitted"))
            .unionByName(replay.log.rejected(name).drop("day"))
            .select(F.lit(name).alias("input"), _clock("arrival"), "value", "reason")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def stream_latest_snapshot(spark, sf):
    """What the last trigger with rows has left: the second half of the days."""
    days = tel.truck(spark, sf).agg(
        F.unix_micros(F.date_trunc("day", F.min("arrival"))).alias("first"),
        F.datediff(F.max("arrival"), F.min("arrival")).alias("n"),
    ).first()
    middle = F.timestamp_micros(F.lit(days["first"] + days["n"] // 2 * 86_400_000_000))
    early = F.col("arrival") < middle
    path = Replay(spark, sf).snapshot([early, ~early])
    return read_snapshot(spark, path, select=[_clock("bw"), *names(ENRICHED_FIELDS)])


def train_logistic_history(spark, sf):
    """Store the enriched rows, fit on them, publish the weights, read them back. Equal rows
    are stored as one with their number, which is its weight in the fit."""
    path = shared_dir(spark, "enriched")
    append_history(_groups(spark, sf), path, rebalance=True)
    history = read_groups(spark, path)
    points = training.merged_points(training.enriched_points(history, tel.SCALED))
    fitted = _logistic_weights(spark, points)
    newest = history.agg(
        F.unix_micros(F.max("bw")).alias("bw"), F.sum(COPIES).alias("n")
    ).first()
    table = WeightsTable(spark, shared_dir(spark, "weights"))
    weights = fitted.first()["weights"]
    publish_weights(table, weights, newest["bw"], newest["n"], tel.SCALED)
    return _position_rows(table.read())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_truck_lines": source_truck_lines,
    "source_traffic_lines": source_traffic_lines,
    "parse_truck": parse_truck,
    "parse_traffic": parse_traffic,
    "parse_enriched": parse_enriched,
    "parse_truck_permissive": parse_truck_permissive,
    "quarantine": quarantine,
    "truck_lines": truck_lines,
    "enriched_truck_lines": enriched_truck_lines,
    "traffic_lines": traffic_lines,
    "violation_flag": violation_flags,
    "known_violation_filter": known_violation_filter,
    "enrich_join": enriched,
    "enriched_lines": enriched_lines,
    "enriched_history": enriched_history,
    "preview_enriched": preview_enriched,
    "driver_window_stats": driver_window_stats,
    "driver_window_stats_direct": driver_window_stats_direct,
    "driver_window_violation_count": driver_window_violation_count,
    "window_stats_lines": window_stats_lines,
    "window_stats_history": window_stats_history,
    "latest_traffic_state": latest_traffic_state,
    "feature_vectors": feature_vectors,
    "labeled_points": labeled_points,
    "predict": predict,
    "predict_logistic": predict_logistic,
    "prediction_lines": prediction_lines,
    "training_moments": training_moments,
    "sgd_train_step": sgd_train_step,
    "weights_history": weights_history,
    "model_weights_init": model_weights_init,
    "prequential_scores": prequential_scores,
    "train_logistic_batch": train_logistic_batch,
    "train_logistic_history": train_logistic_history,
    "weights_from_pretrained": weights_from_pretrained,
    "stream_enriched_history": stream_enriched_history,
    "stream_window_stats": stream_window_stats,
    "stream_weights": stream_weights,
    "stream_scores": stream_scores,
    "stream_latest_traffic": stream_latest_traffic,
    "stream_late_rows": stream_late_rows,
    "stream_latest_snapshot": stream_latest_snapshot,
}
