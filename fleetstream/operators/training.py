"""Least-squares SGD over logical batches, from one distributed pass.

With the whole batch in every step the gradient depends only on the batch's
moments (sums of x*x and x*y), so a batch of any size becomes 36 numbers by one
hash aggregate. The steps themselves are 7 x 7 arithmetic and inherently
sequential: each batch starts from the weights the one before it left.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fleetstream.config import FeatureScaling, FleetConfig
from fleetstream.functions.features import feature_array, feature_columns, moment_names
from fleetstream.functions.violations import violation_flag
from fleetstream.operators.batches import batch_start, with_batch
from fleetstream.operators.enrich import COPIES, reading_counts

log = logging.getLogger(__name__)


def labeled_points(enriched: DataFrame, cfg: FleetConfig, carry=()) -> DataFrame:
    return enriched.select(
        *carry,
        violation_flag().cast("double").alias("label"),
        feature_array(cfg).alias("features"),
    )


def _moment_sums(cfg: FleetConfig) -> list:
    size = cfg.num_weights
    x = [F.col(f"x_{i}") for i in range(size)]
    sums = [F.count(F.lit(1)).cast("double").alias("n")]
    sums += [
        F.sum(x[i] * x[j]).alias(f"xx_{i}_{j}")
        for i in range(size)
        for j in range(i, size)
    ]
    sums += [F.sum(x[i] * F.col("y")).alias(f"xy_{i}") for i in range(size)]
    return sums


def route_moments(truck: DataFrame, traffic: DataFrame, cfg: FleetConfig) -> DataFrame:
    """Moments per logical batch and route, weighted by the route's readings."""
    points = with_batch(
        truck.select(
            "arrival",
            F.col("route_id").alias("route_key"),
            *[c.alias(f"x_{i}") for i, c in enumerate(feature_columns(cfg))],
            violation_flag().cast("double").alias("y"),
        ),
        cfg,
    )
    per_route = points.groupBy("bw", "route_key").agg(*_moment_sums(cfg))
    counts = reading_counts(traffic, cfg).withColumnRenamed("route_id", "route_key")
    names = moment_names(cfg.num_weights)
    return per_route.join(counts, ["bw", "route_key"]).select(
        "bw", *[(F.col(c) * F.col("readings")).alias(c) for c in names]
    )


def batch_moments(truck: DataFrame, traffic: DataFrame, cfg: FleetConfig) -> DataFrame:
    """One row of moments per logical batch that has enriched rows."""
    parts = route_moments(truck, traffic, cfg)
    names = moment_names(cfg.num_weights)
    sums = parts.groupBy("bw").agg(*[F.sum(c).alias(c) for c in names])
    return sums.select(batch_start(sums).alias("bw"), *names)


def total_moments(truck: DataFrame, traffic: DataFrame, cfg: FleetConfig) -> DataFrame:
    """All enriched rows as a single training batch: one row."""
    names = moment_names(cfg.num_weights)
    return route_moments(truck, traffic, cfg).agg(*[F.sum(c).alias(c) for c in names])


@dataclass(frozen=True)
class Moments:
    n: float
    xx: np.ndarray
    xy: np.ndarray

    @classmethod
    def from_row(cls, row, size: int) -> Moments:
        xx = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"]
        xy = np.array([row[f"xy_{i}"] for i in range(size)], dtype=float)
        return cls(float(row["n"]), xx, xy)


def sgd_steps(
    weights: Sequence[float], m: Moments | None, cfg: FleetConfig
) -> tuple[list[float], int]:
    """Train on one batch; also tells the steps taken. An empty batch changes nothing.

    Step t moves against the mean gradient by step_size / sqrt(t); from the
    second step on, a relative move below the tolerance ends the batch.
    """
    w = np.array(cfg.check_weights(weights))
    if m is None or m.n == 0:
        return w.tolist(), 0
    with np.errstate(all="ignore"):
        for t in range(1, cfg.iterations + 1):
            before = w
            w = before - cfg.step_size / math.sqrt(t) * (m.xx @ before - m.xy) / m.n
            moved = np.linalg.norm(w - before)
            if t > 1 and moved < cfg.convergence_tol * max(np.linalg.norm(w), 1.0):
                break
    return w.tolist(), t


def sgd_step(weights: Sequence[float], m: Moments | None, cfg: FleetConfig) -> list[float]:
    return sgd_steps(weights, m, cfg)[0]


def train_rows(
    moments: Iterable, weights: Sequence[float], weights_bw, cfg: FleetConfig
) -> Iterator[tuple]:
    """Step through moment rows in time order; yields rows of the weights table.
    Batches are told by their time in microseconds."""
    weights = cfg.check_weights(weights)
    reported = False
    for row in moments:
        before = weights
        weights = sgd_step(before, Moments.from_row(row, cfg.num_weights), cfg)
        finite = all(math.isfinite(w) for w in weights)
        if not finite and not reported:
            log.error("training diverged in batch %s: weights are not finite", row["bw"])
            reported = True
        yield (row["bw"], weights_bw, before, weights, float(row["n"]), finite)
        weights_bw = row["bw"]


def chunks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while part := list(islice(rows, size)):
        yield part


def fit_scaling(truck: DataFrame, cfg: FleetConfig) -> FeatureScaling:
    """Mean and standard deviation of the raw features, by one aggregate."""
    aggs = []
    for i, name in enumerate(cfg.features):
        aggs.append(F.avg(F.col(name).cast("double")).alias(f"m{i}"))
        aggs.append(F.stddev_pop(F.col(name).cast("double")).alias(f"s{i}"))
    row = truck.agg(*aggs).first()
    size = cfg.num_weights
    return FeatureScaling(
        tuple(row[f"m{i}"] or 0.0 for i in range(size)),
        tuple(row[f"s{i}"] or 1.0 for i in range(size)),
    )


def _stored_points(rows: DataFrame, cfg: FleetConfig, weight) -> DataFrame:
    """Labeled points as columns x_0, x_1, ... with ``label``, ``weight`` and a ``step`` of 0."""
    return rows.select(
        *[c.alias(f"x_{i}") for i, c in enumerate(feature_columns(cfg))],
        violation_flag().cast("double").alias("label"),
        weight.cast("double").alias("weight"),
        F.lit(0).alias("step"),
    )


def weighted_points(truck: DataFrame, traffic: DataFrame, cfg: FleetConfig) -> DataFrame:
    """The labeled points of the enriched rows, weighted by their number of readings,
    so that the join is never expanded."""
    rows = with_batch(truck.select("arrival", "event_type", *_feature_names(cfg, "route_id")), cfg)
    joined = rows.join(reading_counts(traffic, cfg), ["bw", "route_id"])
    return _stored_points(joined, cfg, F.col("readings"))


def enriched_points(enriched: DataFrame, cfg: FleetConfig) -> DataFrame:
    """The labeled points of stored enriched rows, weighted by their copies if they are groups."""
    weight = F.col(COPIES) if COPIES in enriched.columns else F.lit(1)
    return _stored_points(enriched, cfg, weight)


def merged_points(points: DataFrame) -> DataFrame:
    """Equal points once, with their weights added up: a truck row's copies for its readings
    are one point, so what every gradient step reads does not grow with the join."""
    same = [c for c in points.columns if c != "weight"]
    return points.groupBy(*same).agg(F.sum("weight").alias("weight"))


def _feature_names(cfg: FleetConfig, *others: str) -> list[str]:
    return list(dict.fromkeys([*others, *cfg.features]))


def train_logistic_sgd(
    points: DataFrame,
    cfg: FleetConfig,
    step_size: float = 1.0,
    iterations: int = 100,
    tolerance: float = 0.0,
) -> list[float]:
    """Offline logistic model by full-batch gradient steps from zero, no intercept.

    ``points`` is a stored table of ``weighted_points`` or ``enriched_points``. Step t moves
    against the mean gradient by step_size / sqrt(t), until a move is at most ``tolerance``
    of the weights' length. Every partition adds up its own gradient; the weights
    come to it as the columns of a broadcast row, so all steps run the same compiled plan.
    No points leave the weights at zero.
    """
    spark, size = points.sparkSession, cfg.num_weights
    names = [f"w_{i}" for i in range(size)]
    schema = ", ".join(["step int", *[f"{n} double" for n in names]])
    margin = sum(
        (F.col(f"x_{i}") * F.col(f"w_{i}") for i in range(1, size)), F.col("x_0") * F.col("w_0")
    )
    miss = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("label"))
    weights = np.zeros(size)
    for t in range(1, iterations + 1):
        # One row, joined on a column of the stored points: nothing to fold into the plan.
        now = spark.createDataFrame([(0, *weights.tolist())], schema)
        sums = (
            points.join(F.broadcast(now), "step")
            .agg(F.sum("weight"), *[F.sum(miss * F.col(f"x_{i}")) for i in range(size)])
            .first()
        )
        if not sums[0]:
            break
        move = step_size / math.sqrt(t) / sums[0] * np.array(sums[1:])
        weights = weights - move
        if np.linalg.norm(move) <= tolerance * np.linalg.norm(weights):
            break
    return weights.tolist()
