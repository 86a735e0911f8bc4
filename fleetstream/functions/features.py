"""Feature, score and moment expressions. All stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from fleetstream.config import FleetConfig


def feature_columns(cfg: FleetConfig) -> list[Column]:
    """The features as doubles, in order, scaled only if the config says so."""
    cols = [F.col(name).cast("double") for name in cfg.features]
    if cfg.scaling is None:
        return cols
    return [
        (c - F.lit(float(offset))) / F.lit(float(scale))
        for c, offset, scale in zip(cols, cfg.scaling.offsets, cfg.scaling.scales)
    ]


def feature_array(cfg: FleetConfig) -> Column:
    return F.array(*feature_columns(cfg))


def dot(features: Sequence[Column], weights: Sequence[Column]) -> Column:
    if len(features) != len(weights):
        raise ValueError(f"{len(weights)} weights for {len(features)} features")
    total = None
    for x, w in zip(features, weights):
        total = x * w if total is None else total + x * w
    return total


def weight_literals(weights: Sequence[float]) -> list[Column]:
    return [F.lit(float(w)) for w in weights]


def weight_elements(column: Column | str, size: int) -> list[Column]:
    col = F.col(column) if isinstance(column, str) else column
    return [F.get(col, F.lit(i)) for i in range(size)]


def link(score: Column, name: str | None) -> Column:
    if name is None:
        return score
    if name == "logistic":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
    raise ValueError(f"unknown link {name!r}")


def moment_names(size: int) -> list[str]:
    """Column names of the sufficient statistics of a least-squares batch."""
    xx = [f"xx_{i}_{j}" for i in range(size) for j in range(i, size)]
    xy = [f"xy_{i}" for i in range(size)]
    return ["n", *xx, *xy]
