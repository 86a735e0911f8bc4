"""Stepping through the batches of a long history in parallel.

What training does to the weights on one batch is an affine map, given the number of steps it
takes, and affine maps compose. So blocks of consecutive batches are composed side by side, a
short scan over the blocks says with which weights each begins, and every block then steps
through its own batches from there.

The number of steps depends on the weights, as training stops early on a batch that hardly
moves them. A pass therefore reports the maps of the steps it really took, and passes are
repeated until no block begins elsewhere than it was told. The first block that did not yet
settle is right after each pass, so this ends; in practice the second pass changes little.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetstream.config import FleetConfig, duration_micros
from fleetstream.operators.training import Moments, sgd_steps, train_rows
from fleetstream.sources.package import ship_package

#: Batch intervals per block: the rows a task steps through in order.
BLOCK = 1024
#: A start that moves by less, relative to its size, is the same.
_SAME = 1e-13

_ROWS = (
    "bw bigint, weights_bw bigint, weights_before array<double>, weights array<double>, "
    "rows double, finite boolean"
)
_MAP = "block bigint, last bigint, matrix array<double>"


def batch_map(m: Moments, steps: int, cfg: FleetConfig) -> np.ndarray:
    """The steps on one batch as a matrix that acts on (weights, 1)."""
    size = cfg.num_weights
    out = np.eye(size + 1)
    for t in range(1, steps + 1):
        rate = cfg.step_size / math.sqrt(t) / m.n
        step = np.eye(size + 1)
        step[:size, :size] -= rate * m.xx
        step[:size, size] = rate * m.xy
        out = step @ out
    return out


def _ordered(block: pa.Table) -> list[dict]:
    return sorted(block.to_pylist(), key=lambda r: r["bw"])


def _mapped(starts: dict[int, list[float]] | None, cfg: FleetConfig):
    """The map of a block: with the steps taken from its start, or with all of them."""

    def block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        number = key[0].as_py()
        weights = starts[number] if starts else None
        out = np.eye(cfg.num_weights + 1)
        for row in (ordered := _ordered(rows)):
            m = Moments.from_row(row, cfg.num_weights)
            steps = cfg.iterations
            if weights is not None:
                weights, steps = sgd_steps(weights, m, cfg)
            with np.errstate(all="ignore"):
                out = batch_map(m, steps, cfg) @ out
        return pa.table(
            {"block": [number], "last": [ordered[-1]["bw"]], "matrix": [out.ravel().tolist()]}
        )

    return block


def _stepped(starts: dict[int, tuple], cfg: FleetConfig):
    """The weight rows of a block."""
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        weights, weights_bw = starts[key[0].as_py()]
        found = list(train_rows(_ordered(rows), weights, weights_bw, cfg))
        kinds = [
            pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()),
            pa.float64(), pa.bool_(),
        ]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return block


def _starts(maps: Sequence, weights: Sequence[float]) -> tuple[dict[int, list[float]], bool]:
    """The weights each block begins with, and whether all of them are finite."""
    out, now = {}, np.array([*weights, 1.0])
    size = len(now)
    with np.errstate(all="ignore"):
        for r in maps:
            out[r["block"]] = now[:-1].tolist()
            now = np.array(r["matrix"]).reshape(size, size) @ now
    return out, bool(np.isfinite(now).all())


def _moved(a: list[float], b: list[float]) -> bool:
    x, y = np.array(a), np.array(b)
    return bool(np.linalg.norm(x - y) > _SAME * max(np.linalg.norm(y), 1.0))


def scanned_weights(
    moments: DataFrame, weights: Sequence[float], weights_bw, cfg: FleetConfig, path: str
) -> DataFrame:
    """Rows of the weights table for stored moments, batch times in microseconds; written
    below ``path``.

    The driver sees one matrix per block and pass. Where training diverges, maps don't
    compose, and the blocks are stepped through in turn until the weights are not finite.
    """
    ship_package(moments.sparkSession)
    weights = cfg.check_weights(weights)
    width = BLOCK * duration_micros(cfg.batch_interval)
    blocks = moments.withColumn("block", F.floor(F.col("bw") / F.lit(width)).cast("long"))
    starts, finite = None, True
    while finite:
        found = blocks.groupBy("block").applyInArrow(_mapped(starts, cfg), _MAP).collect()
        maps = sorted(found, key=lambda r: r["block"])
        before, (starts, finite) = starts, _starts(maps, weights)
        if finite and before and not any(_moved(before[b], starts[b]) for b in starts):
            break
        if not maps:
            break
    if not finite:
        starts = _one_by_one(blocks, [r["block"] for r in maps], weights, cfg)
    earlier = [weights_bw, *[r["last"] for r in maps]]
    begin = {r["block"]: (starts[r["block"]], bw) for r, bw in zip(maps, earlier)}
    rows = blocks.groupBy("block").applyInArrow(_stepped(begin, cfg), _ROWS)
    rows.write.mode("overwrite").parquet(path)
    return moments.sparkSession.read.schema(rows.schema).parquet(path)


def _one_by_one(
    blocks: DataFrame, numbers: Sequence[int], weights: list[float], cfg: FleetConfig
) -> dict[int, list[float]]:
    """Starts of all blocks, a pass per block up to the one in which training diverges."""
    starts = {}
    for number in numbers:
        starts[number] = weights
        if np.isfinite(weights).all():
            rows = blocks.where(F.col("block") == number).groupBy("block")
            begin = {number: (weights, None)}
            last = rows.applyInArrow(_stepped(begin, cfg), _ROWS).orderBy(F.desc("bw")).first()
            weights = list(last["weights"])
    return starts
