"""Clusters of integer vectors around moving centroids, by scalar lookup tables.

In every round the squared difference of each integer that occurs in a dimension to each
centroid is tabulated, so a vector's distances are gathers from these tables and sums of
what they give. All arithmetic is exact: integers of 64 bits where every distance fits,
Python's own where not.

A round is one pass over the vectors. What leaves a task is a sum per centroid and
dimension, in limbs of 32 bits, and the driver sees one such sum for the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.llm.storage import written

_LIMB = 32
_GREATEST = 1.7976931348623157e308
_LONG = (1 << 63) - 1


def _small(dims: int) -> int:
    """Below this magnitude the squared distance over all components fits in 64 bits."""
    return math.isqrt(_LONG // dims) // 2


def _integers(numbers: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); Python's integers if any is large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(numbers * scale)
    if not numbers.size or np.abs(scaled).max() < _small(numbers.shape[1]):
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in numbers.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(numbers.shape)


def kept_rows(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``dims`` components, all finite, and these as integers."""
    whole = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    values = column.filter(whole).flatten().to_numpy(zero_copy_only=False)
    numbers = values.astype(float).reshape(-1, dims)
    fine = np.isfinite(numbers).all(axis=1)
    return np.flatnonzero(whole.to_numpy(zero_copy_only=False))[fine], _integers(
        numbers[fine], scale
    )


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers in ascending order, and the place of each entry's."""
    if column.dtype != object and len(column):
        low, span = column.min(), int(column.max()) - int(column.min()) + 1
        if span <= 4 * len(column):
            there = np.zeros(span, dtype=bool)
            there[column - low] = True
            return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[column - low]
    return np.unique(column, return_inverse=True)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to centroids by one table per dimension."""
    if vectors.dtype == object or centroids.dtype == object:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    found = np.zeros((len(vectors), len(centroids)), dtype=vectors.dtype)
    for d in range(vectors.shape[1]):
        values, place = occurring(vectors[:, d])
        table = (values[:, None] - centroids[None, :, d]) ** 2
        found += table[place]
    return found


def limbs(number: int) -> list[int]:
    """Digits of 32 bits, least first; a negative number ends in a negative one."""
    out = []
    while number >> _LIMB not in (0, -1):
        out.append(number & ((1 << _LIMB) - 1))
        number >>= _LIMB
    return out + [number]


def of_limbs(digits) -> int:
    """The number of (place, digit) pairs, which may be sums of digits."""
    return sum(int(digit) << (_LIMB * place) for place, digit in digits)


def _sums(
    centroids: np.ndarray, dims: int, scale: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts (dimension -1) and sums of the vectors nearest to each centroid."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        totals = np.zeros((len(centroids), dims), dtype=object)
        for batch in batches:
            _, vectors = kept_rows(batch.column(0), dims, scale)
            nearest = distances(vectors, centroids).argmin(axis=1)
            counts += np.bincount(nearest, minlength=len(centroids))
            for c in np.unique(nearest):
                totals[c] += vectors[nearest == c].sum(axis=0).astype(object)
        rows = [
            (int(c), d, place, digit)
            for c in np.flatnonzero(counts)
            for d, number in [(-1, counts[c]), *enumerate(totals[c])]
            for place, digit in enumerate(limbs(int(number)))
        ]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["cluster", "dim", "place", "digit"],
        )

    return task


def _moved(vectors: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    sums = (
        vectors.select("e")
        .mapInArrow(
            _sums(centroids, dims, scale), "cluster int, dim int, place int, digit bigint"
        )
        .groupBy("cluster", "dim", "place")
        .agg(F.sum("digit").alias("digit"))
    )
    digits: dict = {}
    # At most centroids x (dimensions + 1) x limbs rows.
    for r in sums.collect():
        digits.setdefault((r["cluster"], r["dim"]), []).append((r["place"], r["digit"]))
    out = centroids.astype(object)
    for c in {c for c, _ in digits}:
        count = of_limbs(digits[c, -1])
        out[c] = [of_limbs(digits[c, d]) // count for d in range(dims)]
    return _compact(out)


def _compact(numbers: np.ndarray) -> np.ndarray:
    """As integers of 64 bits where all are small."""
    least = _small(numbers.shape[1])
    small = all(abs(x) < least for x in numbers.ravel().tolist())
    return numbers.astype(np.int64) if small else numbers


def _is_kept(dims: int) -> Column:
    finite = lambda x: F.coalesce(x.between(-_GREATEST, _GREATEST), F.lit(False))
    return (F.size("e") == dims) & F.forall("e", finite)


def _starts(vectors: DataFrame, k: int, seed: str, dims: int, scale: int) -> np.ndarray:
    """The kept vectors with the least sha256 of ``seed:id``; of equal ids the least
    vectors. Rows without an id come last."""
    chosen = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = (
        vectors.where(_is_kept(dims))
        .select(chosen.alias("h"), "e")
        .orderBy(F.asc_nulls_last("h"), "e")
        .limit(k)
        .collect()
    )
    numbers = np.array([r["e"] for r in rows], dtype=float).reshape(-1, dims)
    return _integers(numbers, scale)


def _assigned(centroids: np.ndarray, dims: int, scale: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = kept_rows(batch.column(1), dims, scale)
            found = distances(vectors, centroids)
            nearest = found.argmin(axis=1)
            least = found[np.arange(len(found)), nearest].tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(nearest.astype(np.int32)),
                    pa.array([x if x <= _LONG else None for x in least], pa.int64()),
                ],
                names=["id", "cluster", "distance"],
            )

    return task


def _total(rows) -> int | None:
    """The sum of what is known; None if something isn't or it exceeds a long."""
    if any(r["unknown"] for r in rows):
        return None
    total = sum(int(r["total"]) for r in rows)
    return total if total <= _LONG else None


def clustered(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: str = "3",
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid (its components,
    joined by commas) of every vector with ``dims`` finite components.

    Vectors that are null, have another length or a component that is null or not finite
    are left out. Components become floor(scale * x). The first centroids are the ``k``
    vectors that a hash of their id picks; fewer vectors give fewer centroids, an empty
    table no rows. Each row counts, repeated ones too; a row without an id starts a
    centroid only where the others don't suffice. Ties go to the smaller number. A distance
    or sum beyond a long is null, though compared exactly. Other columns are left out.
    """
    given = vectors.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("e")
    )
    centroids = _compact(_starts(given, k, seed, dims, scale).astype(object))
    if len(centroids):
        for _ in range(rounds):
            centroids = _moved(given, centroids, dims, scale)
    else:
        given = given.limit(0)
    kind = given.schema["id"].dataType.simpleString()
    rows = written(
        given.mapInArrow(
            _assigned(centroids, dims, scale), f"id {kind}, cluster int, distance bigint"
        ),
        "assigned",
    )
    sums = (
        rows.groupBy("cluster")
        .agg(
            F.coalesce(F.sum(F.col("distance").cast("decimal(38,0)")), F.lit(0)).alias("total"),
            F.count(F.when(F.col("distance").isNull(), 1)).alias("unknown"),
        )
        .collect()
    )
    whole = _total(sums)
    known = rows.sparkSession.createDataFrame(
        [
            (r["cluster"], _total([r]), whole, ",".join(str(x) for x in centroids[r["cluster"]]))
            for r in sums
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid string",
    )
    # One row per centroid.
    return rows.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
