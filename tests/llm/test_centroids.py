import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetstream.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = 2**63 - 1


def brute(rows, dims=64, k=8, rounds=10, seed="3"):
    kept = [
        (i, [math.floor(Fraction(x) * 1024) for x in v])
        for i, v, _ in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=key)[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(middle)), key=lambda c: (apart(v, middle[c]), c))
    for _ in range(rounds if kept else 0):
        groups = [[] for _ in middle]
        for _, v in kept:
            groups[nearest(v)].append(v)
        middle = [
            [sum(x) // len(g) for x in zip(*g)] if g else old for g, old in zip(groups, middle)
        ]
    found = [(i, nearest(v), apart(v, middle[nearest(v)])) for i, v in kept]
    fit = lambda x: x if x <= LONG else None
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    fits = lambda c: None if any(d > LONG for _, x, d in found if c in (None, x)) else True
    return sorted(
        [
            (i, c, fit(d), fits(c) and fit(inertia[c]), fits(None) and fit(sum(inertia.values())),
             ",".join(map(str, middle[c])))
            for i, c, d in found
        ],
        key=repr,
    )


def found(df, **options):
    rows = centroids.clustered(df, **options)
    assert rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    return sorted(map(tuple, rows.collect()), key=repr)


def vectors(n, seed, dims=64, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(dims)], i % 3) for i in range(n)]


@pytest.mark.parametrize("n", [1, 5, 8, 9, 200])
def test_like_brute_force(spark, n):
    rows = vectors(n, n)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_left_out_and_repeated_vectors(spark):
    rows = vectors(60, 1)
    rows += [(100, None, 1), (101, [], 1), (102, [1.0] * 63, 1), (103, [1.0] * 65, 1),
             (104, [None] + [1.0] * 63, None), (105, [math.nan] * 64, 1),
             (106, [math.inf] + [0.0] * 63, 1), (107, [0.0] * 64, None), (None, [0.5] * 64, 2)]
    rows += [rows[3]] * 40 + [(3, [2.0] * 64, 1)]
    want = brute(rows)
    assert len(want) == 60 + 2 + 41
    for parts in (1, 6):
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(parts)) == want


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [0.25] * 64, 0) for i in range(30)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and {r[1] for r in got} == {0}


def test_ids_missing(spark):
    rows = [(None, v, 0) for _, v, _ in vectors(4, 2)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_components_are_exact(spark):
    rows = vectors(30, 4) + [(50 + k, v, 0) for k, (_, v, _) in enumerate(vectors(12, 5, spread=3e5))]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    rows += [(90, [1.7e308] * 64, 0), (91, [-1.7e308, 5e-324] + [1.0] * 62, 0)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and any(r[4] is None for r in got)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []


def test_other_columns_and_settings(spark):
    rows = vectors(50, 6, dims=3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("x"))
    df = df.withColumn("e", F.lit(1)).withColumn("id", F.lit(2)).withColumn("distance", F.lit(3))
    got = found(df, dims=3, k=4, rounds=3, seed="s")
    assert got == brute(rows, dims=3, k=4, rounds=3, seed="s")


def test_tables_give_distances():
    rng = np.random.default_rng(3)
    a, c = rng.integers(-900, 900, (70, 5)), rng.integers(-900, 900, (4, 5))
    want = ((a[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (centroids.distances(a, c) == want).all()
    wide = a * 10**9
    assert (centroids.distances(wide.astype(object), c) == ((wide.astype(object)[:, None] - c[None]) ** 2).sum(axis=2)).all()
    values, place = centroids.occurring(a[:, 0])
    assert (values[place] == a[:, 0]).all() and (np.diff(values) > 0).all()


@pytest.mark.parametrize("n", [0, 1, -1, 2**31, -(2**32), 2**32, -(2**32) - 1, 3**80, -(3**80)])
def test_limbs(n):
    assert centroids.of_limbs(enumerate(centroids.limbs(n))) == n
    assert all(-(2**32) <= x < 2**32 for x in centroids.limbs(n))
