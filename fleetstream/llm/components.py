"""Connected components of a graph given by its links.

Links are first thinned to a forest where they lie, then turned into stars by alternating
large-star and small-star rounds, of which about log(nodes) are needed. A round joins two
written tables, so that a hub with many links is split like any skewed join; the driver
sees only counts. Rounds end as soon as all links are stars, before the first one too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetstream.llm.storage import in_tasks_of, written

_MOST_ROUNDS = 60
#: Links that one task of a round handles.
_TASK_LINKS = 100_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links and the least node it is linked with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        # Hook the greater root of each link under the least it meets, then flatten.
        x, y = root[a], root[b]
        high, low = np.maximum(x, y), np.minimum(x, y)
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
        x, y = root[a], root[b]
        a, b = a[x != y], b[x != y]
    return nodes, nodes[root]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        node, root = roots(a, b)
        keep = node != root
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[keep]), pa.array(root[keep])], names=["a", "b"]
        )


def _settled(stars: DataFrame, links: int) -> bool:
    """Whether every node has one link down, to a node that has none."""
    ends = stars.select(F.col("a").alias("id"), F.lit(1).alias("up")).union(
        stars.select("b", F.lit(0))
    )
    nodes = ends.groupBy("id").agg(F.sum("up").alias("n"), F.min("up").alias("least"))
    left = nodes.where("n > 1 OR n = 1 AND least = 0").select("id")
    return in_tasks_of(left, links, _TASK_LINKS).agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """id, component: the least id that each linked id reaches.

    ``links`` has two bigint columns in any order; links of an id with itself and links
    with nulls are left out, repeated ones count once. Ids without a link are not in the
    result.
    """
    a, b = links.columns
    pairs = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")
    )
    thin = pairs.mapInArrow(_thinned, "a bigint, b bigint")
    stars = written(thin.distinct(), "links")
    number = stars.count()

    def kept(rows: DataFrame, name: str) -> DataFrame:
        return written(in_tasks_of(rows, number, _TASK_LINKS), name)

    for _ in range(_MOST_ROUNDS):
        if _settled(stars, number):
            break
        # Large star: everything above a node goes to the least node around it.
        both = stars.union(stars.select("b", "a"))
        least = kept(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least"
        )
        large = both.where(F.col("b") > F.col("a")).join(least, "a")
        stars = kept(
            large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large"
        )
        # Small star: a node and everything below it go to the least of them.
        least = kept(stars.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = stars.join(least, "a").where(F.col("b") != F.col("m"))
        stars = kept(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct(),
            "small",
        )
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
