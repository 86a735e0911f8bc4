"""Near-duplicate vectors by product quantisation.

Unit vectors lie in inverted lists by their nearest coarse centroid; what is left of them
is coded per subspace by the nearest of a few centroids. A vector is compared with the
lists that can hold a neighbour: with cosine c, neighbours are at most d = sqrt(2 - 2c)
apart, so a neighbour's list is that of a centroid whose bisector with the vector's own
centroid is at most d away. Within a list, distances to the codes are sums of table
entries; a code is within d plus its own quantisation error of the vector wherever the
vector it stands for is within d. What passes is ranked again by the exact cosine. Both
bounds lose nothing, whatever sample the index was fitted on.

Equal vectors count as one with its number of copies. Long lists are cut into blocks, and
each pair of blocks is a group of its own; a group reports degrees and a forest of links,
not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetstream.llm.components import components, roots
from fleetstream.llm.storage import chance, written

#: Vectors that the index is fitted on at most, and its sizes.
SAMPLE = 8_192
LISTS = 64
CODES = 32
SUBSPACES = 8
#: Vectors of a list that are compared with each other in one group.
BLOCK = 2_048
_ROUNDING = 1e-6


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(1) - 2 * x @ centers.T).argmin(1)


def _fit_centers(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of x."""
    centers = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        at = _nearest(x, centers)
        counts = np.bincount(at, minlength=len(centers))
        for j in np.flatnonzero(counts):
            centers[j] = x[at == j].mean(0)
    return np.unique(centers, axis=0)


@dataclass(frozen=True)
class ProductIndex:
    """Coarse centroids, and centroids of the residuals per subspace."""

    coarse: np.ndarray
    cuts: list[int]
    codebooks: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray) -> ProductIndex:
        coarse = _fit_centers(x, LISTS)
        rest = x - coarse[_nearest(x, coarse)]
        cuts = sorted({round(k * x.shape[1] / SUBSPACES) for k in range(SUBSPACES + 1)})
        books = [_fit_centers(rest[:, a:b], CODES) for a, b in zip(cuts, cuts[1:])]
        return cls(coarse, cuts, books)

    def lists(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.coarse)

    def probes(self, x: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
        """Whether a vector within ``reach`` can be in each list."""
        square = (self.coarse**2).sum(1) - 2 * x @ self.coarse.T
        apart = np.sqrt(
            np.maximum(((self.coarse[own][:, None] - self.coarse) ** 2).sum(2), 0)
        )
        behind = square - square[np.arange(len(x)), own][:, None]
        return behind <= 2 * apart * reach + _ROUNDING

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and how far each is from what its codes stand for."""
        codes, error = np.empty((len(rest), len(self.codebooks)), np.int64), 0.0
        for m, (book, a, b) in enumerate(zip(self.codebooks, self.cuts, self.cuts[1:])):
            codes[:, m] = _nearest(rest[:, a:b], book)
            error = error + ((rest[:, a:b] - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """From whole residuals (rows) to coded ones (columns), by table lookup."""
        total = np.zeros((len(rest), len(codes)))
        for m, (book, a, b) in enumerate(zip(self.codebooks, self.cuts, self.cuts[1:])):
            part = rest[:, a:b]
            table = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Divided by the largest part first, so that no square overflows or vanishes.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def _usable(vectors: DataFrame) -> DataFrame:
    """Different vectors of a label that can be compared: id, n, label, vector."""
    whole = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    valid = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & whole
        & F.exists("embedding", lambda x: x != 0)
    )
    return (
        vectors.where(valid)
        .withColumn("vector", F.transform("embedding", lambda x: x + F.lit(0.0)))
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    )


def _fitted(distinct: DataFrame) -> dict[int, ProductIndex]:
    """An index per number of dimensions, from a bounded sample taken by hash."""
    counts = {
        r["d"]: r["count"]
        for r in distinct.groupBy(F.size("vector").alias("d")).count().limit(65).collect()
    }
    if len(counts) > 64:
        raise ValueError("more than 64 different numbers of dimensions")
    found = {}
    for d, n in counts.items():
        some = distinct.where(F.size("vector") == d)
        if n > SAMPLE // 2:
            some = some.where(chance("vector") < SAMPLE / 2 / n)
        rows = some.select("vector").limit(SAMPLE).toArrow().column("vector")
        found[d] = ProductIndex.fit(_unit(np.unique(_matrix(rows), axis=0)))
    return found


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors with equal labels and numbers of dimensions are linked if their cosine, in
    double precision, is at least ``cosine``. A vector that is null, zero, or holds nulls
    or numbers that aren't finite, and one without a label, is linked with nothing.
    Repeated rows are linked copies; a row without a vec_id has no links. No rows give no
    rows.
    """
    reach = float(np.sqrt(2 - 2 * cosine)) + _ROUNDING
    vectors = vectors.select("vec_id", "embedding", "label")
    distinct = written(_usable(vectors), "vectors")
    shared = distinct.sparkSession.sparkContext.broadcast(_fitted(distinct))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes):
                index, part = shared.value[int(d)], batch.filter(pa.array(sizes == d))
                for at in range(0, part.num_rows, 1024):
                    rows = part.slice(at, 1024)
                    x = _unit(_matrix(rows.column("vector")))
                    own = index.lists(x)
                    # The pair is found once: from its vector in the lower list.
                    lists = np.arange(len(index.coarse))
                    row, to = np.nonzero(
                        index.probes(x, own, reach) & (lists >= own[:, None])
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("id").take(pa.array(row)),
                            pa.array(to, pa.int32()),
                            pa.array(to == own[row]),
                        ],
                        names=["id", "list", "own"],
                    )

    dims = distinct.select("id", F.size("vector").alias("d"), "vector")
    probed = written(dims.mapInArrow(probe, "id bigint, list int, own boolean"), "probes")
    labelled = distinct.select("id", "label", "n", "vector", F.size("vector").alias("d"))
    placed = probed.join(labelled, "id")
    # Lists are cut into blocks of about BLOCK; a small table says into how many.
    blocks = (
        placed.groupBy("label", "d", "list")
        .agg(
            F.ceil(F.count(F.when(F.col("own"), 1)) / BLOCK).cast("int").alias("rows"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("columns"),
        )
        .where("rows > 0")
    )
    dealt = placed.join(blocks, ["label", "d", "list"])
    spread = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    base = ["label", "d", "list", "id", "n", "vector"]
    entries = (
        dealt.where("own")
        .select(*base, spread(F.col("rows")).alias("i"), every(F.col("columns")).alias("j"))
        .withColumn("entry", F.lit(True))
    )
    queries = (
        dealt.select(
            *base, "rows", spread(F.col("columns")).alias("j"), "own"
        )
        .select(*base, every(F.col("rows")).alias("i"), "j")
        .withColumn("entry", F.lit(False))
    )

    def compare(table: pa.Table) -> pa.Table:
        d, which = table.column("d")[0].as_py(), table.column("list")[0].as_py()
        index = shared.value[d]
        entry = table.column("entry").to_numpy()
        ids, copies = table.column("id").to_numpy(), table.column("n").to_numpy()
        x = _unit(_matrix(table.column("vector")))
        rest = x - index.coarse[which]
        held, asking = np.flatnonzero(entry), np.flatnonzero(~entry)
        nodes, node = np.unique(ids, return_inverse=True)
        degree, forest = np.zeros(len(nodes), np.int64), []
        if len(held):
            codes, error = index.encode(rest[held])
            own = index.lists(x[asking]) == which
            for at in range(0, len(asking), 256):
                q = asking[at : at + 256]
                near = index.distances(rest[q], codes) <= reach + error + _ROUNDING
                # In their own list two vectors meet twice.
                near &= ~own[at : at + 256, None] | (ids[q][:, None] < ids[held])
                r, c = np.nonzero(near)
                a, b = q[r], held[c]
                exact = (x[a] * x[b]).sum(1) >= cosine
                a, b = a[exact], b[exact]
                np.add.at(degree, node[a], copies[b])
                np.add.at(degree, node[b], copies[a])
                forest.append(roots(node[a], node[b]))
        nobody = np.zeros(0, np.int64)
        child, root = roots(*map(np.concatenate, zip(*forest))) if forest else (nobody, nobody)
        linked = degree > 0
        to = np.arange(len(nodes))
        to[child] = root
        return pa.table(
            {
                "id": pa.array(nodes[linked]),
                "degree": pa.array(degree[linked]),
                "root": pa.array(nodes[to[linked]]),
            }
        )

    met = written(
        entries.unionByName(queries)
        .groupBy("label", "d", "list", "i", "j")
        .applyInArrow(compare, "id bigint, degree bigint, root bigint"),
        "met",
    )
    degrees = met.groupBy("id").agg(F.sum("degree").alias("degree"))
    found = components(met.select("id", "root")).withColumnRenamed("id", "node")
    counted = (
        distinct.join(degrees, "id", "left")
        .join(found, F.col("id") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("degree", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    # Rows without a usable vector get none of it, as their key is null.
    keyed = vectors.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.col("label")).alias("label"),
        F.transform("embedding", lambda x: x + F.lit(0.0)).alias("vector"),
    )
    return keyed.join(counted, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )
