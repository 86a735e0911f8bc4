"""Mixing documents to target weights by soft membership.

A classifier trained on a bounded sample of the labelled table gives every document a
posterior over domains. Document rates (how often a document is expected to be used) are
then fitted so that the expected tokens of the domains meet their targets, with nonnegative
rates as close to 1 as that allows. The dual problem has one unknown per domain, a step of
its search needs some numbers per domain from all documents, and a rate follows from the
unknowns and the document's own posterior, so rates are never gathered anywhere.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.llm.languages import Scorer, WordModel, fit, posterior
from fleetstream.llm.storage import chance, fresh, release_memory, written

#: Labelled documents per domain that the classifier is trained on, about.
SAMPLE_PER_DOMAIN = 1_000
#: A posterior is as sharp as that of a text with so many words, however long it is.
SHARPNESS_WORDS = 40
MOST_STEPS = 200
#: Largest miss of a domain's share of all tokens, if the targets are in reach.
TOLERANCE = 1e-4
#: Weighs the distance of the rates from 1 against the misses; a miss is this times a
#: number that is moderate for targets in reach.
_PULL = 1e-9
#: Lengths of a step that are tried together.
_LENGTHS = 0.5 ** np.arange(24)

_log = logging.getLogger(__name__)


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id, domain from the labelled table: quality and toxicity together.

    Rows with a null and all but one of several rows of a document are left out.
    """
    whole = labels.dropna(subset=["doc_id", "quality", "toxic"])
    name = F.concat(F.lit("quality"), F.col("quality"), F.lit("_toxic"), F.col("toxic"))
    return whole.select("doc_id", name.alias("domain")).groupBy("doc_id").agg(
        F.min("domain").alias("domain")
    )


def fit_domains(
    docs: DataFrame, domains: DataFrame, sample: int = SAMPLE_PER_DOMAIN, most: int = 64
) -> WordModel:
    """The domain classifier. ``domains`` has doc_id and domain.

    The sample is taken by a hash of doc_id, so texts that aren't in it don't move. Rows
    without a doc_id teach nothing; empty tables give a model without domains.
    """
    sizes = {r["domain"]: r["count"] for r in domains.groupBy("domain").count().limit(
        most + 1).collect()}
    if len(sizes) > most:
        raise ValueError(f"more than {most} domains")
    if not sizes:
        return fit(docs.limit(0).withColumn("_domain", F.lit("")), "_domain")
    share = F.create_map(
        *[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))]
    )
    chosen = domains.where(chance("doc_id") < share[F.col("domain")])
    # About ``sample`` ids per domain and at most ``most`` domains.
    taught = docs.select("doc_id", "text").join(
        F.broadcast(chosen.withColumnRenamed("domain", "_domain")), "doc_id"
    )
    return fit(written(taught, "taught"), "_domain", docs_per_label=2 * sample)


def memberships(docs: DataFrame, model: WordModel) -> DataFrame:
    """docs with _tokens (words) and _p, the posteriors of the model's domains.

    A text without words has no tokens and equal posteriors; an untrained model has one
    domain. All columns and repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_memory()
        scorer = Scorer(shared.value)
        k = max(1, len(scorer.labels))
        for texts in batches:
            tokens, found = [], []
            for text, (scores, words) in zip(texts, scorer.scored(texts)):
                tokens.append(len(text.split()) if text else 0)
                words = words if scorer.labels else 0
                if words > SHARPNESS_WORDS:
                    scores = scores * (SHARPNESS_WORDS / words)
                found.append(posterior(scores) if words else np.full(k, 1 / k))
            yield pd.DataFrame({"tokens": tokens, "p": found})
        del scorer
        release_memory()

    udf = F.pandas_udf(score, "tokens bigint, p array<double>")
    found = fresh("found", docs.columns)
    return docs.withColumn(found, udf("text")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("_tokens", "_p")],
        F.col(found)["tokens"].alias("_tokens"),
        F.col(found)["p"].alias("_p"),
    )


def _sums(members: DataFrame, total: float, points: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every point: what half the squared rates weigh, the domains' shares, and (of the
    first point) the weighted products of the posteriors with a rate above 0."""
    many, k = points.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, shares, gram = np.zeros(many), np.zeros((many, k)), np.zeros((k, k))
        for batch in batches:
            p = batch.column("_p").flatten().to_numpy().reshape(batch.num_rows, k)
            tokens = batch.column("_tokens").to_numpy() / total
            for i, point in enumerate(points):
                rate = np.maximum(0.0, 1 + p @ point)
                squares[i] += (tokens * rate**2).sum() / 2
                shares[i] += (tokens * rate) @ p
                if i == 0:
                    gram += (p * (tokens * (rate > 0))[:, None]).T @ p
        numbers = np.concatenate([squares, shares.ravel(), gram.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(numbers))), pa.array(numbers)], names=["i", "x"]
        )

    # As many rows as numbers; in order, so that the order of additions doesn't show.
    parts = members.select("_tokens", "_p").mapInArrow(add, "i bigint, x double")
    summed = parts.groupBy("i").agg(
        F.aggregate(F.array_sort(F.collect_list("x")), F.lit(0.0), lambda a, b: a + b).alias("x")
    )
    found = np.zeros(many + many * k + k * k)
    for r in summed.collect():
        found[r["i"]] = r["x"]
    return (
        found[:many],
        found[many : many + many * k].reshape(many, k),
        found[many + many * k :].reshape(k, k),
    )


def fit_rates(
    members: DataFrame, targets: list[float], tolerance: float = TOLERANCE
) -> tuple[Column, list[float]]:
    """The rate as a column over _p, and the shares of all tokens that it leads to.

    ``members`` is a stored table with _tokens and _p; ``targets`` are shares of today's
    tokens per domain. Of all rates that meet the targets those are taken that are closest
    to 1, distances counting by tokens: max(0, 1 + p . x) for one x of a number per domain,
    which Newton steps on the dual problem find. A step is one or two small aggregates.
    No tokens leave all rates at 1. Targets out of reach are approached as far as they can
    be, and logged; a search that doesn't end is an error.
    """
    k, goal = len(targets), np.array(targets, dtype=float)
    total = float(members.agg(F.sum("_tokens")).first()[0] or 0)
    if not total:
        return F.lit(1.0), [0.0] * k

    def value(points: np.ndarray, squares: np.ndarray) -> np.ndarray:
        return squares - points @ goal + _PULL / 2 * (points**2).sum(axis=1)

    x = np.zeros(k)
    for _ in range(MOST_STEPS):
        squares, shares, gram = _sums(members, total, x[None])
        reached = shares[0]
        slope = reached - goal + _PULL * x
        if np.abs(reached - goal).max() <= tolerance or np.abs(slope).max() <= tolerance / 100:
            break
        step = -np.linalg.solve(gram + _PULL * np.eye(k), slope)
        points = x + _LENGTHS[:, None] * step
        tried = value(points, _sums(members, total, points)[0])
        enough = tried <= value(x[None], squares)[0] + 1e-4 * _LENGTHS * (slope @ step)
        # Beside the end of the search, rounding hides what a step gains.
        x = points[int(enough.argmax()) if enough.any() else int(tried.argmin())]
    else:
        raise RuntimeError(f"rates did not settle: shares {reached}, targets {goal}")
    if np.abs(reached - goal).max() > tolerance:
        _log.warning("targets %s are out of reach; shares are %s", goal.tolist(), reached.tolist())
    return F.greatest(
        F.lit(0.0),
        F.lit(1.0) + sum((F.get("_p", F.lit(i)) * float(x[i]) for i in range(k)), F.lit(0.0)),
    ), [float(s) for s in reached]


def mixed_documents(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float]
) -> DataFrame:
    """docs with n_tokens, posteriors, rate and copies; columns of these names are replaced.

    ``targets`` weighs domains; those without a target or without labelled documents
    count for nothing, and the weights are scaled to 1. ``copies`` is the rate rounded up
    or down by a hash of the row, so that its expectation is the rate.
    """
    model = fit_domains(docs, domain_of(labels))
    weights = [max(0.0, targets.get(x, 0.0)) for x in model.labels] or [1.0]
    if not sum(weights):
        raise ValueError(f"none of the domains {model.labels} has a target")
    shares = [w / sum(weights) for w in weights]
    kept = [c for c in docs.columns if c not in _RESULT]
    own = {c: F.col(c) for c in ("doc_id", "text")}
    others = [c for c in kept if c not in own]
    row = F.struct(
        F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(others)]
    )
    rows = docs.select(*own, row.alias("row"))
    own |= {c: F.col("row")[f"c{n}"] for n, c in enumerate(others)}
    members = written(memberships(rows, model), "members")
    rate, reached = fit_rates(members, shares)
    _log.info("shares of %s: targets %s, reached %s", model.labels, shares, reached)
    up = F.col("rate") % 1 > chance("doc_id", "text", F.lit("copies"))
    return members.select("*", F.round(rate, 9).alias("rate")).select(
        *[own[c].alias(c) for c in kept],
        F.col("_tokens").alias("n_tokens"),
        F.col("_p").alias("posteriors"),
        "rate",
        (F.floor("rate") + F.when(up, 1).otherwise(0)).cast("int").alias("copies"),
    )


_RESULT = ("n_tokens", "posteriors", "rate", "copies")
