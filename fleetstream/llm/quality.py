"""Quality of a text by logistic regression on hashed word n-grams.

A text is a sequence of tokens: runs of letters, of digits, and of one sign. Its n-grams are
those of one and two words, and those of one to three shapes, where a shape tells the case
of a word, the sign, or that the word repeats the one before. All are hashed into one table
of weights; a score is a sparse dot product.

The weights follow the regularised leader: each example moves sums of gradients and of their
squares, from which the weights of its features are derived when they are needed. The
examples are a bounded sample of the labelled rows, dealt into a fixed number of shards by
their id. A pass lets every shard follow its own examples in a fixed order from common
sums and averages what they end with, so the model depends on the rows alone, not on how
Spark has dealt them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from fleetstream.llm.languages import held_out
from fleetstream.llm.storage import written
from fleetstream.llm.windows import Sums, Texts, lower_ascii, mixed

#: Documents per label that the model learns from, about.
DOCS_PER_LABEL = 4_000
PASSES = 4
SHARDS = 8
#: Texts of about so many bytes are hashed together; a longer one is hashed alone.
_TOGETHER = 1 << 17

_LETTER, _DIGIT = 1, 2
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_BYTES = np.random.RandomState(52_817).randint(1, 2**62, 256, dtype=np.int64).astype(np.uint64)

_CAPITALS, _TITLE, _SMALL_LETTERS, _NUMBER, _SAME = range(256, 261)


@dataclass(frozen=True)
class Settings:
    """Size of the table and of the steps."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


@dataclass(frozen=True)
class Leader:
    """What is known of every weight: sums of gradients and of squared gradients. The last
    place is the bias."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls, settings: Settings) -> Leader:
        size = (1 << settings.bits) + 1
        return cls(np.zeros(size), np.zeros(size))

    def weights(self, settings: Settings, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        far = np.abs(z) > settings.l1
        step = (settings.beta + np.sqrt(n)) / settings.alpha + settings.l2
        return np.where(far, (np.sign(z) * settings.l1 - z) / step, 0.0)


@dataclass(frozen=True)
class Tokens:
    hashes: np.ndarray
    shapes: np.ndarray
    text: np.ndarray


def tokens(texts: Texts) -> Tokens:
    """Runs of letters, digits or one sign, with their shapes; white space separates."""
    data, size = texts.data, len(texts.data)
    kind = _KIND[data]
    first = np.zeros(size + 1, dtype=bool)
    first[texts.offsets] = True
    first = first[:size]
    if size:
        first[0] = True
        differ = kind[1:] != kind[:-1]
        # A run of signs is a run of the same sign.
        first[1:] |= differ | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    start = np.flatnonzero(first)
    end = np.append(start[1:], size)
    solid = kind[start] != 0
    start, end = start[solid], end[solid]
    kind = kind[start]
    text = np.searchsorted(texts.offsets, start, "right") - 1

    lower = lower_ascii(texts).data
    hashes = Sums(_BYTES[lower]).of(start, end)
    capital = np.append(0, np.cumsum((data >= 65) & (data <= 90)))
    small = np.append(0, np.cumsum((data >= 97) & (data <= 122)))
    capitals, smalls = capital[end] - capital[start], small[end] - small[start]
    shapes = np.where(
        (capitals > 1) & (smalls == 0),
        _CAPITALS,
        np.where(capitals > 0, _TITLE, _SMALL_LETTERS),
    )
    shapes[kind == _DIGIT] = _NUMBER
    shapes[kind == 3] = data[start[kind == 3]]
    word = np.flatnonzero(kind == _LETTER)
    same = (hashes[word[1:]] == hashes[word[:-1]]) & (text[word[1:]] == text[word[:-1]])
    shapes[word[1:][same]] = _SAME
    hashes[kind == _DIGIT] = np.uint64(_NUMBER)
    return Tokens(hashes, shapes.astype(np.uint64), text)


def _grams(units: np.ndarray, text: np.ndarray, longest: int, salt: int):
    """Hash and text of every n-gram of 1 to ``longest`` units."""
    found, at = mixed(units + np.uint64(salt)), np.arange(len(units))
    for n in range(1, longest + 1):
        if n > 1:
            inside = at + n - 1 < len(units)
            at, found = at[inside], found[inside]
            inside = text[at + n - 1] == text[at]
            at, found = at[inside], found[inside]
            found = mixed(found * np.uint64(3) + units[at + n - 1])
        yield found, text[at]


def features(texts: Texts, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the table, value) of the n-grams of texts, in ascending order.

    Values are 1 + log of the count; those of words, and those of shapes, have length 1
    for every text, however long it is.
    """
    found = tokens(texts)
    parts = []
    for units, longest, salt in ((found.hashes, 2, 11), (found.shapes, 3, 97)):
        grams = list(_grams(units, found.text, longest, salt))
        hashes = np.concatenate([h for h, _ in grams]) >> np.uint64(64 - bits)
        text = np.concatenate([t for _, t in grams])
        key = (text.astype(np.uint64) << np.uint64(bits)) | hashes
        key, count = np.unique(key, return_counts=True)
        text = (key >> np.uint64(bits)).astype(np.int64)
        value = 1 + np.log(count)
        length = np.sqrt(np.bincount(text, value**2, minlength=len(texts)))
        parts.append((key, value / length[text] if len(text) else value))
    key = np.concatenate([k for k, _ in parts])
    # One place may stand for words and shapes; then their values add up.
    key, at = np.unique(key, return_inverse=True)
    value = np.bincount(at, np.concatenate([v for _, v in parts]), minlength=len(key))
    mask = np.uint64((1 << bits) - 1)
    return (key >> np.uint64(bits)).astype(np.int64), (key & mask).astype(np.int64), value


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def followed(
    leader: Leader, rows: list[tuple[np.ndarray, np.ndarray, float, float]], settings: Settings
) -> Leader:
    """The leader after (places, values, target, weight) of each example in turn."""
    z, n = leader.z.copy(), leader.n.copy()
    now = Leader(z, n)
    bias = len(z) - 1
    for places, values, target, weight in rows:
        places, values = np.append(places, bias), np.append(values, 1.0)
        w = now.weights(settings, places)
        miss = weight * (sigmoid(w @ values) - target)
        gradient = miss * values
        square = gradient**2
        sigma = (np.sqrt(n[places] + square) - np.sqrt(n[places])) / settings.alpha
        z[places] += gradient - sigma * w
        n[places] += square
    return now


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    settings: Settings = field(default_factory=Settings)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 of every text; nulls count as empty."""
        texts = Texts.of(column)
        out = np.full(len(texts), float(self.weights[-1]))
        for first, some in texts.slices(_TOGETHER):
            text, place, value = features(some, self.settings.bits)
            out[first : first + len(some)] += np.bincount(
                text, self.weights[place] * value, minlength=len(some)
            )
        return sigmoid(out)


def sampled_labels(labels: DataFrame, label: str, docs_per_label: int) -> DataFrame:
    """doc_id, target and weight of about ``docs_per_label`` documents of each label.

    Labels other than 0 and 1, and those of held-out documents, are not looked at. Labels
    of one document that disagree give the share of ones as the target. The sample takes
    the documents whose 64-bit hash of the id lies below a bound; the weights undo it.
    """
    value = F.col(f"`{label}`")
    known = (
        labels.where(value.isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg(value.cast("double")).alias("target"))
        .withColumn("positive", F.col("target") >= 0.5)
    )
    counts = {r["positive"]: r["n"] for r in known.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(label)), 1)
    take, weight = F.lit(False), F.lit(1.0)
    for positive, n in counts.items():
        share = min(1.0, docs_per_label / n)
        bound = min(int(share * 2.0**63), 2**63 - 1)
        mine = F.col("positive") == F.lit(positive)
        take = take | (mine & (chance <= F.lit(bound)))
        weight = F.when(mine, F.lit(1 / share)).otherwise(weight)
    return known.where(take).select("doc_id", "target", weight.alias("weight"))


def _examples(docs: DataFrame, labels: DataFrame, label: str, docs_per_label: int) -> DataFrame:
    """The sampled documents with a text, dealt into shards; one text of each doc_id, of
    several the one with the least hash."""
    # Bounded by the sample: two numbers for some docs_per_label ids of each label.
    chosen = F.broadcast(sampled_labels(labels, label, docs_per_label))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    key = F.xxhash64("doc_id", F.lit("shard"))
    return (
        texts.groupBy("doc_id")
        .agg(
            F.min_by("text", F.xxhash64("text")).alias("text"),
            F.first("target").alias("target"),
            F.first("weight").alias("weight"),
        )
        .select("text", "target", "weight", key.alias("key"))
        .withColumn("shard", F.pmod("key", F.lit(SHARDS)).cast("int"))
    )


def _pass(leader: Leader, settings: Settings):
    def shard(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group.column("key").to_numpy(), kind="stable"))
        target, weight = (group.column(c).to_numpy() for c in ("target", "weight"))
        rows = []
        for first, some in Texts.of(group.column("text")).slices(_TOGETHER):
            text, place, value = features(some, settings.bits)
            ends = np.searchsorted(text, np.arange(len(some) + 1))
            for k in range(len(some)):
                a, b = ends[k], ends[k + 1]
                at = first + k
                rows.append((place[a:b], value[a:b], target[at], weight[at]))
        end = followed(leader, rows, settings)
        return pa.table({"z": [end.z.tobytes()], "n": [end.n.tobytes()]})

    return shard


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    docs_per_label: int = DOCS_PER_LABEL,
    passes: int = PASSES,
    settings: Settings = Settings(),
) -> Model:
    """Train on documents with a label that are not held out.

    The driver sees ``SHARDS`` tables of weights per pass. Without any labelled document
    all weights are zero and every score is 0.5.
    """
    examples = written(_examples(docs, labels, label, docs_per_label), "examples")
    mean = examples.agg(F.avg("weight")).first()[0] or 1.0
    examples = examples.withColumn("weight", F.col("weight") / mean)
    leader = Leader.new(settings)
    for _ in range(passes):
        ends = (
            examples.groupBy("shard")
            .applyInArrow(_pass(leader, settings), "z binary, n binary")
            .collect()
        )
        if not ends:
            break
        # Added in a fixed order, so that rounding does not depend on the tasks.
        ends = sorted((bytes(r["z"]), bytes(r["n"])) for r in ends)
        z, n = (np.mean([np.frombuffer(e[k]) for e in ends], axis=0) for k in (0, 1))
        leader = Leader(z, n)
    return Model(leader.weights(settings).astype(np.float32), settings)


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The documents with their score; a column that has this name is replaced.

    Texts are scored whole. A null or empty text has the score of the bias alone; equal
    texts have equal scores; an empty table stays empty.
    """

    @arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(model.scores(batch))

    return docs.withColumn(name, score(F.col(f"`{text}`")))


def predicted(score: Column, least: float = 0.7) -> Column:
    return F.when(score >= least, 1).otherwise(0)
