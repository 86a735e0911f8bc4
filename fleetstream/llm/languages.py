"""Language of a text, word first.

A word that the training texts have is scored by its log frequency in every language. An
unseen word backs off to its character n-grams: the longest length of which the training
texts have at least one, scored by the mean log frequency of those n-grams. The scores of
all words of a text add up; the prediction is the most probable language.

The model is trained on a bounded sample of labelled texts and keeps every word of them.
Counting is done by Spark; what reaches the driver and the executors is bounded by the
sample alone, and is a table of 64-bit hashes in order with one small number per label.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.llm.storage import chance, fresh, release_memory
from fleetstream.llm.windows import mixed

UNDETERMINED = "und"
#: Letters only; digits, marks and signs separate words.
_WORDS = re.compile(r"[^\W\d_]+")
_LONGEST_GRAM = 4
#: What models for whole tables are trained with.
LONGEST_GRAM = 5
_SMOOTHING = 0.5
#: Words whose rows a Python worker remembers.
_REMEMBERED = 400_000
#: Words of texts that are scored together, about.
_TOGETHER = 100_000


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32(doc_id as text) mod 4 is 2.

    A null doc_id is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def _gram_hashes(words: list[str], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n from 1: the place of the word and the hash of every n-gram of marked words."""
    marked = "".join([f"<{w}>" for w in words])
    letters = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(letters))
    at, found = np.arange(len(letters)), np.zeros(len(letters), dtype=np.uint64)
    for n in range(1, longest + 1):
        more = left[at] >= n
        at, found = at[more], found[more]
        found = mixed(found + letters[at + n - 1] + np.uint64(1))
        yield word[at], found


def _gram_hash(grams: list[str]) -> np.ndarray:
    found = np.zeros(len(grams), dtype=np.uint64)
    for k, gram in enumerate(grams):
        for letter in gram:
            found[k : k + 1] = mixed(found[k : k + 1] + np.uint64(ord(letter) + 1))
    return found


@dataclass(frozen=True)
class Names:
    """The row of a name, by its hash; the hashes are in order."""

    hashes: np.ndarray
    hashed: Callable[[list[str]], np.ndarray]

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The rows, -1 for those that aren't here."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def __getitem__(self, name: str) -> int:
        row = int(self.rows(self.hashed([name]))[0])
        if row < 0:
            raise KeyError(name)
        return row

    def __len__(self) -> int:
        return len(self.hashes)


@dataclass(frozen=True)
class WordModel:
    """Log frequencies of words and n-grams: a row of one number per label for each."""

    labels: list[str]
    words: Names
    word_rows: np.ndarray
    grams: Names
    gram_rows: np.ndarray
    longest: int

    def of_unseen(self, word: str) -> np.ndarray:
        return self._of_unseen([word])[0]

    def _of_unseen(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)))
        done = np.zeros(len(words), dtype=bool)
        if not len(self.grams):
            return out
        for word, hashes in reversed(list(_gram_hashes(words, self.longest))):
            use = ~done[word]
            word, row = word[use], self.grams.rows(hashes[use])
            word, row = word[row >= 0], row[row >= 0]
            if not len(word):
                continue
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            known = np.diff(np.append(first, len(word)))[:, None]
            out[word[first]] = np.add.reduceat(self.gram_rows[row], first, dtype=float) / known
            done[word[first]] = True
        return out

    def rows_of(self, words: list[str]) -> np.ndarray:
        """The rows of words; zero for those that say nothing."""
        at = self.words.rows(_word_hashes(words))
        out = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        out[at >= 0] = self.word_rows[at[at >= 0]]
        unseen = np.flatnonzero(at < 0)
        if len(unseen):
            out[unseen] = self._of_unseen([words[k] for k in unseen])
        return out


def _log_frequencies(
    hashes: np.ndarray, label: np.ndarray, n: np.ndarray, labels: int
) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes in order, and their log frequencies by label."""
    names, at = np.unique(hashes, return_inverse=True)
    rows = np.zeros((len(names), labels), dtype=np.float32)
    for k in range(labels):
        own = label == k
        found = np.bincount(at[own], weights=n[own], minlength=len(names))
        rows[:, k] = np.log(found + _SMOOTHING) - np.log(
            found.sum() + _SMOOTHING * (len(names) + 1)
        )
    return names, rows


def _model(
    labels: list[str], label: np.ndarray, words: list[str], n: np.ndarray, longest: int
) -> WordModel:
    """From words with their labels' places and counts; no n-grams if ``longest`` is 0."""
    k = len(labels)
    if not words:
        none, rows = np.zeros(0, np.uint64), np.zeros((0, k), np.float32)
        return WordModel(
            labels, Names(none, _word_hashes), rows, Names(none, _gram_hash), rows, longest
        )
    hashes, word_rows = _log_frequencies(_word_hashes(words), label, n, k)
    grams, gram_rows = [np.zeros(0, np.uint64)], [np.zeros((0, k), np.float32)]
    for word, found in _gram_hashes(words, longest):
        found, rows = _log_frequencies(found, label[word], n[word], k)
        grams.append(found)
        gram_rows.append(rows)
    gram = np.concatenate(grams)
    order = np.argsort(gram)
    return WordModel(
        labels,
        Names(hashes, _word_hashes),
        word_rows,
        Names(gram[order], _gram_hash),
        np.concatenate(gram_rows)[order],
        longest,
    )


def build_model(
    counts: dict[str, Counter], backoff: bool = True, longest: int = _LONGEST_GRAM
) -> WordModel:
    """From counts of words per label; without ``backoff`` unseen words say nothing."""
    labels = sorted(counts)
    rows = [(k, w, n) for k, x in enumerate(labels) for w, n in counts[x].items()]
    label, words, n = zip(*rows) if rows else ((), (), ())
    return _model(
        labels,
        np.array(label, dtype=np.int64),
        list(words),
        np.array(n, dtype=float),
        longest if backoff else 0,
    )


def fit(
    docs: DataFrame,
    label: str = "lang",
    docs_per_label: int = 1_000,
    labels: int = 64,
    backoff: bool = True,
    longest: int = LONGEST_GRAM,
) -> WordModel:
    """Train on about ``docs_per_label`` whole texts of each label.

    The sample is taken by a hash of text and doc_id, where there is one, among the rows with
    text and label, so it doesn't depend on order or partitions. All of its words are kept; more than
    ``labels`` labels are an error.
    """
    told_by = [c for c in ("doc_id", "text") if c in docs.columns]
    usable = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col(label).cast("string").alias("_label"), "text", chance(*told_by).alias("_chance")
    )
    sizes = {r["_label"]: r["count"] for r in usable.groupBy("_label").count().limit(
        labels + 1).collect()}
    if len(sizes) > labels:
        raise ValueError(f"more than {labels} labels in {label}")
    if not sizes:
        return build_model({}, backoff)
    share = F.create_map(
        *[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, docs_per_label / n))]
    )
    sample = usable.where(F.col("_chance") < share[F.col("_label")]).select("_label", "text")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_memory()
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for name, text in zip(batch["_label"], batch["text"]):
                counts[name].update(_WORDS.findall(text.lower()))
            rows = [(x, w, n) for x, c in counts.items() for w, n in c.items()]
            yield pd.DataFrame(rows, columns=["_label", "_word", "_n"])
        release_memory()

    counted = (
        sample.mapInPandas(words, "_label string, _word string, _n bigint")
        .groupBy("_label", "_word")
        .agg(F.sum("_n").alias("_n"))
    )
    # Bounded by the sample.
    table = counted.toArrow()
    names = sorted(sizes)
    place = {x: k for k, x in enumerate(names)}
    return _model(
        names,
        np.array([place[x] for x in table.column("_label").to_pylist()], dtype=np.int64),
        table.column("_word").to_pylist(),
        table.column("_n").to_numpy().astype(float),
        longest if backoff else 0,
    )


class _Places(dict):
    """word -> place, in the order in which words are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        at = self[word] = len(self)
        return at


class Scorer:
    """Summed log frequencies of whole texts by label. Rows of words are remembered."""

    def __init__(self, model: WordModel):
        self.labels = model.labels
        self._model = model
        self._places = _Places()
        self._table = np.zeros((_REMEMBERED, len(model.labels)), dtype=np.float32)

    def _make_room(self, words: int) -> None:
        """Before so many words: forget, or grow for one very long text."""
        if len(self._places) + words <= len(self._table):
            return
        self._places.clear()
        if words > len(self._table):
            self._table = np.zeros((words, self._table.shape[1]), dtype=np.float32)

    def scored(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, int]]:
        """For every text the sums, and the number of words."""
        held, size = [], 0

        def sums() -> Iterator[tuple[np.ndarray, int]]:
            self._make_room(size)
            place, new = self._places.__getitem__, self._places.new
            every = [np.fromiter(map(place, words), np.int64, len(words)) for words in held]
            if new:
                last = len(self._places)
                self._table[last - len(new) : last] = self._model.rows_of(new)
                new.clear()
            for at in every:
                yield self._table[at].sum(axis=0, dtype=float), len(at)

        for text in texts:
            held.append(_WORDS.findall(text.lower()) if text else [])
            size += len(held[-1])
            if size > _TOGETHER:
                yield from sums()
                held, size = [], 0
        yield from sums()

    def scores(self, text: str) -> tuple[np.ndarray, int]:
        """The sums, and the number of words."""
        return next(self.scored([text]))


def posterior(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def predict(docs: DataFrame, model: WordModel) -> DataFrame:
    """docs with lang_pred and lang_score (0 to 1), from ``text`` alone.

    ``und`` with score 0 for a null text, a text without letters, or an untrained model.
    Equal scores go to the first label in order. All columns and repeated rows stay; a
    column named like a result is replaced.
    """
    context = docs.sparkSession.sparkContext
    # Bounded by the sample that the model was trained on.
    shared = context.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_memory()
        scorer = Scorer(shared.value)
        for texts in batches:
            found = []
            for text, (scores, _) in zip(texts, scorer.scored(texts)):
                if not text or not scorer.labels or not any(map(str.isalpha, text)):
                    found.append((UNDETERMINED, 0.0))
                    continue
                p = posterior(scores)
                best = int(p.argmax())
                found.append((scorer.labels[best], float(p[best])))
            yield pd.DataFrame(found, columns=["lang", "score"])
        del scorer
        release_memory()

    udf = F.pandas_udf(score, "lang string, score double")
    found = fresh("found", docs.columns)
    return docs.withColumn(found, udf("text")).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score")],
        F.col(found)["lang"].alias("lang_pred"),
        F.col(found)["score"].alias("lang_score"),
    )


def identified(docs: DataFrame, **bounds: int) -> DataFrame:
    """Train on the rows that aren't held out, and predict every row."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), **bounds)
    return predict(docs, model)
