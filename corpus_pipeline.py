"""From raw documents to packed training sequences, in five stages.

Each stage works on what its predecessor kept. All but the last return the columns of
documents; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetstream.llm import jaccard, languages, mixing, packing, substring_dedup
from fleetstream.llm.queries import END_ID, SEQUENCE_TOKENS, TARGETS, vocabulary
from fleetstream.llm.storage import broadcast_if_small, fresh, ship_package, written

#: Documents whose language is less probable than this are rejected.
LEAST_LANGUAGE_SCORE = 0.5


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one, so that none is taken for another."""
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c not in _OWN]
    return docs.select(*_OWN, F.struct(F.lit(0).alias("c"), *others).alias("_row"))


_OWN = ("doc_id", "text")


def _columns(names: list[str]) -> dict[str, Column]:
    """The columns of packed rows by their names."""
    return {c: F.col(c) if c in _OWN else F.col("_row")[f"c{k}"] for k, c in enumerate(names)}


def _unpacked(rows: DataFrame, names: list[str], changed: dict | None = None) -> DataFrame:
    found = _columns(names) | (changed or {})
    return rows.select(*[found[c].alias(c) for c in names])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; the others are rejected.

    Rows with a null text or no letters go; every other column stays as it is, whatever its
    name, and so do repeated rows. An empty table stays empty.
    """
    ship_package(spark)
    rows = _packed(docs).withColumn("lang", _columns(docs.columns)["lang"])
    told = languages.identified(rows)
    sure = (F.col("lang_pred") != languages.UNDETERMINED) & (
        F.col("lang_score") >= LEAST_LANGUAGE_SCORE
    )
    return _unpacked(told.where(sure), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least doc_id.

    Rows without a doc_id belong to no group and stay, as do all rows of the least one.
    Columns of any names stay; an empty table stays empty.
    """
    ship_package(spark)
    found = jaccard.near_duplicates(docs.select("doc_id", "text"))
    name = fresh("gone", docs.columns)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias(name)
    )
    gone = broadcast_if_small(written(gone.distinct(), "gone"))
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; texts left empty go.

    A text from which nothing is removed stays as it is, null and empty ones too; ``n_chars``
    follows the text. Other columns stay, whatever their names; an empty table stays empty.
    """
    ship_package(spark)
    found = substring_dedup.without_repeats(_packed(docs))
    cut = F.col("n_removed") > 0
    own = _columns(docs.columns)
    text = F.when(cut, F.col("kept_text")).otherwise(own["text"])
    rows = found.where(~cut | (F.col("n_removed") < F.col("n_words")))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.char_length(text).cast(kind)).otherwise(own["n_chars"])
    return _unpacked(rows, docs.columns, changed)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say.

    A null or empty text has equal posteriors and no tokens; repeated rows are documents of
    their own. Columns of any names stay; an empty table stays empty.
    """
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mixed_documents(_packed(docs), labels, TARGETS)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    rows = mixed.where("copies > 0").select(*_OWN, "_row", copies.alias("_copy"))
    return _unpacked(rows, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it.

    A null or empty text is a piece of its end token alone. Documents of the same doc_id,
    copies too, are packed each by itself; columns other than doc_id and text don't matter.
    An empty table gives no pieces.
    """
    ship_package(spark)
    return packing.pack_documents(
        docs, vocabulary("byte_bpe_50k.json"), SEQUENCE_TOKENS, END_ID
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The stages learn models, follow links and cut tokens, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
