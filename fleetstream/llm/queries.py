"""The dealt operators as queries over the stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetstream.llm import (
    centroids,
    embeddings,
    fingerprints,
    jaccard,
    languages,
    merkle,
    mixing,
    oracles,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    token_files,
    urls,
)
from fleetstream.llm.storage import ship_package

# The URL rules of the contract.
ALLOW_RULES = ("com/", "www.example.com/en/")
BLOCK_RULES = ("example.com/en/", "net/es/", "net/fr/")

#: Weights of the domains in the mix.
TARGETS = {
    "quality1_toxic0": 0.80,
    "quality0_toxic0": 0.15,
    "quality1_toxic1": 0.04,
    "quality0_toxic1": 0.01,
}
SEQUENCE_TOKENS = 1024
END_ID = 2


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).drop("text", "kept_text")


def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return fingerprints.edited_and_next(docs)


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack_documents(
        docs, vocabulary("byte_bpe_50k.json"), SEQUENCE_TOKENS, END_ID
    )


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    return languages.identified(docs).select(
        "doc_id",
        languages.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    labels = _table(spark, sf, "labels")
    return mixing.mixed_documents(docs, labels, TARGETS).drop("text")


def op6_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf, "embeddings"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return token_files.digests(
        token_files.stored_tokens(docs, vocabulary("word_bpe_49k.json"), END_ID)
    )


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs).drop("text", "kept")


def op9_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf, "documents"))


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return urls.judged_urls(pages, ALLOW_RULES, BLOCK_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    rows = merkle.verified_documents(_table(spark, sf, "documents"))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    rows = centroids.clustered(_table(spark, sf, "embeddings"))
    return rows.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def op13_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    rows = quality.scored(docs, quality.fit(docs, _table(spark, sf, "labels")))
    return rows.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        quality.predicted(F.col("score")).alias("predicted"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_substring_dedup,
        op2_fingerprints,
        op3_best_fit_packing,
        op4_language_id,
        op5_mixing,
        op6_embedding_near_dedup,
        op7_token_files,
        op8_suffix_dedup,
        op9_ngram_jaccard_join,
        op10_url_filter,
        op11_merkle_manifest,
        op12_centroid_clustering,
        op13_quality_classifier,
    )
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_embedding_near_dedup": oracles.NEAR_VECTORS,
    "op9_ngram_jaccard_join": oracles.NEAR_DUPLICATES,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op12_centroid_clustering": oracles.CENTROID_CLUSTERING,
}
