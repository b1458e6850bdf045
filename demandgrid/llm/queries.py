"""Registered queries of the subpackage: each applies one operator to its
whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import bpe, classifier, edit_embedding, hnsw, langid, ngram_lm, packing, prefix_trie, quality_rules, resampling, simhash, substring, token_count
from demandgrid.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), "doc_id", "text", iterations=20)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 words; exact copies (of the text in lower case) are one
    duplicate cluster."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", quality_rules.word_count("text").alias("n_words"),
        F.xxhash64(F.lower("text")).alias("copies"))
    return packing.pack(docs, "n_words", "copies", s=packing.Settings(capacity=2048))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=4, max_distance=4)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                               classifier.Settings(max_train=3000))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", hnsw.Settings(threshold=0.9))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), folds=5, held_out=1)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), langid.Settings())


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), lexicon=1 << 17)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               s=resampling.Settings(longest=2, buckets=10_000, share=25, min_words=20, seed=7))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations rebuilt to share beginnings."""
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns, family=5, lent=9), prefix_trie.Settings(container=1 << 16))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited version, and the group of near
    duplicates that banding and verification of the fingerprints give."""
    found = edit_embedding.with_successor(table(spark, sf_dir, "documents"))
    return edit_embedding.near_duplicates(found).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_language_id": op8_language_id,
    "op9_bpe_encode_decode": op9_bpe_encode_decode,
    "op10_token_counts": op10_token_counts,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_document_fingerprints": op13_document_fingerprints,
}
ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle_sql(iterations=20),
    "op11_importance_resampling": resampling.oracle_sql(),
    "op12_prefix_trie": prefix_trie.oracle_sql(),
}
