"""Corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept:
quality rules and the quality classifier drop what they reject, SimHash keeps
one document of each near-duplicate group, substring deduplication cuts passages
that repeat, and packing lays the rest into sequences. All but the last return
the columns of ``documents``; every stage handles null ids and texts, repeated
rows and empty input as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import classifier, packing, quality_rules, simhash, substring
from demandgrid.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rule rates are fitted on the
    vote counts of all documents of this stage."""
    model = quality_rules.fit(quality_rules.features(docs.select("text")))
    return docs.where(quality_rules.keep("text", model)).select(*COLUMNS)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(classifier.score_column(spark, model, "text") >= 0.5).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id
    (of rows that repeat it, one). Documents without an id cannot be told apart
    from others by it and stay."""
    groups = simhash.near_duplicates(docs, "doc_id", "text", shingle=4, max_distance=4)
    keep = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too; one that
    has nothing else goes."""
    out = substring.without_repeats(docs.select(*COLUMNS))
    return out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 words: one row per document piece."""
    lengths = docs.select("doc_id", "source", quality_rules.word_count("text").alias("n_words"),
                          F.xxhash64(F.lower("text")).alias("copies"))
    return packing.pack(lengths, "n_words", "copies", s=packing.Settings(capacity=2048))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classify),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

# The classifier, the banding and the packing are not SQL; tests/llm compares
# each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one keeps is written to the shared folder before the
    next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
