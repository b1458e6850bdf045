"""Quality classifier: supervised subword embeddings.

A text is the average of the learned vectors of its hashed words, word pairs
and character n-grams; a softmax layer gives the class. Vectors and layer are
trained by numpy stochastic gradient descent over a bounded sample of labelled
rows (``max_train``, a stated parameter, so the fit costs the same at any
corpus size). Scoring reads every whole text once: softmax of an average of
vectors only needs each bucket's vector times the layer, so the model that
tasks get is one number per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.common import crc_fold, map_texts
from demandgrid.llm.subwords import Block, Words, bucket, char_ngrams, span_sums, words


@dataclass(frozen=True)
class Settings:
    bits: int = 17              # buckets of words, pairs and n-grams together
    grams: tuple[int, ...] = (3, 4)
    width: int = 16             # of the vectors
    epochs: int = 6
    rate: float = 1.0
    max_train: int = 3000       # labelled rows learned from, at most
    seed: int = 7


def _features(block: Block, s: Settings) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, counted, first, last) of each kind of feature; first and last
    delimit the features of each text."""
    out = []
    for n in s.grams:
        ids, ok = char_ngrams(block, n, s.bits)
        out.append((ids, ok, block.starts, block.ends))
    w: Words = words(block)
    out.append((bucket(w.codes, s.bits), np.ones(len(w.codes), bool), w.first, w.last))
    if len(w.codes) > 1:
        left, right = w.codes[:-1], w.codes[1:]
        pair = np.where(left == right, np.uint64(0xA5A5A5A5), left * np.uint64(3) + right * np.uint64(0x2545F4914F6CDD1D))
        ok = np.ones(len(pair), bool)
        ends = w.last[w.last > w.first] - 1
        ok[ends[ends < len(pair)]] = False      # no pair across texts
        out.append((bucket(pair, s.bits), ok, w.first, w.last))
    return out


@dataclass
class Model:
    settings: Settings
    weight: np.ndarray          # per bucket: its vector times (layer of 1 - layer of 0)
    bias: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Probability of label 1 per text (no features: the bias alone)."""
        block = Block.of(texts)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for ids, ok, first, last in _features(block, self.settings):
            total += span_sums(np.where(ok, self.weight[ids], 0.0), first, last)
            count += span_sums(ok.astype(np.int64), first, last)
        z = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent over (buckets, shares) of each text."""
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1, 1, (1 << s.bits, s.width)).astype(np.float32) / s.width
    layer, bias = np.zeros((s.width, 2), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, s.epochs * len(bags)), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            rate = s.rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            down = layer @ p
            layer -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            # a share is below 1 by the text's length: scaled so that long texts move their vectors too
            vectors[ids] -= rate * np.outer(share / share.max(), down)
    diff = layer[:, 1] - layer[:, 0]
    return Model(s, (vectors @ diff).astype(np.float64), float(bias[1] - bias[0]))


def sample(docs: DataFrame, labels: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality") -> list:
    """The labelled training rows: ids outside the held-out fold with a 0/1
    label (the mean of repeated labels, ties 1), the ``max_train`` first by a
    hash of the id; features are made in the tasks, so whole texts never meet
    on the driver."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_fold(id_col, 3) != 1))
              .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(s.max_train))
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id"))

    def block(ids: list, texts: list, marks: list) -> pa.RecordBatch:
        bags = []
        for t in texts:
            one = Block.of([t])
            parts = [i[ok[:len(i)]] for i, ok, _, _ in _features(one, s)]
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            bags.append((found.astype(np.int32).tobytes(), (n / max(1, n.sum())).astype(np.float32).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([b[0] for b in bags], pa.binary()),
             pa.array([b[1] for b in bags], pa.binary()), pa.array(marks, pa.int32())], ["id", "buckets", "shares", "label"])

    return map_texts(texts, "id", "text", "id long, buckets binary, shares binary, label int", block, extra=("label",)).collect()


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Model from the sample; without labelled rows every text scores 0.5."""
    rows = sorted(sample(docs, labels, s, id_col, text_col, label_col), key=lambda r: (r["id"], bytes(r["buckets"])))
    bags = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
    kept = [i for i, b in enumerate(bags) if len(b[0])]
    return train([bags[i] for i in kept], np.array([rows[i]["label"] for i in kept], dtype=np.int64), s)


def score_column(spark: SparkSession, model: Model, text_col: str, block_bytes: int = 4 << 20) -> Column:
    """Score of each row's whole text, as a column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values, out, part, size = texts.tolist(), [], [], 0
        for k, t in enumerate(values):
            part.append(t)
            size += len(t or b"")
            if size >= block_bytes or k + 1 == len(values):
                out.append(shared.value.scores(part))
                part, size = [], 0
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def classify(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``.

    Null, empty and blank texts have no features and score as the bias alone;
    null ids are never learned from; repeated rows each get a row; other
    columns of either table are ignored; an empty table gives no rows."""
    model = fit(docs, labels, s, id_col, text_col, label_col)
    out = docs.select(F.col(id_col).cast("long").alias("id"), score_column(docs.sparkSession, model, text_col).alias("score"))
    return out.select(F.col("id").alias(id_col), (crc_fold("id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
