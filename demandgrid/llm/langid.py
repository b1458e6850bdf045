"""Language identification by nearest centroid.

A text is its TF-IDF vector over hashed character n-grams, scaled to length 1.
Each language has several centroids (spherical k-means over its training
vectors); the language of the most similar centroid is predicted, with the
cosine as score, and the text is marked as rejected when it is farther from
that centroid than the centroid's own training texts are.

Document frequencies cover all training rows (partial counts per task, then one
small aggregate); centroids are fitted on at most ``per_language`` texts of each
language, a stated bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import crc_fold, map_texts
from demandgrid.llm.subwords import Block, char_ngrams

UNKNOWN = "und"
# ASCII other than letters says nothing about the language: a boundary.
LETTERS = bytes(c if c > 127 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass(frozen=True)
class Settings:
    bits: int = 12              # buckets of n-grams (4,096)
    grams: tuple[int, ...] = (2, 3, 4)
    clusters: int = 4           # centroids of a language
    per_language: int = 600     # texts that a language's centroids are fitted on, at most
    rounds: int = 12
    reject_quantile: float = 0.001
    chunk: int = 64             # texts counted at once in a task


def counts(texts: list[bytes | None], s: Settings) -> np.ndarray:
    """N-gram counts, a row per text."""
    size = 1 << s.bits
    block = Block.of([None if t is None else t.translate(LETTERS) for t in texts])
    out = np.zeros(len(texts) * size, dtype=np.int64)
    for n in s.grams:
        ids, ok = char_ngrams(block, n, s.bits)
        owner = np.repeat(np.arange(len(texts)) * size, block.ends - block.starts)[:len(ids)]
        out += np.bincount((ids + owner)[ok], minlength=len(out))
    return out.reshape(len(texts), size)


def weighted(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(n).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _chunks(texts: list, s: Settings, most: int = 1 << 20) -> Iterator[tuple[int, list]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and end - at < s.chunk and (end == at or size + len(texts[end] or b"") <= most):
            size += len(texts[end] or b"")
            end += 1
        yield at, texts[at:end]
        at = end


@dataclass
class Model:
    settings: Settings
    languages: list[str]        # of each centroid
    centroids: np.ndarray
    limits: np.ndarray          # similarity below which a text is rejected, per centroid
    idf: np.ndarray

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection per text."""
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at, part in _chunks(texts, self.settings):
            if not len(self.centroids):
                names += [UNKNOWN] * len(part)
                continue
            cos = weighted(counts(part, self.settings), self.idf) @ self.centroids.T
            best = cos.argmax(axis=1)               # ties: the first language in order
            names += [self.languages[b] for b in best]
            top = cos[np.arange(len(part)), best]
            scores[at:at + len(part)] = np.clip(top, 0, 1)
            rejected[at:at + len(part)] = top < self.limits[best]
        return names, scores, rejected


def _cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means, begun with the vectors farthest from those chosen."""
    chosen = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        near = np.max(x @ np.array(chosen).T, axis=1)
        chosen.append(x[int(near.argmin())])
    c = np.array(chosen)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def document_frequencies(docs: DataFrame, text_col: str, s: Settings) -> tuple[int, np.ndarray]:
    """Rows and, per bucket, rows with the n-gram, over all of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << s.bits, np.int64), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for _, part in _chunks(batch.column(0).slice(lo, 256).to_pylist(), s):
                    total += (counts(part, s) > 0).sum(axis=0)
                    rows += len(part)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, np.arange(len(total))]), pa.array(np.r_[rows, total])], ["bucket", "n"])

    found = (docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())     # buckets + 1 rows at any size
    df = np.zeros(1 << s.bits, np.int64)
    rows = 0
    for r in found:
        if r["bucket"] < 0:
            rows = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return rows, df


def fit(docs: DataFrame, learn: Column, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Model from the rows for which ``learn`` holds and whose text and language
    are not null."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).withColumn(text_col, F.lower(text_col))
    n, df = document_frequencies(rows, text_col, s)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # the first of each language by a hash of the id: first within 64 hash slices
    # of the language, so that a common language does not meet in one task, then
    # among what these leave (at most 64 * per_language rows of a language)
    order = [F.xxhash64("id"), F.col("id")]
    named = rows.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang")).withColumn(
        "slice", F.pmod(F.xxhash64("id"), F.lit(64)))
    slices = named.withColumn("k", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    each = slices.where(F.col("k") <= -(-4 * s.per_language // 64)).drop("k")
    ranked = each.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    # languages x per_language ids, whatever the corpus
    chosen = F.broadcast(ranked.where(F.col("k") <= s.per_language).select("id").distinct())
    sample = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).join(chosen, "id")

    def block(ids: list, texts: list, langs: list) -> pa.RecordBatch:
        vectors = []
        for _, part in _chunks(texts, s):
            vectors += [v.tobytes() for v in weighted(counts(part, s), idf)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(vectors, pa.binary())], ["id", "lang", "v"])

    found = map_texts(sample, "id", "text", "id long, lang string, v binary", block, extra=("lang",)).collect()
    by_lang: dict[str, list[bytes]] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["id"], bytes(r["v"]))):
        by_lang.setdefault(r["lang"], []).append(bytes(r["v"]))
    names, centroids, limits = [], [], []
    for lang, vectors in by_lang.items():
        x = np.stack([np.frombuffer(v, np.float32) for v in vectors])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            continue
        c = _cluster(x, s.clusters, s.rounds)
        cos = x @ c.T
        own = cos.argmax(axis=1)
        for j in range(len(c)):
            names.append(lang)
            centroids.append(c[j])
            limits.append(float(np.quantile(cos[own == j, j], s.reject_quantile)) if (own == j).any() else 0.0)
    return Model(s, names, np.array(centroids, np.float32), np.array(limits), idf)


def identify(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``,
    ``rejected``.

    Learned from texts and languages outside the held-out fold. A null text or
    one without a letter is ``und`` (score 0, rejected), as is every text when
    there is nothing to learn from; rows with a null language are predicted but
    not learned from; repeated rows each get a row; other columns are ignored;
    an empty table gives no rows."""
    learn = crc_fold(id_col, 4) != 2
    model = fit(docs, learn, s, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)     # languages x clusters x buckets

    def block(ids: list, texts: list, letters: list) -> pa.RecordBatch:
        known = [k for k, has in enumerate(letters) if has]
        langs, scores, rejected = [UNKNOWN] * len(ids), np.zeros(len(ids)), np.ones(len(ids), bool)
        found = shared.value.predict([texts[k] for k in known])
        for k, lang in zip(known, found[0]):
            langs[k] = lang
        scores[known], rejected[known] = found[1], found[2]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs), pa.array(scores), pa.array(rejected)],
                                          ["id", "lang_pred", "score", "rejected"])

    src = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"),
                      F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    out = map_texts(src, "id", "text", "id long, lang_pred string, score double, rejected boolean", block, extra=("has_letter",))
    return out.select(F.col("id").alias(id_col), (crc_fold("id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
