"""Importance resampling towards a target distribution.

Every run of 1 to ``longest`` consecutive words is a feature, hashed into
buckets by its CRC-32. Documents and target texts give a count per bucket; a
bucket's gain is the logarithm of how much commoner it is in the target. A
document's weight is the mean gain of its features, and a draw without
replacement by weight takes the highest sums of weight and Gumbel noise (noise of
the document's id, so a draw can be repeated).

CRCs: the distinct features of a block of texts are grouped by equal length into
two-dimensional byte matrices (a row each); all CRCs of a matrix advance column by
column through the 256-entry table, and buckets are scattered back to where the
features stand. Features are whole slices of the block's words joined by single
spaces, so a matrix is one gather.

At scale: two narrow passes over the texts (counts, weights) with no shuffle of
text; the counts are one row per bucket; ranks come from a count per score (whole
numbers of a range that the arithmetic bounds, about 130,000 values) that finds
the score at which the draw ends, then a range sort of the rows at or above it
only, numbered by partition offsets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import cut, map_texts
from demandgrid.llm.sql_crc import TABLE, crc32
from demandgrid.llm.subwords import distinct_spans

WIDEST = 4096                   # features of more bytes than this are no matrix rows: zlib's loop gives the same
SLAB = 1 << 22                  # bytes of one matrix


@dataclass(frozen=True)
class Settings:
    longest: int = 2            # words of the longest feature
    buckets: int = 10_000
    share: int = 25             # per cent of the documents with enough words
    min_words: int = 20
    seed: int = 7


def _letters() -> bytes:
    """Lower case of A-Z, digits, a-z and all bytes outside ASCII; the rest a space."""
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(c + 32 if 65 <= c <= 90 else c if c in keep else 32 for c in range(256))


LETTERS = _letters()


@cache
def crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


def crc_matrices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of each data[start:start + size], equal lengths together."""
    out = np.zeros(len(start), np.uint32)
    table = crc_table()
    order = np.argsort(size, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        n = int(size[group[0]]) if len(group) else 0
        if n > WIDEST:
            out[group] = [zlib.crc32(data[s:s + n].tobytes()) for s in start[group].tolist()]
            continue
        rows = max(1, SLAB // max(n, 1))
        for k in range(0, len(group), rows):
            part = group[k:k + rows]
            matrix = data[start[part] + np.arange(n)[:, None]]       # a column of the features is a row here
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = table[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[part] = ~crc
    return out


@dataclass
class Features:
    bucket: np.ndarray          # of every feature of the block, all single words first, then pairs, ...
    text: np.ndarray            # index of the text each is in
    words: np.ndarray           # words per text


def features(texts: Sequence[bytes | None], longest: int, buckets: int) -> Features:
    parts = [(t or b"").translate(LETTERS) for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    solid = raw != 32
    edge = np.diff(np.r_[False, solid].astype(np.int8))
    at, size = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(p) + 1 for p in parts])
    text = np.searchsorted(ends, at, side="right")
    size = size - at
    start = np.cumsum(size + 1) - (size + 1)
    data = np.full(int((size + 1).sum()), 32, np.uint8)              # words joined by one space each
    data[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = raw[solid]
    one, word = distinct_spans(data, start, size)
    found, where = [], []
    first, run, kinds = np.arange(len(at)), word, one                # of the runs: first word, number, a run of each number
    for k in range(1, longest + 1):
        if k > 1:
            keep = first + k - 1 < len(at)
            keep[keep] = text[first[keep]] == text[first[keep] + k - 1]
            pair = run[keep] * np.int64(len(one)) + word[first[keep] + k - 1]
            first = first[keep]
            _, kinds, run = np.unique(pair, return_index=True, return_inverse=True)
        begin = first[kinds] if k > 1 else kinds
        last = begin + k - 1
        crc = crc_matrices(data, start[begin], start[last] + size[last] - start[begin])
        found.append((crc % np.uint32(buckets)).astype(np.int64)[run])
        where.append(text[first])
    return Features(np.concatenate(found), np.concatenate(where), np.bincount(text, minlength=len(parts)))


def bucket_counts(df: DataFrame, text_col: str, s: Settings = Settings()) -> DataFrame:
    """``bucket, n``: features of all texts, repeats counted; blocks add up their
    own before the shuffle."""
    def run(ids: list, texts: list[bytes | None]) -> pa.RecordBatch:
        n = np.bincount(features(texts, s.longest, s.buckets).bucket, minlength=s.buckets)
        at = np.flatnonzero(n)
        return pa.record_batch({"bucket": at, "n": n[at]})

    rows = df.select(F.lit(0).alias("none"), F.col(text_col).alias("text"))
    return map_texts(rows, "none", "text", "bucket long, n long", run).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str, target_col: str, s: Settings = Settings()) -> np.ndarray:
    """Whole gain of every bucket: thousandths of the logarithm of the target's
    smoothed share over the documents' (``buckets`` numbers on the driver)."""
    counts = np.zeros((2, s.buckets), np.int64)
    for k, (df, col) in enumerate(((docs, text_col), (target, target_col))):
        for row in bucket_counts(df, col, s).collect():
            counts[k, row["bucket"]] = row["n"]
    all_s, all_t = (int(x) for x in counts.sum(axis=1))
    over, under = float(all_s + s.buckets), float(all_t + s.buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * over / ((n + 1.0) * under))) for n, t in counts.T.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, s: Settings = Settings()) -> DataFrame:
    """``id, n_words, n_features, weight``: a row per document."""
    def run(ids: list, texts: list[bytes | None]) -> pa.RecordBatch:
        f = features(texts, s.longest, s.buckets)
        n = np.bincount(f.text, minlength=len(texts))
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, f.text, gain[f.bucket])
        return pa.record_batch({"id": pa.array(ids, pa.int64()), "n_words": f.words.astype(np.int64), "n_features": n.astype(np.int64),
                                "weight": np.where(n > 0, total // np.maximum(n, 1), 0)})

    return map_texts(docs, id_col, text_col, "id long, n_words long, n_features long, weight long", run)


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in whole thousandths from the id's SHA-256 (a null id counts
    as the empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``scored`` (``id, n_words, score``, any more) with ``rank``: 1, 2, 3, ... over
    the highest scores of the rows with enough words, ties to the smaller id (then
    null ids, then the row that stands first), null where not drawn."""
    spark = scored.sparkSession
    scored = cut(scored).withColumn("__row", F.monotonically_increasing_id())
    enough = F.col("n_words") >= s.min_words
    by_score = sorted(((r["score"], r["n"]) for r in scored.where(enough).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    take = s.share * sum(n for _, n in by_score) // 100
    low, above = None, 0
    for low, n in by_score:                                          # noqa: B007
        above += n
        if above >= take:
            break
    if not take:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("__row")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("__row").asc()]
    top = cut(scored.where(enough & (F.col("score") >= low)).repartitionByRange(partitions, *order).sortWithinPartitions(*order))
    top = top.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    sizes = dict(top.groupBy("__part").agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    offset = spark.createDataFrame(offsets, "__part int, __before long")        # a row per partition
    place = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    ranked = top.join(F.broadcast(offset), "__part").withColumn("rank", F.when(place <= take, place))
    rest = scored.where(~(enough & (F.col("score") >= low))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest).drop("__row")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: id, ``n_features``, ``weight``, ``score``,
    ``rank`` (null: not drawn), ``n_words``.

    A null or empty text has no features and weight 0; it can't be drawn. Null ids
    and repeated rows are rows of their own (rows that repeat an id share its noise);
    texts are whole; other columns of whatever name are ignored. No documents give no
    rows; no target texts leave all target counts 0."""
    gain = gains(docs, target, text_col, target_col, s)
    scored = weights(docs, gain, id_col, text_col, s).withColumn("score", F.col("weight") + noise("id", s.seed))
    return draw(scored, s).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")


def oracle_sql() -> str:
    """DuckDB SQL of the registered query: words unnested into rows, one CRC per
    distinct feature, ranks by a window."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(name: str, table: str) -> str:
        return (f"{name}_w AS MATERIALIZED (SELECT row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
                rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws{', doc_id' if table == 'documents' else ''} FROM {table}),"
                f"{name}_f AS MATERIALIZED (SELECT rid, unnest(list_concat(ws, list_transform(range(1, greatest(len(ws), 1)), "
                f"lambda k: ws[k] || ' ' || ws[k + 1]))) AS f FROM {name}_w),\n")

    return f"""WITH {words("d", "documents")}{words("b", "benchmark")}
crc AS MATERIALIZED ({TABLE}),
kinds AS MATERIALIZED (SELECT DISTINCT f FROM (SELECT f FROM d_f UNION ALL SELECT f FROM b_f)),
bucketed AS MATERIALIZED (SELECT f, {crc32("f")} % 10000 AS bucket FROM kinds, crc),
s AS (SELECT bucket, count(*) AS n FROM d_f JOIN bucketed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b_f JOIN bucketed USING (f) GROUP BY bucket),
gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000)
    / ((s.n + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
per_doc AS (SELECT rid, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
    FROM d_f JOIN bucketed USING (f) JOIN gain USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM d_w LEFT JOIN per_doc USING (rid)),
drawn AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank, n_words::BIGINT AS n_words
FROM scored LEFT JOIN drawn USING (rid)"""

