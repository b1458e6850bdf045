"""Best-fit packing of documents into sequences of fixed length, with conflicts.

Documents longer than a sequence are split into full sequences and a rest; the
rests are packed by best-fit decreasing: bins are ordered by what is left in
them, each carries a bitmap of the sources and of the duplicate clusters in it,
and the search goes from the tightest bin that holds the piece to its successors
until one is compatible (no piece of the same duplicate cluster, and fewer than
``per_source`` of the same source); else a bin is opened.

Pieces are dealt at random over shards of about ``shard_pieces``, so a hot
source or cluster is spread evenly and a shard's bins fit one task whatever the
corpus; the bins of each shard are independent. Random shards keep the corpus'
mix of lengths, so the fill differs from one global packing only by the last
bins of each shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import cut


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048        # length units of a sequence
    per_source: int = 4         # pieces of one source in a bin, at most
    shard_pieces: int = 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[int]:
    """Bin of each piece. Pieces go in by falling size, ties in the order given.
    Sources and clusters are small integers (bit positions); a negative one
    conflicts with nothing."""
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    bins = [0] * len(sizes)
    free: list[tuple[int, int]] = []            # (residual, bin), ordered
    # per bin: source bitmaps by how many pieces of the source it has, and the cluster bitmap
    by_source: list[list[int]] = []
    by_cluster: list[int] = []
    for k in order:
        size, source, cluster = sizes[k], sources[k], clusters[k]
        s_bit = 1 << source if source >= 0 else 0
        c_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(free, (size, -1))
        while at < len(free):                   # successors, from the tightest on
            b = free[at][1]
            if not by_cluster[b] & c_bit and not by_source[b][-1] & s_bit:
                break
            at += 1
        if at < len(free):
            residual, b = free.pop(at)
        else:
            residual, b = capacity, len(by_cluster)
            by_source.append([0] * per_source)
            by_cluster.append(0)
        bins[k] = b
        by_cluster[b] |= c_bit
        levels = by_source[b]
        level = 0
        while level < per_source - 1 and levels[level] & s_bit:
            level += 1
        levels[level] |= s_bit
        if residual > size:
            insort(free, (residual - size, b))
    return bins


def _numbered(values: pd.Series) -> list[int]:
    """0, 1, ... in order of appearance of values that occur twice or more (only
    those can conflict), -1 for others and nulls."""
    counts = values.value_counts()
    codes = {v: i for i, v in enumerate(counts.index[counts > 1])}
    return [codes.get(v, -1) if v is not None and v == v else -1 for v in values]


def pack(docs: DataFrame, length: str, cluster: str | None = None, id_col: str = "doc_id", source_col: str = "source",
         s: Settings = Settings()) -> DataFrame:
    """One row per piece: id, ``piece``, ``piece_start`` and ``n_units`` (of the
    document's ``length`` units), ``shard``, ``bin`` and ``bin_start`` (where the
    piece begins in its sequence).

    Documents of null, zero or negative length have nothing to pack and give no
    row; null sources and clusters conflict with nothing; repeated rows are packed as documents of their own; other columns
    are ignored; an empty table gives no rows."""
    cap = s.capacity
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                       (F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")).alias("cluster"),
                       F.col(length).cast("long").alias("len")).where("len > 0")
    rows = cut(rows)
    n = rows.count()
    shards = max(1, -(-n // s.shard_pieces))
    pieces = (rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(len - 1) DIV {cap}"))))
              .withColumn("start", F.col("piece") * cap)
              .withColumn("size", F.least(F.lit(cap), F.col("len") - F.col("start")))
              .withColumn("shard", F.pmod(F.xxhash64("id", "piece", "len"), F.lit(shards)).cast("int")))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        bins = best_fit(pdf["size"].tolist(), _numbered(pdf["source"]), _numbered(pdf["cluster"]), cap, s.per_source)
        pdf["bin"] = bins
        pdf["bin_start"] = pdf.groupby("bin")["size"].cumsum() - pdf["size"]
        return pdf[["id", "piece", "start", "size", "shard", "bin", "bin_start"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole shards from a stream sorted by shard."""
        held: pd.DataFrame | None = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf])
            last = held["shard"].iloc[-1]
            for _, part in held[held["shard"] != last].groupby("shard"):
                yield shard(part)
            held = held[held["shard"] == last]
        if held is not None and len(held):
            yield shard(held)

    schema = "id long, piece long, start long, size long, shard int, bin int, bin_start long"
    dealt = pieces.select("id", "source", "cluster", "piece", "start", "size", "shard").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInPandas(run, schema).select(
        F.col("id").alias(id_col), "piece", F.col("start").alias("piece_start"), F.col("size").alias("n_units"),
        "shard", "bin", "bin_start")
