"""Helpers shared by the operators: whole-text readers, deterministic folds,
lineage cuts in the shared folder, and connected components.

Everything here is a DataFrame plan; nothing gathers documents, links or
components on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.session import work_folder

# ASCII upper case to lower case, on UTF-8 bytes (other bytes stay).
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

MAX_LONG = (1 << 63) - 1

# Spark then removes a query's shuffle files when the query ends, not when the
# driver's memory happens to be collected.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Small tables are dealt to few tasks: so many, and one more for each of so many rows.
TASKS, ROWS_A_TASK = 8, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable storage:
    a lost executor loses nothing). The folder is the session's
    ``spark.checkpoint.dir``; where that is unset, the warehouse's work folder
    (tests, local runs). The shuffle files that led to the stored rows go at once;
    the session's setting for other queries stays."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or work_folder(spark))
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)      # planned anew: ``df`` keeps its own files
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def tasks_for(rows: int) -> int:
    """Tasks for so many narrow rows; to be given to ``coalesce``, which never
    makes more of them than the plan has."""
    return TASKS + rows // ROWS_A_TASK


def crc_fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts
    as the empty text, so it has a fold too)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str,
              fn: Callable[[list, list[bytes | None]], pa.RecordBatch | None],
              block_bytes: int = 4 << 20, extra: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """Apply ``fn(ids, texts, *extra)`` to blocks of about ``block_bytes`` of
    UTF-8 texts (a longer text is a block of its own), Arrow in and out.
    Texts are whole; a null text arrives as ``None``; ``packed`` texts
    (:func:`pack_texts`) are unpacked first."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
                    *[F.col(c).alias(f"x{i}") for i, c in enumerate(extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if packed:
                unpack = zstandard.ZstdDecompressor().decompress
                whole = pa.array([None if t is None else unpack(t) for t in batch.column(1).to_pylist()], pa.binary())
                batch = pa.RecordBatch.from_arrays([batch.column(0), whole, *batch.columns[2:]], batch.schema.names)
            n, sizes = batch.num_rows, pc.fill_null(pc.binary_length(batch.column(1)), 0)
            sizes = sizes.to_numpy(zero_copy_only=False)
            at = 0
            while at < n:
                end, size = at, 0
                while end < n and (end == at or size + sizes[end] <= block_bytes):
                    size += sizes[end]
                    end += 1
                part = batch.slice(at, end - at)
                out = fn(*[c.to_pylist() for c in part.columns])
                if out is not None and out.num_rows:
                    yield out
                at = end

    return src.mapInArrow(run, schema)


def pack_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text compressed by itself, for texts that are shuffled."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = pa.array([None if t is None else press(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "text"])

    return src.mapInArrow(run, "id long, text binary").select(F.col("id").alias(id_col), F.col("text").alias(text_col))


def _all_stars(edges: DataFrame, tasks: int) -> bool:
    """Whether every component of ``u, v`` is a star around its smallest node:
    each u has one edge, and no v is a u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    own = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.max("down").alias("down")).coalesce(tasks)
    return own.agg(F.count_if((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("down") > 0)))).first()[0] == 0


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as links of longs, by
    alternating large-star and small-star steps (each node's minimum is a
    partial aggregate, each step one shuffled join that Spark can split where
    a node is hot). Returns ``node, component`` (the smallest node reachable)
    for every node that has a link to another node. Self-links, null ends and
    repeated links change nothing; no links give no rows.

    Rounds go on until all components are stars (``max_rounds`` only stops a run
    that cannot happen: it raises). The tasks of a round grow with the links, so a
    small graph does not write a file for each of the session's shuffle partitions
    in every step."""
    e = (links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = cut(e)
    for _ in range(max_rounds):
        tasks = tasks_for(e.count())
        e = e.coalesce(tasks)
        if _all_stars(e, tasks):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").coalesce(tasks).distinct().coalesce(tasks))
        # every edge now points from the larger to the smaller end
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").coalesce(tasks)
        small = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")).coalesce(tasks)).distinct())
        e = cut(small.coalesce(tasks))
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
