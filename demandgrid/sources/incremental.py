"""Appending batches of facts, and a panel that is rebuilt by the month.

Three Parquet tables under one folder (shared storage on a cluster):

* ``counts``: sparse shipments per (date, entity, batch), partitioned by month
  and batch. A batch owns its partitions, so loading it again replaces what it
  wrote before and adds nothing;
* ``panel``: the dense panel, partitioned by month. After a batch, only months
  that it touches (now or in its earlier version) are computed and written, from
  the counts of those months alone. A day outside the panel's range touches the
  months between, a new entity touches every month (it needs its zeros there).

Both are written by dynamic partition overwrite: a partition is replaced as a
whole when its job commits, all others stay as they are. A load that is lost
half-way is repeated with the same batch id. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.operators.checks import require_columns
from demandgrid.session import store

MONTH, BATCH = "month", "batch"


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read.option("basePath", path)
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _checked(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"batch: {batch!r} is no batch id (letters, digits, '_', '.', '-')")
    return batch


def _replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str) -> int:
    """Add ``df`` to a table as batch ``batch`` (a partition); the same batch again
    replaces its rows, other batches stay. Returns the batch's stored rows. An
    empty batch clears an earlier version (a partition without rows)."""
    if BATCH in df.columns:
        raise ValueError(f"df: column {BATCH!r} is the table's own")
    own = f"{path.rstrip('/')}/{BATCH}={_checked(batch)}"
    df.write.mode("overwrite").parquet(own)
    return df.sparkSession.read.schema(df.schema).parquet(own).count()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a table written by :func:`append_batch`."""
    df = _read(spark, path)
    if df is None:
        raise FileNotFoundError(f"no table at {path}")
    # Batch ids are text, whatever their partitions' names look like.
    columns = [f for f in df.schema.fields if f.name != BATCH]
    return _read(spark, path, StructType([*columns, StructField(BATCH, StringType())]))


@dataclass(frozen=True)
class Loaded:
    """What a load wrote: the panel's months, and whether all were rebuilt."""
    months: tuple[str, ...]
    whole: bool


class PanelStore:
    """The stored counts and panel of one folder."""

    def __init__(self, spark: SparkSession, folder: str, date_col: str = DATE_COL,
                 entity_col: str = ENTITY_COL, target_col: str = TARGET_COL):
        self.spark = spark
        self.counts_path, self.panel_path = (f"{folder.rstrip('/')}/{t}" for t in ("counts", "panel"))
        self.date, self.entity, self.target = date_col, entity_col, target_col

        self.panel_schema = f"`{date_col}` date, `{entity_col}` string, `{target_col}` long, {MONTH} string"

    def _month(self):
        return F.date_format(self.date, "yyyy-MM")

    def counts(self) -> DataFrame | None:
        """Sparse counts of all batches."""
        return _read(self.spark, self.counts_path, f"{self.panel_schema}, {BATCH} string")

    def panel(self) -> DataFrame | None:
        df = _read(self.spark, self.panel_path, self.panel_schema)
        return None if df is None else df.select(self.date, self.entity, self.target)

    def load(self, batch_counts: DataFrame, batch: str) -> Loaded:
        """Take a batch's sparse counts (non-negative) in and bring the panel up to date."""
        require_columns(batch_counts, [self.date, self.entity, self.target])
        batch, keys = _checked(batch), [self.date, self.entity]
        new = (batch_counts.where(F.col(self.date).isNotNull() & F.col(self.entity).isNotNull())
               .groupBy(*keys).agg(F.sum(self.target).cast("long").alias(self.target)))
        stored = self.counts()
        if stored is not None:
            # Days of the earlier version that the batch no longer has stay as zeros,
            # so that every partition it owns is replaced.
            gone = stored.where(F.col(BATCH) == batch).select(*keys)
            new = (new.join(gone.distinct(), keys, "full")
                   .select(*keys, F.coalesce(F.col(self.target), F.lit(0).cast("long")).alias(self.target)))
        own = store(new.withColumn(MONTH, self._month()))
        _replace_partitions(own.withColumn(BATCH, F.lit(batch)).repartition(MONTH), self.counts_path, (MONTH, BATCH))
        return self._refresh(own)

    def _shape(self, df: DataFrame | None):
        """First day, last day and number of entities (the bounds of the grid), rows."""
        if df is None:
            return None, None, 0, 0
        r = df.agg(F.min(self.date), F.max(self.date), F.count_distinct(self.entity), F.count(F.lit(1))).first()
        return r[0], r[1], r[2], r[3]

    def _refresh(self, own: DataFrame) -> Loaded:
        counts = self.counts()
        if counts is None:                       # nothing but an empty batch so far
            return Loaded((), False)
        live = counts.where(F.col(self.target) > 0)
        lo, hi, n, _ = self._shape(live)
        before = self.panel()
        old_lo, old_hi, old_n, rows = self._shape(before)
        entities = store(live.select(self.entity).distinct())
        same = old_n == n and (before is None or before.select(self.entity).distinct()
                               .join(entities, self.entity, "left_anti").isEmpty())
        if lo is None:
            if before is not None:
                self.spark.createDataFrame([], self.panel_schema).write.mode("overwrite").parquet(self.panel_path)
            return Loaded((), True)
        # The grid shrank, an entity came or went, or the stored panel has holes
        # (a write was lost half-way): all months change.
        whole = (old_lo is None or not same or lo > old_lo or hi < old_hi
                 or rows != old_n * ((old_hi - old_lo).days + 1))
        # Months are a calendar's worth of names, whatever the rows.
        months = {r[0] for r in own.select(MONTH).distinct().collect()}
        if not whole:
            months |= _months_between(lo, old_lo) if lo < old_lo else set()
            months |= _months_between(old_hi, hi) if hi > old_hi else set()
            months = {m for m in months if f"{lo:%Y-%m}" <= m <= f"{hi:%Y-%m}"}
        else:
            months = _months_between(lo, hi)
        fresh = self._months(live, entities, lo, hi, sorted(months))
        if whole:
            fresh.write.mode("overwrite").partitionBy(MONTH).parquet(self.panel_path)
        else:
            _replace_partitions(fresh, self.panel_path, (MONTH,))
        return Loaded(tuple(sorted(months)), whole)

    def _months(self, live: DataFrame, entities: DataFrame, lo: dt.date, hi: dt.date, months: list[str]) -> DataFrame:
        """The dense panel of ``months``: the month filter prunes the counts' partitions."""
        part = (live.where(F.col(MONTH).isin(months)).groupBy(self.date, self.entity)
                .agg(F.sum(self.target).cast("long").alias(self.target)))
        days = F.filter(F.sequence(F.lit(lo), F.lit(hi)), lambda d: F.date_format(d, "yyyy-MM").isin(months))
        grid = entities.select(self.entity, F.explode(days).alias(self.date))
        return (grid.join(part, [self.date, self.entity], "left")
                .select(self.date, self.entity, F.coalesce(F.col(self.target), F.lit(0)).cast("long").alias(self.target),
                        self._month().alias(MONTH))
                .repartition(MONTH))


def _months_between(a: dt.date, b: dt.date) -> set[str]:
    first, last = a.year * 12 + a.month - 1, b.year * 12 + b.month - 1
    return {f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)}
