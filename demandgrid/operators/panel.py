"""Dense, zero-filled daily panel.

``rows -> count per (date, entity) -> grid of every date x every entity ->
left join -> NULL as 0``. The grid is generated per entity with
``explode(sequence(lo, hi))`` where ``lo``/``hi`` are lazy scalar
subqueries over the counts, so no cartesian product and no driver round
trip is involved. The counts are pre-aggregated (partial + final hash
aggregate) before anything else touches them, so a hot entity never reaches
one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.session import store


def daily_counts(rows: DataFrame, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                 target_col: str = TARGET_COL) -> DataFrame:
    """Sparse counts: one row per (date, entity) that occurs."""
    return rows.groupBy(date_col, entity_col).agg(F.count(F.lit(1)).alias(target_col))


def densify(counts: DataFrame, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
            target_col: str = TARGET_COL, start=None, end=None) -> DataFrame:
    """Zero-fill ``counts`` to every date in [start, end] for every entity.

    ``start``/``end`` default to the min/max date present (global, not per
    entity). Entities are only those that occur at least once.
    """
    lo = F.lit(start).cast("date") if start is not None else counts.agg(F.min(date_col)).scalar()
    hi = F.lit(end).cast("date") if end is not None else counts.agg(F.max(date_col)).scalar()
    grid = (counts.select(entity_col).distinct()
            .select(entity_col, F.explode(F.sequence(lo, hi)).alias(date_col)))
    return (grid.join(counts, [date_col, entity_col], "left")
            .select(date_col, entity_col,
                    F.coalesce(F.col(target_col), F.lit(0)).cast("long").alias(target_col)))


def materialize(df: DataFrame) -> DataFrame:
    """Store a small aggregate that several branches of a plan read, as
    Parquet in the shared folder (see :func:`demandgrid.session.store`)."""
    return store(df)


def build_panel(rows: DataFrame, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                target_col: str = TARGET_COL) -> DataFrame:
    """Rows with a date and an entity -> dense daily panel."""
    return panel_from_counts(daily_counts(rows, date_col, entity_col, target_col),
                             date_col, entity_col, target_col)


def panel_from_counts(counts: DataFrame, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                      target_col: str = TARGET_COL) -> DataFrame:
    """Sparse counts -> dense panel, stored once, in date order.

    The counts are persisted while the three grid branches (bounds, entity
    spine, join) read them, so the fact scan and join run once; the dense
    panel is then written as Parquet, so every downstream branch (folds,
    models, calendars) is a pruned scan with date filters pushed to it.
    """
    from pyspark import StorageLevel
    cached = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return materialize(densify(cached, date_col, entity_col, target_col).sort(date_col, entity_col))
    finally:
        cached.unpersist()


def panel_summary(panel: DataFrame, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                  target_col: str = TARGET_COL) -> DataFrame:
    """One-row summary: rows, distinct days/entities, date range, total, zeros."""
    return panel.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(date_col).alias("n_days"),
        F.count_distinct(entity_col).alias("n_entities"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.sum(target_col).cast("long").alias("total_shipments"),
        F.count_if(F.col(target_col) == 0).alias("zero_days"),
    )


def with_cutoff(panel: DataFrame, cutoff, date_col: str = DATE_COL) -> DataFrame:
    """Rows up to ``cutoff`` inclusive (pushed to the scan when partitioned by date)."""
    return panel.where(F.col(date_col) <= F.lit(cutoff).cast("date"))


def date_window(panel: DataFrame, start, end, date_col: str = DATE_COL) -> DataFrame:
    """Closed date window [start, end]."""
    return panel.where(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def trailing_days(panel: DataFrame, days: int, date_col: str = DATE_COL) -> DataFrame:
    """Rows within ``days`` before the panel's last date (``date >= max - days``)."""
    hi = panel.agg(F.max(date_col)).scalar()
    return panel.where(F.col(date_col) >= F.date_sub(hi, days))


def entity_filter(df: DataFrame, entities, entity_col: str = ENTITY_COL) -> DataFrame:
    """Keep the listed entities; an empty or missing list keeps all."""
    if not entities:
        return df
    return df.where(F.col(entity_col).isin(list(entities)))


def split_train_holdout(df: DataFrame, train_end, holdout_start, holdout_end,
                        date_col: str = DATE_COL) -> DataFrame:
    """``split`` = train (date <= train_end) / holdout ([start, end]); the
    holdout must start the day after the training end; other rows drop."""
    import datetime as _dt
    as_date = lambda x: x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))
    te, hs, he = as_date(train_end), as_date(holdout_start), as_date(holdout_end)
    if hs != te + _dt.timedelta(days=1):
        raise ValueError(f"holdout_start ({hs}) must be the day after train_end ({te})")
    if he < hs:
        raise ValueError(f"holdout_end ({he}) before holdout_start ({hs})")
    d = F.col(date_col)
    return (df.where(d <= F.lit(he))
            .withColumn("split", F.when(d <= F.lit(te), "train").otherwise("holdout")))
