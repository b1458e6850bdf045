"""Expanding-window folds as a key, not a loop.

Each row is tagged with every fold it belongs to (train or test) by
filtering a small array literal of fold bounds and exploding the matches:
a narrow projection, no join and no shuffle. Downstream operators carry
``fold_id`` in every partition and grouping key, so all folds run in one
plan and a fold never sees another fold's rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, FOLD_SPEC

FoldSpec = Sequence[tuple[int, dt.date, dt.date, dt.date, str]]


def validate_spec(spec: FoldSpec) -> None:
    if not spec:
        raise ValueError("fold spec is empty")
    for fid, train_end, test_start, test_end, _ in spec:
        if test_start <= train_end:
            raise ValueError(f"spec: fold {fid} tests from {test_start}, but trains until {train_end}")
        if test_end < test_start:
            raise ValueError(f"spec: fold {fid} ends {test_end}, before its test start {test_start}")


def spec_frame(spark, spec: FoldSpec = FOLD_SPEC, train_start: dt.date | None = None) -> DataFrame:
    """The fold spec as a small DataFrame (one row per fold)."""
    validate_spec(spec)
    rows = [(int(f), train_start, a, b, c, lbl) for f, a, b, c, lbl in spec]
    return spark.createDataFrame(
        rows, "fold_id int, train_start date, train_end date, test_start date, test_end date, label string")


def assign_folds(df: DataFrame, spec: FoldSpec = FOLD_SPEC, train_start: dt.date | None = None,
                 date_col: str = DATE_COL) -> DataFrame:
    """Add ``fold_id`` and ``split`` ('train' / 'test'); rows in no fold drop.

    ``train_start`` defaults to the first date of ``df`` (lazy scalar).
    The output has one row per (input row, fold it falls in).
    """
    validate_spec(spec)
    start = F.lit(train_start) if train_start else df.agg(F.min(date_col)).scalar()
    bounds = F.array(*[F.struct(F.lit(int(f)).alias("fold_id"), F.lit(a).alias("train_end"),
                                F.lit(b).alias("test_start"), F.lit(c).alias("test_end"))
                       for f, a, b, c, _ in spec])
    d = F.col(date_col)
    tagged = df.withColumn("__start", start)
    hits = F.filter(bounds, lambda f: ((d >= F.col("__start")) & (d <= f["train_end"]))
                    | ((d >= f["test_start"]) & (d <= f["test_end"])))
    return (tagged.withColumn("__f", F.explode(hits))
            .withColumns({"fold_id": F.col("__f.fold_id"),
                          "split": F.when(d <= F.col("__f.train_end"), "train").otherwise("test")})
            .drop("__f", "__start"))


def fold_sizes(assigned: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """Rows, distinct days and date range per (fold_id, split)."""
    return assigned.groupBy("fold_id", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(date_col).alias("n_days"),
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def check_nonempty(assigned: DataFrame, spec: FoldSpec = FOLD_SPEC) -> None:
    """Raise if a fold has an empty train or test split (one tiny aggregate)."""
    present = {(r["fold_id"], r["split"]) for r in
               assigned.groupBy("fold_id", "split").count().collect()}
    for f, *_ in spec:
        for split in ("train", "test"):
            if (int(f), split) not in present:
                raise ValueError(f"panel: no {split} rows for fold {f}")


def modelling_table(assigned, keys=("fold_id",), thresholds=None, reference_date=None,
                    filter_operational: bool = True):
    """Fold-keyed modelling rows: the default features on train U test of
    each fold (windows keyed by fold), volume statistics from train rows
    only, optional operational filter, rows with a NULL feature dropped."""
    from demandgrid import constants as K
    from demandgrid.operators import features as X
    stats = X.volume_stats(assigned.where(F.col("split") == "train"), keys)
    pipe = X.default_pipeline(stats, keys, thresholds or K.DEFAULT_TIER_THRESHOLDS,
                              reference_date or K.TREND_REFERENCE_DATE)
    out = pipe.transform(assigned)
    if filter_operational:
        out = out.where(F.col("is_operational") == 1)
    feats = [c for c in pipe.feature_names if c not in ("is_operational", "day_type")]
    return out.na.drop(subset=feats)
