"""Per-entity window features over a dense panel.

Every function partitions by ``keys + [entity]`` and orders by date, so all
window columns on one spec share one Exchange + Sort + Window. Frames count
rows, not days: densify first, or take the day-based windows of
``operators.sparse``, which give the same values without a dense panel. ``keys`` carries extra partition keys such as
``fold_id`` so that many folds are featurised in one plan without leakage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.functions import args as A

ROLLING_STATS = ("mean", "std", "min", "max")


def spec(keys: Sequence[str] = (), entity_col: str = ENTITY_COL, date_col: str = DATE_COL):
    return Window.partitionBy(*keys, entity_col).orderBy(date_col)


def lag_columns(lags: Sequence[int], target_col: str = TARGET_COL, keys: Sequence[str] = (),
                entity_col: str = ENTITY_COL, date_col: str = DATE_COL) -> dict[str, Column]:
    A.some("lags", lags)
    A.all_at_least("lags", lags, 1)
    w = spec(keys, entity_col, date_col)
    return {f"lag_{n}": F.lag(target_col, int(n)).over(w) for n in lags}


def add_lags(df: DataFrame, lags: Sequence[int] = (1, 7, 14, 28), **kw) -> DataFrame:
    """``lag_n`` = target ``n`` rows earlier in the same entity (NULL before)."""
    return df.withColumns(lag_columns(lags, **kw))


def rolling_columns(windows: Sequence[int] = (7, 14, 28), stats: Sequence[str] = ("mean",),
                    min_periods: int = 1, target_col: str = TARGET_COL,
                    keys: Sequence[str] = (), entity_col: str = ENTITY_COL,
                    date_col: str = DATE_COL) -> dict[str, Column]:
    """Trailing stats over the ``w`` rows before the current one.

    NULL unless the frame holds at least ``min_periods`` rows; ``std`` is the
    sample standard deviation (NULL for one row).
    """
    A.some("windows", windows)
    A.all_at_least("windows", windows, 1)
    A.some("stats", stats)
    A.among("stats", stats, ROLLING_STATS)
    base = spec(keys, entity_col, date_col)
    fns = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    out: dict[str, Column] = {}
    for w in windows:
        frame = base.rowsBetween(-int(w), -1)
        n = F.count(target_col).over(frame)
        for stat in stats:
            out[f"rolling_{stat}_{w}"] = F.when(
                n >= max(int(min_periods), 1), fns[stat](F.col(target_col)).over(frame)
            ).cast("double")
    return out


def add_rolling(df: DataFrame, windows: Sequence[int] = (7, 14, 28),
                stats: Sequence[str] = ("mean",), min_periods: int = 1, **kw) -> DataFrame:
    return df.withColumns(rolling_columns(windows, stats, min_periods, **kw))


def rolling_dev_column(window: int = 7, target_col: str = TARGET_COL, keys: Sequence[str] = (),
                       entity_col: str = ENTITY_COL, date_col: str = DATE_COL) -> Column:
    """The SQL feature table's ``rolling_std_7``, which is not a std.

    With ``h`` the up-to-``window`` previous values (oldest first): the root
    mean square, over k = 2..len(h), of ``h_k - mean(h_1..h_{k-1})``; NULL
    when fewer than 2 previous rows. The frame is bounded by ``window``.
    """
    return deviation(F.collect_list(target_col).over(spec(keys, entity_col, date_col).rowsBetween(-window, -1)))


def deviation(h: Column) -> Column:
    """:func:`rolling_dev_column` of the array ``h`` of previous values."""
    n = F.size(h)
    sq = F.aggregate(
        F.sequence(F.lit(1), n - 1), F.lit(0.0),
        lambda acc, i: acc + F.pow(
            F.element_at(h, i + 1).cast("double")
            - F.aggregate(F.slice(h, 1, i), F.lit(0.0), lambda s, x: s + x) / i, 2))
    return F.when(n >= 2, F.sqrt(sq / (n - 1)))


def sql_feature_table(panel: DataFrame, target_col: str = TARGET_COL, keys: Sequence[str] = (),
                      entity_col: str = ENTITY_COL, date_col: str = DATE_COL) -> DataFrame:
    """Lags 1/7/14/28, trailing means 7/14/28 and ``rolling_dev_7``."""
    kw = dict(target_col=target_col, keys=keys, entity_col=entity_col, date_col=date_col)
    cols = lag_columns((1, 7, 14, 28), **kw)
    cols.update(rolling_columns((7, 14, 28), ("mean",), 1, **kw))
    cols["rolling_dev_7"] = rolling_dev_column(7, **kw)
    return panel.withColumns(cols)


def differences(df: DataFrame, k: int = 1, target_col: str = TARGET_COL, out_col: str | None = None,
                keys: Sequence[str] = (), entity_col: str = ENTITY_COL,
                date_col: str = DATE_COL) -> DataFrame:
    """``x - lag(x, k)``: first (k=1) or seasonal (k=season) difference."""
    w = spec(keys, entity_col, date_col)
    return df.withColumn(out_col or f"diff_{k}",
                         (F.col(target_col) - F.lag(target_col, k).over(w)).cast("double"))


def feature_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: total rows and non-NULL count per feature column."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count(c).alias(f"n_{c}") for c in columns])
