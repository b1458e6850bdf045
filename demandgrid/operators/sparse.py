"""Day-based windows over a sparse panel, with the values of the dense one.

A day without a row counts as 0 from the panel's first day on, as it would after
``panel.densify``. Frames are RANGE frames over the day number, so a window spans
days whatever rows are missing, and the missing days enter by arithmetic: the
zero-filled grid (entities x days) is never built. Rows are the sparse rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.operators import windows as W
from demandgrid.operators.checks import require_columns

DAY, AGE = "__day", "__age"          # day number, days since the panel's first day


def with_day(counts: DataFrame, start=None, date_col: str = DATE_COL) -> DataFrame:
    """Adds the day number and the number of days before it in the panel, which
    begins at ``start`` (default: the first date present, a lazy scalar)."""
    first = F.lit(start).cast("date") if start is not None else counts.agg(F.min(date_col)).scalar()
    return counts.withColumn(DAY, F.unix_date(date_col)).withColumn(AGE, (F.col(DAY) - F.unix_date(first)).cast("int"))


def _spec(keys, entity_col):
    return Window.partitionBy(*keys, entity_col).orderBy(DAY)


def lag_columns(lags: Sequence[int], target_col: str = TARGET_COL, keys: Sequence[str] = (),
                entity_col: str = ENTITY_COL) -> dict[str, Column]:
    """``lag_n``: the target ``n`` days earlier, 0 if that day has no row, NULL
    before the panel's first day."""
    A.some("lags", lags)
    A.all_at_least("lags", lags, 1)
    w = _spec(keys, entity_col)
    return {f"lag_{n}": F.when(F.col(AGE) >= n, F.coalesce(
        F.max(target_col).over(w.rangeBetween(-int(n), -int(n))), F.lit(0))) for n in lags}


def rolling_columns(windows: Sequence[int] = (7, 14, 28), stats: Sequence[str] = ("mean",), min_periods: int = 1,
                    target_col: str = TARGET_COL, keys: Sequence[str] = (),
                    entity_col: str = ENTITY_COL) -> dict[str, Column]:
    """Trailing stats over the ``w`` days before the row's; NULL unless the panel
    has at least ``min_periods`` of them. ``std`` comes from sums of squares about
    the frame's mean of the days present, plus what the missing zeros add."""
    A.some("windows", windows)
    A.all_at_least("windows", windows, 1)
    A.some("stats", stats)
    A.among("stats", stats, W.ROLLING_STATS)
    x, out = F.col(target_col).cast("double"), {}
    for w in windows:
        frame = _spec(keys, entity_col).rangeBetween(-int(w), -1)
        n = F.least(F.lit(int(w)), F.col(AGE))
        rows = F.count(target_col).over(frame)
        total = F.coalesce(F.sum(x).over(frame), F.lit(0.0))
        # Squares about the mean of all n days: those of the rows about their own
        # mean, and the two means' distance to the common one.
        spread = F.coalesce(F.var_pop(x).over(frame) * rows, F.lit(0.0))
        between = F.when((rows > 0) & (rows < n), total * total * (n - rows) / (rows * n)).otherwise(0.0)
        holes = rows < n
        made = {
            "mean": total / n,
            "std": F.when(n > 1, F.sqrt((spread + between) / (n - 1))),
            "min": F.when(holes, F.least(F.min(x).over(frame), F.lit(0.0))).otherwise(F.min(x).over(frame)),
            "max": F.when(holes, F.greatest(F.max(x).over(frame), F.lit(0.0))).otherwise(F.max(x).over(frame)),
        }
        for stat in stats:
            out[f"rolling_{stat}_{w}"] = F.when(n >= max(int(min_periods), 1), made[stat])
    return out


def rolling_dev_column(window: int = 7, target_col: str = TARGET_COL, keys: Sequence[str] = (),
                       entity_col: str = ENTITY_COL) -> Column:
    """``windows.rolling_dev_column`` by days: the rows of the frame are put at
    their days, the others are 0."""
    A.at_least("window", window, 1)
    frame = _spec(keys, entity_col).rangeBetween(-int(window), -1)
    rows = F.map_from_entries(F.collect_list(F.struct(F.col(DAY), F.col(target_col).cast("double"))).over(frame))
    n = F.least(F.lit(int(window)), F.col(AGE))
    days = F.when(n >= 1, F.sequence(F.col(DAY) - n, F.col(DAY) - 1)).otherwise(F.array().cast("array<int>"))
    return W.deviation(F.transform(days, lambda d: F.coalesce(F.try_element_at(rows, d), F.lit(0.0))))


def sql_feature_table(counts: DataFrame, start=None, target_col: str = TARGET_COL, keys: Sequence[str] = (),
                      entity_col: str = ENTITY_COL, date_col: str = DATE_COL) -> DataFrame:
    """``windows.sql_feature_table`` for the rows of a sparse panel (one row per
    date and entity): equal to the dense table on those rows."""
    require_columns(counts, [date_col, entity_col, target_col])
    kw = dict(target_col=target_col, keys=keys, entity_col=entity_col)
    cols = lag_columns((1, 7, 14, 28), **kw)
    cols.update(rolling_columns((7, 14, 28), ("mean",), 1, **kw))
    cols["rolling_dev_7"] = rolling_dev_column(7, **kw)
    return with_day(counts, start, date_col).withColumns(cols).drop(DAY, AGE)
