"""Backtests and forecast evaluation.

The backtest runs every model on every fold in one plan: fold ids are keys
of the fit, the forecast and the truth join. Metrics are grouped
aggregates, so the per-(model, fold) table is one shuffle of a table that
is already small.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, FOLD_SPEC, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.functions import metrics as M
from demandgrid.operators import folds as FO
from demandgrid.operators import forecast as FC
from demandgrid.operators import prefix as PX
from demandgrid.operators.checks import require_columns
from demandgrid.session import store


def backtest_wide(panel: DataFrame, spec=FOLD_SPEC, season: int = 7,
                  models: Sequence[str] = FC.BASELINES, date_col: str = DATE_COL,
                  entity_col: str = ENTITY_COL, target_col: str = TARGET_COL) -> DataFrame:
    """One row per (fold_id, test date, entity): the truth and every
    model's prediction and interval (``y_pred_<model>`` ...).

    Every fold trains on a prefix of the panel, so one ordered pass per entity
    holds the states of all folds (``operators.prefix``): the panel is
    hash-partitioned by entity once, no row is copied per fold, and test rows
    are scored in that pass. A fold without train or test days is an error.
    """
    FO.validate_spec(spec)
    prefixes = [(int(f), F.lit(end), F.lit(first), F.lit(last)) for f, end, first, last, _ in spec]
    return PX.score_prefixes(panel, prefixes, "fold_id", season, models, date_col=date_col,
                             entity_col=entity_col, target_col=target_col)


def wide_to_long(wide: DataFrame, models: Sequence[str] = FC.BASELINES,
                 keys: Sequence[str] = ("fold_id",), date_col: str = DATE_COL,
                 entity_col: str = ENTITY_COL, target_col: str = TARGET_COL) -> DataFrame:
    """Unpivot per-model columns to ``(model, ..., y_pred, y_lower, y_upper)``
    (a narrow generate, no shuffle)."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"y_pred_{m}").alias("y_pred"),
                             F.col(f"y_lower_{m}").alias("y_lower"),
                             F.col(f"y_upper_{m}").alias("y_upper")) for m in models])
    return wide.select(*keys, date_col, entity_col, target_col, F.explode(arr).alias("__m")).select(
        "__m.model", *keys, date_col, entity_col, target_col, "__m.y_pred", "__m.y_lower", "__m.y_upper")


def backtest(panel: DataFrame, models: Sequence[str] = FC.BASELINES,
             spec=FOLD_SPEC, season: int = 7, date_col: str = DATE_COL,
             entity_col: str = ENTITY_COL, target_col: str = TARGET_COL) -> DataFrame:
    """Long prediction table ``(model, fold_id, date, entity, y, y_pred,
    y_lower, y_upper)`` for every model and fold (see ``backtest_wide``)."""
    wide = backtest_wide(panel, spec, season, models, date_col, entity_col, target_col)
    return wide_to_long(wide, models, ("fold_id",), date_col, entity_col, target_col)


def metrics_by(preds: DataFrame, group_cols: Sequence[str], y: str = TARGET_COL,
               yhat: str = "y_pred") -> DataFrame:
    """WAPE, MAE, RMSE, bias and row count per group."""
    require_columns(preds, [*group_cols, y, yhat])
    return preds.groupBy(*group_cols).agg(*M.metric_columns(y, yhat))


def wape_by_segment(preds: DataFrame, segment_col: str, y: str = TARGET_COL,
                    yhat: str = "y_pred", extra_keys: Sequence[str] = ()) -> DataFrame:
    """WAPE per segment; segments whose truth sums to 0 are left out."""
    for c in (segment_col, y, yhat):
        if c not in preds.columns:
            raise KeyError(f"preds: no column {c!r}")
    return (preds.groupBy(*extra_keys, segment_col)
            .agg(M.abs_error_sum(y, yhat).alias("__err"), F.sum(F.abs(F.col(y))).alias("__tot"))
            .where(F.col("__tot") > 0)
            .select(*extra_keys, segment_col, (F.col("__err") / F.col("__tot")).alias("wape")))


def in_event_windows(df: DataFrame, event_dates: Sequence[dt.date], days_around: int = 3,
                     date_col: str = DATE_COL) -> DataFrame:
    """Rows within ``days_around`` days of any event date (each row once)."""
    evs = F.array(*[F.lit(e) for e in event_dates])
    return df.where(F.exists(evs, lambda e: F.abs(F.datediff(F.col(date_col), e)) <= days_around))


def wape_in_event_window(df: DataFrame, event_dates: Sequence[dt.date], days_around: int = 3,
                         group_cols: Sequence[str] = (), y: str = TARGET_COL,
                         yhat: str = "y_pred", date_col: str = DATE_COL) -> DataFrame:
    """WAPE per group near the events; no row in any window is an error."""
    A.some("event_dates", event_dates)
    require_columns(df, [date_col, *group_cols, y, yhat])
    if in_event_windows(df.select(date_col), event_dates, days_around, date_col).isEmpty():
        raise ValueError(f"event_dates: no row within {days_around} days of {[str(e) for e in event_dates]}")
    return in_event_windows(df, event_dates, days_around, date_col).groupBy(*group_cols).agg(
        M.wape(y, yhat).alias("wape"), F.count(F.lit(1)).alias("n_rows"))


def event_table(preds: DataFrame, events: dict[str, dt.date], days_around: int = 7, keys: Sequence[str] = ("model",),
                y: str = TARGET_COL, yhat: str = "y_pred", date_col: str = DATE_COL) -> DataFrame:
    """WAPE overall and around each event, a column each, per ``keys`` group: one
    pass of conditional sums. An event without rows (or truth) is NULL."""
    A.some("events", events)
    A.at_least("days_around", days_around, 0)
    err, size = F.abs(F.col(y) - F.col(yhat)), F.abs(F.col(y))

    def share(rows=None):
        pick = (lambda c: c) if rows is None else (lambda c: F.when(rows, c))
        return F.try_divide(F.sum(pick(err)), F.nullif(F.sum(pick(size)), F.lit(0.0)))

    near = {n: F.abs(F.datediff(F.col(date_col), F.lit(d))) <= days_around for n, d in events.items()}
    return preds.groupBy(*keys).agg(share().alias("overall"), *[share(rows).alias(n) for n, rows in near.items()])


def tag_named_windows(df: DataFrame, windows: Sequence[tuple[str, dt.date, dt.date]],
                      date_col: str = DATE_COL, out_col: str = "event") -> DataFrame:
    """One row per (row, named window containing it); rows in none drop."""
    arr = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                    for n, a, b in windows])
    d = F.col(date_col)
    hits = F.filter(arr, lambda w: (d >= w["a"]) & (d <= w["b"]))
    return df.withColumn(out_col, F.explode(F.transform(hits, lambda w: w["n"])))


def entity_performance(preds: DataFrame, group_cols: Sequence[str] = (), y: str = TARGET_COL,
                       yhat: str = "y_pred", entity_col: str = ENTITY_COL) -> DataFrame:
    """Per entity: WAPE, total and daily mean of the truth."""
    return preds.groupBy(*group_cols, entity_col).agg(
        M.wape(y, yhat).alias("wape"), F.sum(y).alias("total"), F.avg(y).alias("daily_mean"))


def best_worst(perf: DataFrame, k: int = 5, metric: str = "wape",
               entity_col: str = ENTITY_COL) -> DataFrame:
    """The ``k`` best and ``k`` worst entities by ``metric`` (ties by entity).

    A top-k report: the limit is the feature (each side is a take-ordered of
    ``k`` rows over the per-entity table).
    """
    valid = perf.where(F.col(metric).isNotNull())
    best = valid.orderBy(F.col(metric).asc(), F.col(entity_col).asc()).limit(k) \
        .withColumn("rank_group", F.lit("best"))
    worst = valid.orderBy(F.col(metric).desc(), F.col(entity_col).asc()).limit(k) \
        .withColumn("rank_group", F.lit("worst"))
    return best.unionByName(worst)


def fold_winner(metrics: DataFrame, model: str, baseline: str, metric: str = "wape",
                model_col: str = "model") -> DataFrame:
    """Per fold: both models' metric, the model's gap to the baseline in
    percent (2 places) and the winner (lower metric; ties to the baseline)."""
    m, b = f"{model}_{metric}", f"{baseline}_{metric}"
    wide = metrics.groupBy("fold_id").agg(
        F.max(F.when(F.col(model_col) == model, F.col(metric))).alias(m),
        F.max(F.when(F.col(model_col) == baseline, F.col(metric))).alias(b))
    return wide.withColumns({
        "delta_pct": F.round(F.lit(100.0) * (F.col(m) - F.col(b)) / F.col(b), 2),
        "winner": F.when(F.col(m) < F.col(b), F.lit(model)).otherwise(F.lit(baseline)),
    })


def average_ranks(values: DataFrame, slices: int = 256) -> DataFrame:
    """Ranks with ties sharing their average position (1-based) within each
    ``name`` of ``values(name, value)``: ``(name, value, rank)``, one row per
    distinct value.

    Values are counted, approximate quantiles cut each name's distinct values
    into slices, and running counts over the slices (a row each) and within each
    slice give every value's place; all names in one pass, and no task ranks more
    than about 1 / slices of a name's distinct values."""
    counts = store(values.where(F.col("value").isNotNull()).groupBy("name", "value").agg(F.count(F.lit(1)).alias("c")))
    cuts = counts.groupBy("name").agg(F.percentile_approx(
        "value", F.array(*[F.lit(i / slices) for i in range(1, slices)]), 20 * slices).alias("cuts"))
    dealt = counts.join(cuts, "name").select("name", "value", "c", F.size(F.filter("cuts", lambda q: q < F.col("value"))).alias("slice"))
    sizes = dealt.groupBy("name", "slice").agg(F.sum("c").alias("s"))
    earlier = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("name", "slice", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("name", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum("c").over(inside)
    return dealt.join(sizes, ["name", "slice"]).select("name", "value", (upto - (F.col("c") - 1) / 2.0).alias("rank"))


def correlation_p_value(r: Column, n: Column, steps: int = 2000) -> Column:
    """Two-sided p-value of a correlation ``r`` of ``n`` pairs under no
    association (t distribution with n - 2 degrees of freedom; NULL below 3 pairs).

    With r = sin(a) the null density is proportional to cos(a)^(n-3), so p is the
    ratio of two integrals of a falling function. Both are taken by Simpson's rule
    relative to their first ordinate, over the range where it is not vanishing."""
    power = (n - 3).cast("double")
    half = F.lit(math.pi / 2)
    reach = F.lit(12.0) / F.sqrt(F.greatest(power, F.lit(1.0)))

    def integral(lo):
        width = F.least(half - lo, reach) / steps
        top = F.ln(F.cos(lo))
        ordinate = lambda i: F.exp(power * (F.ln(F.greatest(F.cos(lo + i * width), F.lit(1e-300))) - top))
        weight = lambda i: F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        total = F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda acc, i: acc + weight(i) * ordinate(i))
        return total * width / 3.0

    a = F.asin(F.least(F.abs(r), F.lit(1.0)))
    share = F.exp(power * F.ln(F.cos(a))) * integral(a) / integral(F.lit(0.0))
    return F.when(n < 3, F.lit(None).cast("double")).when(F.abs(r) >= 1 - 1e-15, 0.0).otherwise(share)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman rank correlation (Pearson correlation of average ranks over rows
    with both values), the number of rows and the two-sided p-value.

    The rows are stored once, both columns are ranked in one pass over them and
    the ranks are stored, so nothing upstream runs twice."""
    both = store(df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
                 .select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    long = both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("x", "y")])).alias("v"))
    ranks = store(average_ranks(long.select("v.name", "v.value")))
    side = lambda c: ranks.where(F.col("name") == c).select(F.col("value").alias(c), F.col("rank").alias(f"r{c}"))
    out = both.join(side("x"), "x").join(side("y"), "y").agg(F.corr("rx", "ry").alias("spearman"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("p_value", correlation_p_value(F.col("spearman"), F.col("n")))
