"""Asymmetric costs, expected gain and the cost-aware multiplier search.

Scale design: the cost of a multiplier ``a`` at cost ratio ``r`` is
``r * U(a) + c_over * O(a)`` with ``U(a) = sum max(0, y - yhat_a)`` and
``O(a) = sum max(0, yhat_a - y)``. So one aggregation pass computes the
``2 x len(grid)`` sums per group (as two arrays) and every cost ratio is
evaluated afterwards on the tiny aggregate. No row is replicated per
ratio or per multiplier, and the grouped sums pre-aggregate map-side, so
a hot group costs no more than any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import ALPHA_GRID, COST_RATIOS, DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.functions import metrics as M
from demandgrid.operators import evaluation as E


def adjusted(yhat, alpha: float) -> Column:
    """max(yhat * (1 + alpha), 0)."""
    c = yhat if isinstance(yhat, Column) else F.col(yhat)
    return F.greatest(c * F.lit(1.0 + float(alpha)), F.lit(0.0))


def cost_components(df: DataFrame, group_cols: Sequence[str], y: str = TARGET_COL,
                    model: str = "y_pred_model", baseline: str | None = "y_pred_base",
                    alphas: Sequence[float] = ALPHA_GRID, date_col: str = DATE_COL) -> DataFrame:
    """Per group: under/over unit sums for the raw model, the baseline and
    each grid multiplier (arrays ``under_a`` / ``over_a`` in grid order)."""
    A.some("alphas", alphas)
    aggs = [
        F.sum(M.under_units(y, model)).alias("under_model"),
        F.sum(M.over_units(y, model)).alias("over_model"),
        F.array(*[F.sum(M.under_units(y, adjusted(model, a))) for a in alphas]).alias("under_a"),
        F.array(*[F.sum(M.over_units(y, adjusted(model, a))) for a in alphas]).alias("over_a"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(date_col).alias("n_days"),
    ]
    if baseline:
        aggs += [F.sum(M.under_units(y, baseline)).alias("under_base"),
                 F.sum(M.over_units(y, baseline)).alias("over_base")]
    return df.groupBy(*group_cols).agg(*aggs)


def gain_table(components: DataFrame, group_cols: Sequence[str],
               ratios: Sequence[float] = COST_RATIOS, c_over: float = 1.0,
               alphas: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """Per (group, cost ratio): raw and tuned gain vs the baseline, best
    multiplier and the three costs. The first grid point with the lowest
    cost wins (costs compared at 6 decimals so engines agree on ties)."""
    A.all_at_least("costs", [*ratios, c_over], 0)
    grid = F.array(*[F.lit(float(a)) for a in alphas])
    r = F.col("cost_ratio")
    co = F.lit(float(c_over))
    costs = F.zip_with("under_a", "over_a", lambda u, o: r * u + co * o)
    best = F.array_min(F.transform(costs, lambda c, i: F.struct(
        F.round(c, 6).alias("k"), i.alias("i"), c.alias("c"))))
    out = (components.withColumn("cost_ratio", F.explode(F.array(*[F.lit(float(x)) for x in ratios])))
           .withColumns({
               "c_under": r, "c_over": co,
               "cost_model_no_tuning": r * F.col("under_model") + co * F.col("over_model"),
               "cost_baseline": r * F.col("under_base") + co * F.col("over_base"),
               "__best": best,
           })
           .withColumns({
               "best_alpha": F.element_at(grid, F.col("__best.i") + 1),
               "cost_model_tuned": F.col("__best.c"),
           })
           .withColumns({
               "gain_no_tuning": F.col("cost_baseline") - F.col("cost_model_no_tuning"),
               "gain_tuned": F.col("cost_baseline") - F.col("cost_model_tuned"),
           })
           .withColumn("tuning_uplift", F.col("gain_tuned") - F.col("gain_no_tuning")))
    return out.select(*group_cols, "cost_ratio", "c_under", "c_over", "gain_no_tuning", "gain_tuned",
                      "best_alpha", "cost_model_no_tuning", "cost_model_tuned", "cost_baseline",
                      "tuning_uplift", "n_rows", "n_days")


def best_multiplier(df: DataFrame, group_cols: Sequence[str], c_under: float, c_over: float,
                    y: str = TARGET_COL, yhat: str = "y_pred",
                    alphas: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """Per group: the grid multiplier with the lowest asymmetric cost."""
    A.all_at_least("costs", (c_under, c_over), 0)
    comp = cost_components(df, group_cols, y, yhat, None, alphas)
    grid = F.array(*[F.lit(float(a)) for a in alphas])
    costs = F.zip_with("under_a", "over_a",
                       lambda u, o: F.lit(float(c_under)) * u + F.lit(float(c_over)) * o)
    best = F.array_min(F.transform(costs, lambda c, i: F.struct(
        F.round(c, 6).alias("k"), i.alias("i"), c.alias("c"))))
    return comp.select(*group_cols, F.element_at(grid, best["i"] + 1).alias("best_alpha"),
                       best["c"].alias("best_cost"))


def paired_from_wide(wide: DataFrame, model: str, baseline: str) -> DataFrame:
    """Wide backtest -> ``y_pred_model`` / ``y_pred_base`` columns (narrow)."""
    return wide.withColumns({"y_pred_model": F.col(f"y_pred_{model}"),
                             "y_pred_base": F.col(f"y_pred_{baseline}")})


def gain_by_fold(paired: DataFrame, ratios: Sequence[float] = COST_RATIOS,
                 alphas: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """Gain per (fold, cost ratio) on operational rows."""
    op = paired.where(F.col("is_operational") == 1)
    return gain_table(cost_components(op, ["fold_id"], alphas=alphas), ["fold_id"], ratios, 1.0, alphas)


def gain_in_events(paired: DataFrame, windows: Sequence[tuple[str, dt.date, dt.date]],
                   ratios: Sequence[float] = COST_RATIOS,
                   alphas: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """Gain per (named event window, cost ratio) on operational rows; a
    window with no rows is absent."""
    op = E.tag_named_windows(paired.where(F.col("is_operational") == 1), windows)
    return gain_table(cost_components(op, ["event"], alphas=alphas), ["event"], ratios, 1.0, alphas)


def totals_by_ratio(gains: DataFrame) -> DataFrame:
    """Totals over folds per cost ratio and how many folds each strategy won."""
    return gains.groupBy("cost_ratio").agg(
        F.sum("gain_no_tuning").alias("total_gain_no_tuning"),
        F.sum("gain_tuned").alias("total_gain_tuned"),
        F.count_if(F.col("gain_no_tuning") > 0).alias("folds_won_no_tuning"),
        F.count_if(F.col("gain_tuned") > 0).alias("folds_won_tuned"),
        F.count(F.lit(1)).alias("n_folds"))


def event_gain_ratio(gains_events: DataFrame, event_a: str, event_b: str,
                     value: str = "gain_tuned") -> DataFrame:
    """Per cost ratio: gain in window ``a`` over gain in window ``b``."""
    return gains_events.groupBy("cost_ratio").agg(
        F.try_divide(F.max(F.when(F.col("event") == event_a, F.col(value))),
                     F.nullif(F.max(F.when(F.col("event") == event_b, F.col(value))), F.lit(0.0)))
        .alias("gain_ratio"))
