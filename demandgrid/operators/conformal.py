"""Split-conformal intervals around a seasonal-naive (or naive) base, or
around the boosted-tree forecaster (``tree_calibration_residuals``).

Fit: hold out the last ``calibration_days`` days of each key group, fit the
base on the rest, forecast the held-out days, take signed residuals
``y - y_pred`` on operational days and their ``alpha/2`` and ``1 - alpha/2``
quantiles (linear interpolation). Predict: ``y_lower = max(0, y_pred + lo)``,
``y_upper = y_pred + hi``. Key columns (fold, calibration length) make many
calibrations one plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.functions.quantiles import exact_quantiles
from demandgrid.operators import features as X
from demandgrid.operators import forecast as FC
from demandgrid.operators import prefix as PX


def _last_date(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    if keys:
        return df.join(df.groupBy(*keys).agg(F.max(date_col).alias("__last")), list(keys))
    return df.withColumn("__last", df.agg(F.max(date_col)).scalar())


def base_fit_predict(fit: DataFrame, horizon, base: str, season: int, keys: Sequence[str],
                     date_col: str, entity_col: str, target_col: str) -> DataFrame:
    kw = dict(keys=keys, date_col=date_col, entity_col=entity_col)
    if base == "seasonal_naive":
        st = FC.seasonal_naive_fit(fit, season, target_col=target_col, **kw)
        if keys and not isinstance(horizon, int):
            st = st.join(horizon, list(keys))
            horizon = F.col("horizon")
        return FC.seasonal_naive_predict(st, horizon, season, **kw)
    if base == "naive":
        st = FC.naive_fit(fit, target_col=target_col, **kw)
        if keys and not isinstance(horizon, int):
            st = st.join(horizon, list(keys))
            horizon = F.col("horizon")
        return FC.naive_predict(st, horizon, **kw)
    return A.among("base", [base], FC.BASELINES)


def calibration_residuals(history: DataFrame, calibration_days: int | None = 60,
                          base: str = "seasonal_naive", season: int = 7,
                          keys: Sequence[str] = (), calib_col: str | None = None,
                          date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                          target_col: str = TARGET_COL) -> DataFrame:
    """Signed residuals on operational calibration days, per key group.

    The calibration length is ``calibration_days`` or, when ``calib_col``
    names a key column, that column's value per group. Plan: one shuffle on
    (keys, entity); the fit rows' window + state aggregate and the
    calibration rows' scoring both run on that partitioning; per-group last
    fit date and horizon come from one tiny broadcast aggregate.
    """
    if calib_col is None:
        A.at_least("calibration_days", calibration_days, 1)
    A.among("base", [base], FC.BASELINES)
    days = F.col(calib_col) if calib_col else F.lit(int(calibration_days))
    h = _last_date(history, keys, date_col).withColumn(
        "__fit", F.col(date_col) < F.date_sub(F.col("__last"), days - 1)).drop("__last")
    gk = list(keys) if keys else []
    if not keys:
        h = h.withColumn("__g", F.lit(0))
        gk = ["__g"]
    h = h.repartition(*gk, entity_col)
    fit, calib = h.where(F.col("__fit")), h.where(~F.col("__fit"))
    info = h.groupBy(*gk).agg(
        F.max(F.when(F.col("__fit"), F.col(date_col))).alias("last_date"),
        F.count_distinct(F.when(~F.col("__fit"), F.col(date_col))).cast("int").alias("horizon"))
    state = FC.fit_baselines(fit, season, gk, date_col, entity_col, target_col)
    rows = calib.select(*gk, date_col, entity_col, target_col)
    scored = FC.score_rows(rows, state, info, season, gk, [base], date_col=date_col,
                           entity_col=entity_col)
    scored = X.add_holiday_features(scored, date_col).where(F.col("is_operational") == 1)
    return scored.select(*keys, date_col, entity_col,
                         (F.col(target_col) - F.col(f"y_pred_{base}")).alias("residual"))


def residuals_by_length(history: DataFrame, lengths: Sequence[int], base: str = "seasonal_naive", season: int = 7,
                        key_col: str = "calib_days", date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                        target_col: str = TARGET_COL) -> DataFrame:
    """:func:`calibration_residuals` for several calibration lengths at once, as
    ``(key_col, date, entity, residual)``. The fit part of every length is a
    prefix of the history (``operators.prefix``), so the history is shuffled
    once and not copied per length."""
    A.some("lengths", lengths)
    A.all_at_least("lengths", lengths, 1)
    A.among("base", [base], FC.BASELINES)

    def prefixes(end):
        return [(int(n), F.date_sub(end, int(n)), F.date_sub(end, int(n) - 1), end) for n in lengths]

    scored = PX.score_prefixes(history, prefixes, key_col, season, [base], date_col=date_col,
                               entity_col=entity_col, target_col=target_col)
    scored = X.add_holiday_features(scored, date_col).where(F.col("is_operational") == 1)
    return scored.select(key_col, date_col, entity_col, (F.col(target_col) - F.col(f"y_pred_{base}")).alias("residual"))


def tree_calibration_residuals(history: DataFrame, calibration_days: int = 60, params=None,
                               thresholds=None, reference_date=None, date_col: str = DATE_COL,
                               entity_col: str = ENTITY_COL, target_col: str = TARGET_COL) -> DataFrame:
    """Signed residuals of the boosted-tree forecaster on the operational
    days of the last ``calibration_days`` days: the trees are fitted on the
    rows before that window and forecast it recursively from the end of the
    fit rows (Spark ML fit + bucketed recursive walk; no row reaches the
    driver)."""
    from demandgrid import constants as K
    from demandgrid.operators import trees as T
    A.at_least("calibration_days", calibration_days, 1)
    last = history.agg(F.max(date_col)).first()[0]
    calib_start = last - dt.timedelta(days=calibration_days - 1)
    d = F.col(date_col)
    fit, calib = history.where(d < F.lit(calib_start)), history.where(d >= F.lit(calib_start))
    if fit.isEmpty():
        raise ValueError(f"calibration_days: {calibration_days} days leave nothing to fit the base on")
    horizon = calib.select(date_col).distinct().count()
    fc = T.fit(fit, params or T.GBTParams(), thresholds or K.DEFAULT_TIER_THRESHOLDS,
               reference_date or K.TREND_REFERENCE_DATE)
    pred = T.recursive_forecast(fc, fit, horizon,
                                date_col=date_col, entity_col=entity_col, target_col=target_col)
    scored = X.add_holiday_features(calib.join(pred, [date_col, entity_col]), date_col)
    scored = scored.where(F.col("is_operational") == 1)
    return scored.select(date_col, entity_col, (F.col(target_col) - F.col("y_pred")).alias("residual"))


def _attach(df: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its group's offsets: a join on the keys (the planner picks
    its kind by the measured size), or without keys the single row's values as
    scalar subqueries."""
    names = ("lower_offset", "upper_offset")
    if keys:
        return df.join(offsets.select(*keys, *names), list(keys))
    return df.withColumns({n: offsets.select(n).scalar() for n in names})


def conformal_offsets(residuals: DataFrame, alpha: float = 0.1, keys: Sequence[str] = (),
                      approx_accuracy: int | None = None) -> DataFrame:
    """Per key group: lower/upper offsets, calibration coverage, residual count.

    Exact quantiles with linear interpolation (``functions.quantiles``: counts
    per distinct value, no task holds a whole group); ``approx_accuracy``
    switches to plain ``percentile_approx``. No residuals at all (an empty
    calibration) is an error.
    """
    A.between("alpha", alpha, 0, 1)
    # Residuals are read three times (counts, splits, coverage): store
    # them once (small: calibration rows per key group) and cut the lineage.
    from demandgrid.operators.panel import materialize
    res, ks = materialize(residuals), list(keys)
    if res.isEmpty():
        raise ValueError("residuals: the calibration window has no operational day with a forecast")
    if approx_accuracy:
        ps = F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))
        off = res.groupBy(*ks).agg(F.percentile_approx("residual", ps, approx_accuracy).alias("__q"),
                                   F.count(F.lit(1)).alias("n_residuals"))
        off = off.select(*ks, F.col("__q")[0].alias("lower_offset"), F.col("__q")[1].alias("upper_offset"),
                         "n_residuals")
    else:
        off = exact_quantiles(res, "residual", [alpha / 2, 1 - alpha / 2], ks,
                              out_cols=["lower_offset", "upper_offset"], count_col="n_residuals")
    off = materialize(off)          # a row per key group
    cov = _attach(res, off, ks).groupBy(*ks).agg(F.avg(F.col("residual").between(
        F.col("lower_offset"), F.col("upper_offset")).cast("double")).alias("coverage"))
    return off.join(cov, ks) if ks else off.withColumn("coverage", cov.scalar())


def apply_offsets(preds: DataFrame, offsets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Interval from offsets: lower clipped at 0, upper not."""
    j = _attach(preds.drop("y_lower", "y_upper"), offsets, keys)
    return j.withColumns({
        "y_lower": F.greatest(F.lit(0.0), F.col("y_pred") + F.col("lower_offset")),
        "y_upper": F.col("y_pred") + F.col("upper_offset"),
    }).drop("lower_offset", "upper_offset")


def conformal_forecast(history: DataFrame, horizon: int, offsets: DataFrame,
                       base: str = "seasonal_naive", season: int = 7, keys: Sequence[str] = (),
                       date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                       target_col: str = TARGET_COL) -> DataFrame:
    """Base forecast ``horizon`` days past the end of ``history`` with the
    calibrated interval. The base is refitted on the whole history."""
    A.at_least("horizon", horizon, 1)
    preds = base_fit_predict(history, int(horizon), base, season, keys, date_col, entity_col, target_col)
    return apply_offsets(preds, offsets, keys)


def interval_coverage(preds: DataFrame, y: str = TARGET_COL, keys: Sequence[str] = ()) -> DataFrame:
    """Share of truths inside [y_lower, y_upper] and mean width."""
    return preds.groupBy(*keys).agg(
        F.avg(F.col(y).between(F.col("y_lower"), F.col("y_upper")).cast("double")).alias("coverage"),
        F.avg(F.col("y_upper") - F.col("y_lower")).alias("mean_width"),
        F.count(F.lit(1)).alias("n_rows"))
