"""Registered end-to-end queries: ``(spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them) whole; the
result columns carry the same names as the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.operators import panel as P
from demandgrid.session import scratch_folder
from demandgrid.sources import incremental as INC
from demandgrid.sources import tables as S

BATCH_START = _dt.datetime(1999, 1, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


# What one call of a query has built so far (its panels and fitted models).
# Nothing outlives the call: the next one reads its inputs again.
_BUILT: ContextVar[dict | None] = ContextVar("built", default=None)


def query(name: str):
    def deco(fn):
        @wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            token = _BUILT.set({})
            try:
                return fn(spark, sf_dir)
            finally:
                _BUILT.reset(token)
        QUERIES[name] = call
        return call
    return deco


def once(key: tuple, make: Callable):
    """``make()``, once per call of a query."""
    built = _BUILT.get()
    if built is None:
        return make()
    if key not in built:
        built[key] = make()
    return built[key]


def shared_panel(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return once(("panel", sf_dir, grain), lambda: P.panel_from_counts(S.shipment_counts(spark, sf_dir, grain)))


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_panel(spark, sf_dir, "nation")


def region_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_panel(spark, sf_dir, "region")


@query("panel_nation")
def q_panel_nation(spark, sf_dir):
    """Daily shipments per nation, dense and zero-filled (always rebuilt)."""
    return P.panel_from_counts(S.shipment_counts(spark, sf_dir, "nation"))


@query("panel_region")
def q_panel_region(spark, sf_dir):
    return region_panel(spark, sf_dir)


@query("panel_summary")
def q_panel_summary(spark, sf_dir):
    return P.panel_summary(nation_panel(spark, sf_dir))


@query("panel_by_batches")
def q_panel_by_batches(spark, sf_dir):
    """The nation panel from three loads into a stored panel: orders since
    ``BATCH_START``, the earlier ones as a late batch (their shipments reach into
    months that are there), and the first batch once more (changes nothing)."""
    stored = INC.PanelStore(spark, scratch_folder(spark))
    orders = S.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    lines = S.read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
    early = F.coalesce(F.col("o_orderdate") < F.lit(BATCH_START), F.lit(False))
    for batch, rows in (("recent", ~early), ("late", early), ("recent", ~early)):
        stored.load(S.counts_from_facts(spark, sf_dir, lines, orders.where(rows)), batch)
    return stored.panel()


# ---------------------------------------------------------------------------
# Window and calendar features
# ---------------------------------------------------------------------------
from demandgrid import constants as K  # noqa: E402
from demandgrid.operators import features as X  # noqa: E402
from demandgrid.operators import sparse as SP  # noqa: E402
from demandgrid.operators import windows as W  # noqa: E402

TREND_ANCHOR = _dt.date(1995, 1, 1)
NATION_TIERS = (0.55, 0.70)   # nation means at sf0.01 span 0.43..0.81 per day
FIRST_TRAIN_END = K.FOLD_SPEC[0][1]


def _r6(c):
    return F.round(F.col(c).cast("double"), 6).alias(c)


def _ints(df, cols):
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


@query("features_sql_table")
def q_features_sql_table(spark, sf_dir):
    """Lags 1/7/14/28, trailing means, the SQL-style rolling deviation."""
    out = W.sql_feature_table(nation_panel(spark, sf_dir))
    dbl = ["rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_dev_7"]
    return out.select("shipment_date", "entity", "n_shipments", "lag_1", "lag_7", "lag_14", "lag_28",
                      *[_r6(c) for c in dbl])


@query("features_sparse")
def q_features_sparse(spark, sf_dir):
    """The same features for the days with a shipment, from the sparse counts by
    day-based windows: no zero-filled grid is built."""
    out = SP.sql_feature_table(P.materialize(S.shipment_counts(spark, sf_dir, "nation")))
    dbl = ["rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_dev_7"]
    return out.select("shipment_date", "entity", "n_shipments", "lag_1", "lag_7", "lag_14", "lag_28",
                      *[_r6(c) for c in dbl])


@query("feature_coverage")
def q_feature_coverage(spark, sf_dir):
    out = W.sql_feature_table(nation_panel(spark, sf_dir))
    return W.feature_coverage(out, ["lag_1", "lag_28", "rolling_mean_7", "rolling_dev_7"])


@query("features_rolling")
def q_features_rolling(spark, sf_dir):
    """Trailing mean/std/min/max over 7 and 28 rows, at least 3 rows."""
    out = W.add_rolling(nation_panel(spark, sf_dir), (7, 28), W.ROLLING_STATS, min_periods=3)
    names = [f"rolling_{s}_{w}" for w in (7, 28) for s in W.ROLLING_STATS]
    return out.select("shipment_date", "entity", "n_shipments", *[_r6(c) for c in names])


@query("features_calendar")
def q_features_calendar(spark, sf_dir):
    out = X.calendar_step(X.CALENDAR_FEATURES)(nation_panel(spark, sf_dir))
    return _ints(out, X.CALENDAR_FEATURES)


@query("features_holidays")
def q_features_holidays(spark, sf_dir):
    out = X.holiday_step()(nation_panel(spark, sf_dir))
    return _ints(out, [c for c in X.HOLIDAY_FEATURES if c != "day_type"])


@query("features_events")
def q_features_events(spark, sf_dir):
    out = X.event_step()(nation_panel(spark, sf_dir))
    return _ints(out, X.event_feature_names())


@query("features_trend")
def q_features_trend(spark, sf_dir):
    out = X.trend_step(TREND_ANCHOR)(nation_panel(spark, sf_dir))
    return out.withColumns({"month_index": F.col("month_index").cast("int"),
                            "year_progress": F.round(F.col("year_progress").cast("double"), 6)})


def _train_stats(panel):
    return X.volume_stats(panel.where(F.col("shipment_date") <= F.lit(FIRST_TRAIN_END)))


@query("features_volume")
def q_features_volume(spark, sf_dir):
    panel = nation_panel(spark, sf_dir)
    out = X.volume_step(_train_stats(panel), thresholds=NATION_TIERS)(panel)
    return out.withColumn("state_avg_volume", F.round(F.col("state_avg_volume").cast("double"), 6))


DEFAULT_FEATURES = ("lag_7", "lag_14", "rolling_mean_7", "rolling_std_7", "day_of_week", "month",
                    "is_weekend", "is_month_start", "is_month_end", "is_holiday", "is_business_day",
                    "is_saturday", "is_sunday", "is_operational", "day_type",
                    *X.event_feature_names(), "days_since_start", "year_progress",
                    "state_avg_volume", "volume_tier")


@query("features_default")
def q_features_default(spark, sf_dir):
    """The canonical 23-feature table (+ is_operational, day_type)."""
    panel = nation_panel(spark, sf_dir)
    pipe = X.default_pipeline(_train_stats(panel), thresholds=NATION_TIERS,
                              reference_date=TREND_ANCHOR)
    out = pipe.transform(panel)
    dbl = ("rolling_mean_7", "rolling_std_7", "year_progress", "state_avg_volume")
    ints = [c for c in DEFAULT_FEATURES if c not in dbl and c not in ("day_type", "volume_tier")]
    out = _ints(out, ints).withColumns(
        {c: F.round(F.col(c).cast("double"), 6) for c in dbl})
    return out.select("shipment_date", "entity", "n_shipments", *DEFAULT_FEATURES)


# ---------------------------------------------------------------------------
# Folds, baselines, evaluation
# ---------------------------------------------------------------------------
from demandgrid.operators import evaluation as E  # noqa: E402
from demandgrid.operators import folds as FO  # noqa: E402

HOLDOUT_FOLD = 4


def _round_cols(df, cols, nd=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), nd) for c in cols})


def nation_backtest(spark, sf_dir):
    return E.backtest(nation_panel(spark, sf_dir), ("naive", "seasonal_naive"))


@query("fold_sizes")
def q_fold_sizes(spark, sf_dir):
    return FO.fold_sizes(FO.assign_folds(nation_panel(spark, sf_dir)))


@query("backtest_naive")
def q_backtest_naive(spark, sf_dir):
    out = E.backtest(nation_panel(spark, sf_dir), ("naive",))
    return _round_cols(out, ["n_shipments", "y_pred", "y_lower", "y_upper"])


@query("backtest_seasonal_naive")
def q_backtest_seasonal(spark, sf_dir):
    out = E.backtest(nation_panel(spark, sf_dir), ("seasonal_naive",))
    return _round_cols(out, ["n_shipments", "y_pred", "y_lower", "y_upper"])


@query("backtest_metrics")
def q_backtest_metrics(spark, sf_dir):
    out = E.metrics_by(nation_backtest(spark, sf_dir), ["model", "fold_id"])
    return _round_cols(out, ["wape", "mae", "rmse", "bias"])


@query("backtest_metrics_operational")
def q_backtest_metrics_operational(spark, sf_dir):
    preds = X.add_holiday_features(nation_backtest(spark, sf_dir))
    out = E.metrics_by(preds.where(F.col("is_operational") == 1), ["model", "fold_id"])
    return _round_cols(out, ["wape", "mae", "rmse", "bias"])


@query("wape_by_entity")
def q_wape_by_entity(spark, sf_dir):
    out = E.wape_by_segment(nation_backtest(spark, sf_dir), "entity", extra_keys=["model", "fold_id"])
    return _round_cols(out, ["wape"])


@query("wape_by_day_type")
def q_wape_by_day_type(spark, sf_dir):
    preds = X.add_holiday_features(nation_backtest(spark, sf_dir))
    return _round_cols(E.wape_by_segment(preds, "day_type", extra_keys=["model"]), ["wape"])


@query("wape_near_events")
def q_wape_near_events(spark, sf_dir):
    """WAPE within +/-3 days of any Black Friday of the test years."""
    events = [_dt.date(2000, 11, 24), _dt.date(2001, 11, 23)]
    out = E.wape_in_event_window(nation_backtest(spark, sf_dir), events, 3, ["model"])
    return _round_cols(out, ["wape"])


@query("event_window_wape")
def q_event_window_wape(spark, sf_dir):
    """WAPE per model, overall and within 7 days of each event (a column each,
    NULL where a window has no rows)."""
    return _round_cols(E.event_table(nation_backtest(spark, sf_dir), K.EVENT_DAYS), ["overall", *K.EVENT_DAYS])


def _holdout_perf(spark, sf_dir):
    preds = nation_backtest(spark, sf_dir).where(
        (F.col("model") == "seasonal_naive") & (F.col("fold_id") == HOLDOUT_FOLD))
    return E.entity_performance(preds)


@query("entity_performance")
def q_entity_performance(spark, sf_dir):
    out = E.entity_performance(nation_backtest(spark, sf_dir), ["model", "fold_id"])
    return _round_cols(out, ["wape", "total", "daily_mean"])


@query("best_worst_entities")
def q_best_worst(spark, sf_dir):
    out = E.best_worst(_holdout_perf(spark, sf_dir), 5)
    return _round_cols(out, ["wape", "total", "daily_mean"])


@query("fold_winner")
def q_fold_winner(spark, sf_dir):
    m = E.metrics_by(nation_backtest(spark, sf_dir), ["model", "fold_id"])
    return _round_cols(E.fold_winner(m, "naive", "seasonal_naive"), ["naive_wape", "seasonal_naive_wape"])


@query("metric_mean_std")
def q_metric_mean_std(spark, sf_dir):
    m = E.metrics_by(nation_backtest(spark, sf_dir), ["model", "fold_id"])
    out = m.groupBy("model").agg(*[f(c).alias(f"{c}_{n}") for c in ("wape", "mae", "rmse")
                                   for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    return _round_cols(out, [c for c in out.columns if c != "model"])


@query("wape_pivot_uplift")
def q_wape_pivot(spark, sf_dir):
    """WAPE pivoted to one column per model, plus the difference."""
    m = E.metrics_by(nation_backtest(spark, sf_dir), ["model", "fold_id"])
    wide = m.groupBy("fold_id").pivot("model", ["naive", "seasonal_naive"]).agg(F.first("wape"))
    wide = wide.withColumn("uplift", F.col("naive") - F.col("seasonal_naive"))
    return _round_cols(wide, ["naive", "seasonal_naive", "uplift"])


@query("spearman_volume_wape")
def q_spearman(spark, sf_dir):
    """Rank correlation of an entity's volume and its WAPE, with its p-value."""
    return _round_cols(E.spearman(_holdout_perf(spark, sf_dir), "total", "wape"), ["spearman", "p_value"])


# ---------------------------------------------------------------------------
# Costs
# ---------------------------------------------------------------------------
from demandgrid.operators import costs as CO  # noqa: E402

GAIN_COLS = ["gain_no_tuning", "gain_tuned", "best_alpha", "cost_model_no_tuning",
             "cost_model_tuned", "cost_baseline", "tuning_uplift"]


def nation_paired(spark, sf_dir):
    """Naive (model) vs seasonal naive (baseline) per fold, with day flags."""
    wide = E.backtest_wide(nation_panel(spark, sf_dir))
    return X.add_holiday_features(CO.paired_from_wide(wide, "naive", "seasonal_naive"))


@query("gain_by_fold")
def q_gain_by_fold(spark, sf_dir):
    return _round_cols(CO.gain_by_fold(nation_paired(spark, sf_dir)), GAIN_COLS)


@query("gain_in_events")
def q_gain_in_events(spark, sf_dir):
    return _round_cols(CO.gain_in_events(nation_paired(spark, sf_dir), K.EVENT_WINDOWS), GAIN_COLS)


@query("gain_totals")
def q_gain_totals(spark, sf_dir):
    out = CO.totals_by_ratio(CO.gain_by_fold(nation_paired(spark, sf_dir)))
    return _round_cols(out, ["total_gain_no_tuning", "total_gain_tuned"])


@query("best_multiplier_by_entity")
def q_best_multiplier(spark, sf_dir):
    """Cost-minimising multiplier per (fold, entity) at 3x under-cost."""
    preds = nation_backtest(spark, sf_dir).where(F.col("model") == "seasonal_naive")
    return _round_cols(CO.best_multiplier(preds, ["fold_id", "entity"], 3.0, 1.0),
                       ["best_alpha", "best_cost"])


# ---------------------------------------------------------------------------
# Conformal intervals and batch scoring
# ---------------------------------------------------------------------------
from demandgrid.operators import conformal as CF  # noqa: E402
from demandgrid.operators import scoring as SC  # noqa: E402

TRAIN_END = K.FOLD_SPEC[-1][1]          # 2001-03-31: last training day
HOLDOUT = (K.FOLD_SPEC[-1][2], K.FOLD_SPEC[-1][3])


def _history(spark, sf_dir):
    return nation_panel(spark, sf_dir).where(F.col("shipment_date") <= F.lit(TRAIN_END))


def _offsets_60(hist):
    return CF.conformal_offsets(CF.calibration_residuals(hist, 60), 0.1)


@query("conformal_offsets")
def q_conformal_offsets(spark, sf_dir):
    """Seasonal-naive base, 60 calibration days, alpha 0.1."""
    out = _offsets_60(_history(spark, sf_dir))
    return _round_cols(out, ["lower_offset", "upper_offset", "coverage"])


@query("conformal_coverage_by_calibration")
def q_conformal_coverage(spark, sf_dir):
    """Offsets and holdout coverage for 30/45/60/90/120 calibration days."""
    panel = nation_panel(spark, sf_dir)
    hist = panel.where(F.col("shipment_date") <= F.lit(TRAIN_END))
    offs = CF.conformal_offsets(CF.residuals_by_length(hist, K.CALIBRATION_LENGTHS), 0.1, keys=["calib_days"])
    horizon = (HOLDOUT[1] - HOLDOUT[0]).days + 1
    base = CF.base_fit_predict(hist, horizon, "seasonal_naive", 7, (), "shipment_date", "entity",
                               "n_shipments")
    truth = P.date_window(panel, *HOLDOUT).select("shipment_date", "entity", "n_shipments")
    per_len = base.withColumn("calib_days", F.explode(F.array(*[F.lit(c) for c in K.CALIBRATION_LENGTHS])))
    scored = CF.apply_offsets(per_len, offs, ["calib_days"]).join(truth, ["shipment_date", "entity"])
    cov = CF.interval_coverage(scored, keys=["calib_days"]).withColumnRenamed("coverage", "holdout_coverage")
    out = offs.withColumnRenamed("coverage", "calib_coverage").join(cov, "calib_days")
    return _round_cols(out, ["lower_offset", "upper_offset", "calib_coverage", "holdout_coverage",
                             "mean_width"])


@query("conformal_forecast")
def q_conformal_forecast(spark, sf_dir):
    """91 days past the training end with the calibrated interval."""
    hist = _history(spark, sf_dir)
    out = CF.conformal_forecast(hist, 91, _offsets_60(hist))
    return _round_cols(out, ["y_pred", "y_lower", "y_upper"])


# Fixed scoring requests (parameters; the forecast rows come from the data).
REQUESTS = (
    ("r1", _dt.date(2001, 4, 1), _dt.date(2001, 4, 30), [], None, None, True, True),
    ("r2", _dt.date(2001, 5, 1), _dt.date(2001, 5, 14), ["NATION_1", "NATION_7"], 1.0, 5.0, True, True),
    ("r3", _dt.date(2001, 4, 10), _dt.date(2001, 4, 20), [], -0.5, None, False, True),
    ("r4", _dt.date(2001, 6, 1), _dt.date(2001, 6, 30), ["NATION_3"], None, None, True, False),
    ("bad_order", _dt.date(2001, 5, 10), _dt.date(2001, 5, 1), [], None, None, True, True),
    ("bad_long", _dt.date(2001, 4, 1), _dt.date(2001, 8, 1), [], None, None, True, True),
    ("full", _dt.date(2001, 4, 1), _dt.date(2001, 6, 29), ["NATION_1"], None, None, True, False),     # 90 days
    ("bad_day", _dt.date(2001, 4, 1), _dt.date(2001, 6, 30), ["NATION_1"], None, None, True, False),  # 91 days
    ("bad_alpha", _dt.date(2001, 4, 1), _dt.date(2001, 4, 2), [], 3.0, None, True, True),
    ("bad_ratio", _dt.date(2001, 4, 1), _dt.date(2001, 4, 2), [], None, 20.0, True, True),
    ("bad_start", _dt.date(2001, 3, 1), _dt.date(2001, 4, 2), [], None, None, True, True),
    ("bad_entity", _dt.date(2001, 4, 1), _dt.date(2001, 4, 2), ["NOWHERE"], None, None, True, True),
)


def _checked_requests(spark, sf_dir):
    panel = nation_panel(spark, sf_dir)
    return SC.validate_requests(SC.requests_frame(spark, REQUESTS), TRAIN_END, panel), panel


@query("request_checks")
def q_request_checks(spark, sf_dir):
    req, _ = _checked_requests(spark, sf_dir)
    return req.select("request_id", "reason")


def _scored(spark, sf_dir):
    req, panel = _checked_requests(spark, sf_dir)
    hist = panel.where(F.col("shipment_date") <= F.lit(TRAIN_END))
    horizon = SC.forecast_horizon(req, TRAIN_END)
    fc = CF.conformal_forecast(hist, horizon, _offsets_60(hist))
    return SC.score_requests(fc, req)


@query("batch_scoring")
def q_batch_scoring(spark, sf_dir):
    return _round_cols(_scored(spark, sf_dir), ["point", "lower_90", "upper_90", "recommended"])


@query("alpha_sweep")
def q_alpha_sweep(spark, sf_dir):
    hist = _history(spark, sf_dir)
    fc = CF.conformal_forecast(hist, 14, _offsets_60(hist))
    out = SC.alpha_sweep(fc, (-0.5, 0.0, 0.5, 1.0))
    return _round_cols(out.select("shipment_date", "entity", "alpha", "y_pred", "recommended"),
                       ["y_pred", "recommended"])


@query("day_snapshot")
def q_day_snapshot(spark, sf_dir):
    scored = _scored(spark, sf_dir).where(F.col("request_id") == "r1")
    out = SC.day_snapshot(scored, _dt.date(2001, 4, 2)).select("entity", "point", "recommended")
    return _round_cols(out, ["point", "recommended"])


# ---------------------------------------------------------------------------
# Exploratory aggregates, contract checks, profiles, second panel
# ---------------------------------------------------------------------------
from demandgrid.operators import checks as CH  # noqa: E402
from demandgrid.operators import eda as EDA  # noqa: E402
from demandgrid.sources import profile as PR  # noqa: E402


def national_days(spark, sf_dir, sunday_first=True):
    daily = EDA.national_total(nation_panel(spark, sf_dir))
    return X.add_holiday_features(daily, sunday_first=sunday_first)


@query("national_daily_total")
def q_national_total(spark, sf_dir):
    return EDA.national_total(nation_panel(spark, sf_dir))


@query("monthly_summary")
def q_monthly_summary(spark, sf_dir):
    return EDA.monthly_summary(EDA.national_total(nation_panel(spark, sf_dir)))


@query("weekday_stats")
def q_weekday_stats(spark, sf_dir):
    days = national_days(spark, sf_dir).where(F.col("is_business_day") == 1)
    out = EDA.share_of_peak(EDA.weekday_stats(days))
    return _round_cols(out, ["avg_value", "median_value", "std_value", "pct_of_peak"])


@query("day_type_stats")
def q_day_type_stats(spark, sf_dir):
    out = EDA.group_stats(national_days(spark, sf_dir), "day_type")
    return _round_cols(out, ["avg_value", "median_value"])


@query("day_type_counts")
def q_day_type_counts(spark, sf_dir):
    return EDA.value_counts(national_days(spark, sf_dir), "day_type")


@query("describe_daily_total")
def q_describe(spark, sf_dir):
    out = EDA.describe(EDA.national_total(nation_panel(spark, sf_dir)), "total")
    return _round_cols(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query("operational_share")
def q_operational_share(spark, sf_dir):
    out = EDA.retained_share(national_days(spark, sf_dir), F.col("is_operational") == 1)
    return _round_cols(out, ["share"])


@query("month_weekday_matrix")
def q_month_weekday(spark, sf_dir):
    days = national_days(spark, sf_dir).where(F.col("is_business_day") == 1)
    out = EDA.month_weekday_matrix(days)
    return _round_cols(out, list(EDA.WEEKDAYS[:6]))


@query("zero_business_days")
def q_zero_business_days(spark, sf_dir):
    """Zero-shipment business days per entity (anomaly count)."""
    feats = X.add_holiday_features(nation_panel(spark, sf_dir))
    z = EDA.zero_days(feats).where(F.col("is_business_day") == 1)
    return z.groupBy("entity").agg(F.count(F.lit(1)).alias("n_zero_business_days"))


@query("panel_density_check")
def q_panel_density(spark, sf_dir):
    """Expected rows (days x entities) vs stored rows of both panels."""
    parts = []
    for name, pnl in (("panel_nation", nation_panel(spark, sf_dir)), ("panel_region", region_panel(spark, sf_dir))):
        parts.append(pnl.agg(
            (F.count_distinct("shipment_date") * F.count_distinct("entity")).alias("expected"),
            F.count(F.lit(1)).alias("actual")).withColumn("table_name", F.lit(name)))
    out = parts[0].unionByName(parts[1])
    return out.withColumn("status", F.when(F.col("expected") == F.col("actual"), "ok").otherwise("MISMATCH"))


@query("table_row_counts")
def q_row_counts(spark, sf_dir):
    return PR.row_counts({t: S.read_table(spark, sf_dir, t) for t in S.TABLES})


REQUIRED = {        # columns that must not be NULL
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"], "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"], "region": ["r_regionkey", "r_name"],
}


@query("table_checks")
def q_table_checks(spark, sf_dir):
    """NOT NULL, value rules, key uniqueness and foreign keys of facts and
    dimensions: a table is scanned once for the column rules, once for its key and
    once for all its foreign keys."""
    rd = lambda t, cols=None: S.read_table(spark, sf_dir, t, cols)
    li, od, cu, na = rd("lineitem"), rd("orders"), rd("customer"), rd("nation")
    rules = {"lineitem": {"l_quantity_positive": F.col("l_quantity") > 0, "l_discount_0_1": F.col("l_discount").between(0, 1)},
             "orders": {"o_orderstatus_len_1": F.length("o_orderstatus") == 1}}
    a = CH.contract_report(nation_panel(spark, sf_dir), "panel_nation", ["shipment_date", "entity", "n_shipments"],
                           {"n_shipments_nonneg": F.col("n_shipments") >= 0})
    for t, columns in REQUIRED.items():
        a = a.unionByName(CH.contract_report(rd(t), t, columns, rules.get(t)))
    dups = [CH.duplicate_keys(li, ["l_orderkey", "l_linenumber"], "lineitem"),
            CH.duplicate_keys(od, ["o_orderkey"], "orders"),
            CH.duplicate_keys(cu, ["c_custkey"], "customer")]
    b = dups[0]
    for d in dups[1:]:
        b = b.unionByName(d)
    b = b.select("table_name", F.lit("primary_key").alias("check"), F.col("key").alias("column_name"),
                 F.col("n_extra_rows").alias("n_violations"))
    su, pa, re = rd("supplier"), rd("part"), rd("region")
    fks = [CH.orphans_many(li, [("l_orderkey", od, "o_orderkey"), ("l_partkey", pa, "p_partkey"), ("l_suppkey", su, "s_suppkey")], "lineitem"),
           CH.orphans(od, cu, "o_custkey", "c_custkey", "orders"),
           CH.orphans(cu, na, "c_nationkey", "n_nationkey", "customer"),
           CH.orphans(su, na, "s_nationkey", "n_nationkey", "supplier"),
           CH.orphans(na, re, "n_regionkey", "r_regionkey", "nation")]
    c = fks[0]
    for f in fks[1:]:
        c = c.unionByName(f)
    c = c.select("table_name", F.lit("foreign_key").alias("check"), F.col("fk").alias("column_name"),
                 F.col("n_orphans").alias("n_violations"))
    return a.unionByName(b).unionByName(c)


@query("column_profile")
def q_column_profile(spark, sf_dir):
    """Type, nulls and distinct values of every column of every table."""
    parts = [PR.column_profile(S.read_table(spark, sf_dir, t), t) for t in S.TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SAMPLE_ORDER = {"lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn"]}


@query("table_samples")
def q_table_samples(spark, sf_dir):
    """The first three rows of every table by its key, a row per column (values as
    text; a vector as its number of components)."""
    out = None
    for t in S.TABLES:
        df = S.read_table(spark, sf_dir, t)
        lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
        df = df.withColumns({c: F.size(c) for c in lists}) if lists else df
        own = PR.sample_rows(df, 3, SAMPLE_ORDER.get(t, df.columns[:1])).select(F.lit(t).alias("table_name"), "column_name", "sample")
        out = own if out is None else out.unionByName(own)
    return out


@query("events_panel")
def q_events_panel(spark, sf_dir):
    """Second panel: events per day and event type, dense."""
    return P.build_panel(S.event_rows(spark, sf_dir))


@query("events_panel_features")
def q_events_panel_features(spark, sf_dir):
    """Lags and trailing stats on the events panel (entity = event type)."""
    pnl = P.build_panel(S.event_rows(spark, sf_dir))
    out = W.add_rolling(W.add_lags(pnl, (1, 7)), (7,), ("mean", "std"), min_periods=2)
    return _round_cols(out, ["rolling_mean_7", "rolling_std_7"]).withColumns(
        {c: F.col(c).cast("int") for c in ("lag_1", "lag_7")})


@query("holiday_calendar")
def q_holiday_calendar(spark, sf_dir):
    """Holiday dates (fixed list U Easter-relative, deduplicated) for every
    year from the panel's first to last year."""
    from demandgrid.functions import calendar as cal
    return cal.holiday_dates(nation_panel(spark, sf_dir), "shipment_date")


# ---------------------------------------------------------------------------
# Boosted trees (rows-only checks: Spark ML fits have no SQL oracle)
# ---------------------------------------------------------------------------
from demandgrid.operators import boosting as BO  # noqa: E402
from demandgrid.operators import search as SE  # noqa: E402
from demandgrid.operators import trees as TR  # noqa: E402
from demandgrid.operators import tuning as TU  # noqa: E402

GBT_PARAMS = TR.GBTParams(max_iter=20, max_depth=4, step_size=0.1)


def holdout_model(spark, sf_dir):
    return once(("holdout", sf_dir), lambda: TR.fit(_history(spark, sf_dir), GBT_PARAMS, NATION_TIERS, TREND_ANCHOR))


@query("gbt_holdout_eval")
def q_gbt_holdout(spark, sf_dir):
    """Fit on history up to the training end, recursive 91-day forecast,
    holdout WAPE / MAE / RMSE rounded to 4 places."""
    fc = holdout_model(spark, sf_dir)
    hist = _history(spark, sf_dir)
    pred = P.materialize(TR.recursive_forecast(fc, hist, (HOLDOUT[1] - HOLDOUT[0]).days + 1))
    truth = P.date_window(nation_panel(spark, sf_dir), *HOLDOUT)
    j = CH.one_to_one_join(pred, truth, ["shipment_date", "entity"])
    out = j.agg(F.min("shipment_date").alias("window_start"), F.max("shipment_date").alias("window_end"),
                F.count_distinct("shipment_date").alias("n_days"), F.count(F.lit(1)).alias("n_rows"),
                *[F.round(c, 4).alias(n) for n, c in (("wape", E.M.wape()), ("mae", E.M.mae()),
                                                      ("rmse", E.M.rmse()))])
    return out


@query("gbt_conformal_offsets")
def q_gbt_conformal_offsets(spark, sf_dir):
    """Production interval of the tree model: trees fitted before the last
    60 days of the history forecast them recursively; offsets (alpha 0.1)
    and calibration coverage from the operational-day residuals."""
    return _round_cols(_tree_offsets(spark, sf_dir), ["lower_offset", "upper_offset", "coverage"])


def _tree_offsets(spark, sf_dir):
    res = CF.tree_calibration_residuals(_history(spark, sf_dir), 60, GBT_PARAMS, NATION_TIERS, TREND_ANCHOR)
    return P.materialize(CF.conformal_offsets(res, 0.1))


@query("gbt_conformal_coverage_by_calibration")
def q_gbt_conformal_coverage(spark, sf_dir):
    """Tree-based intervals for 30/45/60/90/120 calibration days: offsets and
    calibration coverage per length (one calibration fit per length, run
    concurrently), holdout coverage of the holdout model's forecast."""
    from concurrent.futures import ThreadPoolExecutor
    panel = nation_panel(spark, sf_dir)
    hist = _history(spark, sf_dir)

    def offsets_for(days):
        res = CF.tree_calibration_residuals(hist, days, GBT_PARAMS, NATION_TIERS, TREND_ANCHOR)
        return P.materialize(CF.conformal_offsets(res, 0.1).withColumn("calib_days", F.lit(days)))

    with ThreadPoolExecutor(max_workers=len(K.CALIBRATION_LENGTHS)) as pool:
        parts = list(pool.map(offsets_for, K.CALIBRATION_LENGTHS))
    offs = parts[0]
    for p in parts[1:]:
        offs = offs.unionByName(p)
    horizon = (HOLDOUT[1] - HOLDOUT[0]).days + 1
    pred = TR.recursive_forecast(holdout_model(spark, sf_dir), hist, horizon)
    truth = P.date_window(panel, *HOLDOUT).select("shipment_date", "entity", "n_shipments")
    per_len = pred.withColumn("calib_days", F.explode(F.array(*[F.lit(c) for c in K.CALIBRATION_LENGTHS])))
    scored = CF.apply_offsets(per_len, offs, ["calib_days"]).join(truth, ["shipment_date", "entity"])
    cov = CF.interval_coverage(scored, keys=["calib_days"]).withColumnRenamed("coverage", "holdout_coverage")
    out = offs.withColumnRenamed("coverage", "calib_coverage").join(cov, "calib_days")
    return _round_cols(out, ["lower_offset", "upper_offset", "calib_coverage", "holdout_coverage",
                             "mean_width"])


@query("gbt_batch_scoring")
def q_gbt_batch_scoring(spark, sf_dir):
    """The scoring requests served by the production model of the original:
    the tree forecast past the training end with its conformal interval."""
    req, panel = _checked_requests(spark, sf_dir)
    hist = panel.where(F.col("shipment_date") <= F.lit(TRAIN_END))
    horizon = SC.forecast_horizon(req, TRAIN_END)
    pred = TR.recursive_forecast(holdout_model(spark, sf_dir), hist, horizon)
    fc = CF.apply_offsets(pred, _tree_offsets(spark, sf_dir))
    return _round_cols(SC.score_requests(fc, req), ["point", "lower_90", "upper_90", "recommended"])


@query("gbt_feature_importance")
def q_gbt_importance(spark, sf_dir):
    """Top 15 features by importance with their share of the total."""
    imp = TR.feature_importance(holdout_model(spark, sf_dir), spark)
    return imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(15)


def gbt_paired(spark, sf_dir):
    """Trees vs seasonal naive on the four folds, one row per (fold, date,
    entity) with day flags, stored (several aggregates read it)."""
    panel = nation_panel(spark, sf_dir)
    wide = E.backtest_wide(panel)

    def one_fold(spec):
        fid, te, ts, tend, _ = spec
        train = panel.where(F.col("shipment_date") <= F.lit(te))
        fc = TR.fit(train, GBT_PARAMS, NATION_TIERS, TREND_ANCHOR)
        h = (tend - ts).days + 1
        return TR.recursive_forecast(fc, train, h).withColumn("fold_id", F.lit(fid))

    # The folds' fits are independent Spark ML jobs: submit them concurrently
    # so their many small boosting stages share the executors.
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(K.FOLD_SPEC)) as pool:
        parts = list(pool.map(one_fold, K.FOLD_SPEC))
    trees = parts[0]
    for p in parts[1:]:
        trees = trees.unionByName(p)
    paired = (wide.join(trees, ["fold_id", "shipment_date", "entity"])
              .withColumns({"y_pred_model": F.col("y_pred"), "y_pred_base": F.col("y_pred_seasonal_naive")}))
    return P.materialize(X.add_holiday_features(paired))


@query("gbt_gain_by_fold")
def q_gbt_gain(spark, sf_dir):
    """Trees vs seasonal naive: gain per fold and cost ratio (operational days)."""
    return _round_cols(CO.gain_by_fold(gbt_paired(spark, sf_dir)), GAIN_COLS)


@query("gbt_gain_in_events")
def q_gbt_gain_in_events(spark, sf_dir):
    """Trees vs seasonal naive inside the named event windows, per cost ratio."""
    return _round_cols(CO.gain_in_events(gbt_paired(spark, sf_dir), K.EVENT_WINDOWS), GAIN_COLS)


@query("gbt_backtest_metrics")
def q_gbt_backtest_metrics(spark, sf_dir):
    """WAPE / MAE / RMSE / bias per fold for the trees and the seasonal-naive
    baseline on the same rows (all days), from the shared pairing."""
    paired = gbt_paired(spark, sf_dir)
    long = paired.select("fold_id", "n_shipments", F.explode(F.array(
        F.struct(F.lit("gbt").alias("model"), F.col("y_pred_model").alias("y_pred")),
        F.struct(F.lit("seasonal_naive").alias("model"), F.col("y_pred_base").alias("y_pred")))).alias("m"))
    out = E.metrics_by(long.select("fold_id", "n_shipments", "m.model", "m.y_pred"), ["model", "fold_id"])
    return _round_cols(out, ["wape", "mae", "rmse", "bias"])


SEARCH_BUDGET = {"trials": 6, "rounds": 8, "patience": 4}      # the original: 100 trials of up to 1,000 rounds, patience 50


@query("gbt_search")
def q_gbt_search(spark, sf_dir, trials=SEARCH_BUDGET["trials"], rounds=SEARCH_BUDGET["rounds"], patience=SEARCH_BUDGET["patience"]):
    """Eight parameters searched by the Parzen sampler on folds 1-3 (three trials
    at a time, three start-up trials): best trial, completed and stopped trials,
    boosting rounds used. The budget is an argument."""
    found = P.materialize(SE.search(nation_panel(spark, sf_dir), trials, rounds, K.FOLD_SPEC[:3], at_once=3, startup=3, patience=patience,
                                    thresholds=NATION_TIERS, reference_date=TREND_ANCHOR))
    used = found.agg(F.sum(F.aggregate("rounds_used", F.lit(0), lambda a, n: a + n)).alias("rounds_used"))
    return TU.summarize(found).withColumn("rounds_used", used.scalar())


@query("boosted_backtest_metrics")
def q_boosted_backtest(spark, sf_dir, rounds=12):
    """Histogram-boosted trees with leaf penalties on the four folds, fitted in
    lockstep: metrics of the recursive forecast and the rounds used per fold."""
    panel = nation_panel(spark, sf_dir)
    parts = {fid: (panel.where(F.col("shipment_date") <= F.lit(te)), None) for fid, te, _, _, _ in K.FOLD_SPEC}
    data = TR.prepare_folds(parts, NATION_TIERS, TREND_ANCHOR)
    params = BO.Params(rounds=rounds, leaves=31, rate=0.2, l1=0.1, l2=1.0)
    models = BO.fit_many(data.blocks, [(fid, params) for fid, *_ in K.FOLD_SPEC])
    out = None
    for (fid, _, ts, tend, _), model in zip(K.FOLD_SPEC, models):
        pred = TR.recursive_forecast(data.forecaster(fid, model), parts[fid][0], (tend - ts).days + 1)
        truth = P.date_window(panel, ts, tend)
        rows = pred.join(truth, ["shipment_date", "entity"]).withColumns({"fold_id": F.lit(fid), "rounds_used": F.lit(model.rounds_used)})
        out = rows if out is None else out.unionByName(rows)
    return _round_cols(E.metrics_by(out, ["fold_id", "rounds_used"]), ["wape", "mae", "rmse", "bias"])


# ---------------------------------------------------------------------------
# Per-fold modelling table
# ---------------------------------------------------------------------------
@query("fold_feature_table")
def q_fold_feature_table(spark, sf_dir):
    """Every fold's modelling rows in one plan: features on train U test
    with windows partitioned by (fold_id, entity), volume statistics from
    the fold's train rows only, operational rows, no NULL feature."""
    assigned = FO.assign_folds(nation_panel(spark, sf_dir))
    out = FO.modelling_table(assigned, thresholds=NATION_TIERS, reference_date=TREND_ANCHOR)
    dbl = ("rolling_mean_7", "rolling_std_7", "year_progress", "state_avg_volume")
    ints = [c for c in DEFAULT_FEATURES if c not in dbl and c not in ("day_type", "volume_tier")]
    out = _ints(out, ints).withColumns({c: F.round(F.col(c).cast("double"), 6) for c in dbl})
    return out.select("fold_id", "split", "shipment_date", "entity", "n_shipments", *DEFAULT_FEATURES)


# ---------------------------------------------------------------------------
# Additive decomposition (fits from normal equations: rows-only)
# ---------------------------------------------------------------------------
from demandgrid.operators import decomposition as DC  # noqa: E402


@query("decomposition_backtest_metrics")
def q_decomposition_metrics(spark, sf_dir):
    """Decomposition forecaster on the four folds: metrics per fold."""
    out = E.metrics_by(DC.backtest(nation_panel(spark, sf_dir)), ["model", "fold_id"])
    return _round_cols(out, ["wape", "mae", "rmse", "bias"])


@query("decomposition_sparse_metrics")
def q_decomposition_sparse_metrics(spark, sf_dir):
    """The same with a sparse penalty on the slope changes."""
    out = E.metrics_by(DC.backtest(nation_panel(spark, sf_dir), knot_penalty=5.0), ["model", "fold_id"])
    return _round_cols(out, ["wape", "mae", "rmse", "bias"])


# ---------------------------------------------------------------------------
# Model information row
# ---------------------------------------------------------------------------
@query("model_info")
def q_model_info(spark, sf_dir):
    """Metadata row of the production interval model (seasonal-naive base,
    60-day calibration) with its holdout evaluation, projected for reporting."""
    from demandgrid.sources import state as ST
    panel = nation_panel(spark, sf_dir)
    hist = panel.where(F.col("shipment_date") <= F.lit(TRAIN_END))
    off = _offsets_60(hist)
    fc = CF.conformal_forecast(hist, (HOLDOUT[1] - HOLDOUT[0]).days + 1, off)
    ev = fc.join(P.date_window(panel, *HOLDOUT), ["shipment_date", "entity"]).agg(
        F.struct(F.min("shipment_date").alias("window_start"), F.max("shipment_date").alias("window_end"),
                 F.count_distinct("shipment_date").cast("int").alias("n_days"),
                 F.round(E.M.wape(), 4).alias("wape"), F.round(E.M.mae(), 4).alias("mae"),
                 F.round(E.M.rmse(), 4).alias("rmse")).alias("evaluation_metrics"))
    groups = hist.agg(F.sort_array(F.collect_set("entity")).alias("groups"),
                      F.max("shipment_date").alias("last_train_date"))
    off = P.materialize(off)
    meta = groups.withColumns({"evaluation_metrics": ev.scalar(), "lower_offset": off.select("lower_offset").scalar(),
                               "upper_offset": off.select("upper_offset").scalar()}).select(
        F.lit("1").alias("version"), F.lit(None).cast("timestamp").alias("trained_at"),
        "last_train_date", F.col("last_train_date").alias("data_cutoff"),
        F.lit(1).alias("n_features"), F.size("groups").alias("n_groups"), "groups",
        "evaluation_metrics", F.lit("holdout after the last training date").alias("evaluation_note"),
        F.round("lower_offset", 6).alias("lower_offset"), F.round("upper_offset", 6).alias("upper_offset"))
    return ST.model_info(meta, ("lower_offset", "upper_offset")).drop("trained_at")


# ---------------------------------------------------------------------------
# Stored model versions
# ---------------------------------------------------------------------------
from demandgrid.operators import serving as SV  # noqa: E402
from demandgrid.sources.models import ModelStore  # noqa: E402

VERSIONS = {"2000q4": _dt.date(2000, 12, 31), "2001q1": TRAIN_END}


def _models(spark, sf_dir):
    """A store with a version per cut-off, trained in this call."""
    models = ModelStore(spark, scratch_folder(spark))
    panel = nation_panel(spark, sf_dir)
    for version, cutoff in VERSIONS.items():
        SV.train_version(models, panel, version, cutoff)
    return models


@query("training_flow")
def q_training_flow(spark, sf_dir):
    """The training flow at two cut-offs: holdout evaluation of a sibling, size
    and interval of the published version."""
    out = _models(spark, sf_dir).versions().select(
        "version", "data_cutoff", "n_entities", "n_days", "eval_days", "eval_wape", "eval_mae", "eval_rmse",
        "lower_offset", "upper_offset", "coverage")
    return _round_cols(out, ["eval_wape", "eval_mae", "eval_rmse", "lower_offset", "upper_offset", "coverage"])


@query("model_entities")
def q_model_entities(spark, sf_dir):
    """Stored state of both versions, entities as rows."""
    out = _models(spark, sf_dir).entities().select("version", "entity", "n_obs", F.element_at("season_values", -1).alias("last_value"), "resid_std")
    return _round_cols(out, ["resid_std"])


@query("scoring_by_version")
def q_scoring_by_version(spark, sf_dir):
    """The scoring requests served by both stored versions side by side; a request
    that starts before one version's cut-off can be valid under the other."""
    models, requests = _models(spark, sf_dir), SC.requests_frame(spark, REQUESTS)
    parts = [SV.score_version(models, requests, v) for v in VERSIONS]
    out = parts[0].unionByName(parts[1])
    return _round_cols(out, ["point", "lower_90", "upper_90", "recommended"])


# ---------------------------------------------------------------------------
# Spreads, ratios and fold labels
# ---------------------------------------------------------------------------
@query("wape_spread")
def q_wape_spread(spark, sf_dir):
    """Worst / best entity WAPE per model and fold."""
    seg = E.wape_by_segment(nation_backtest(spark, sf_dir), "entity", extra_keys=["model", "fold_id"])
    out = seg.groupBy("model", "fold_id").agg(
        F.max("wape").alias("worst_wape"), F.min("wape").alias("best_wape"),
        F.try_divide(F.max("wape"), F.nullif(F.min("wape"), F.lit(0.0))).alias("worst_over_best"))
    return _round_cols(out, ["worst_wape", "best_wape", "worst_over_best"])


@query("event_gain_ratio")
def q_event_gain_ratio(spark, sf_dir):
    """Tuned gain in the Black Friday window over the June 12 window, per ratio."""
    g = CO.gain_in_events(nation_paired(spark, sf_dir), K.EVENT_WINDOWS)
    out = CO.event_gain_ratio(g, K.EVENT_WINDOWS[0][0], K.EVENT_WINDOWS[1][0])
    return _round_cols(out, ["gain_ratio"])


@query("fold_spec")
def q_fold_spec(spark, sf_dir):
    """Fold bounds with the label suffix and the horizon found in the data."""
    assigned = FO.assign_folds(nation_panel(spark, sf_dir))
    spec = FO.spec_frame(spark).withColumn("label_short", F.split_part("label", F.lit(": "), F.lit(2)))
    data = assigned.groupBy("fold_id").agg(
        F.min(F.when(F.col("split") == "train", F.col("shipment_date"))).alias("train_start"),
        F.count_distinct(F.when(F.col("split") == "test", F.col("shipment_date"))).alias("horizon"))
    return spec.drop("train_start").join(data, "fold_id")


@query("gain_pivot")
def q_gain_pivot(spark, sf_dir):
    """Tuned gain, raw gain and their difference pivoted to one column per
    fold, one row per cost ratio (difference computed in long form first)."""
    g = CO.gain_by_fold(nation_paired(spark, sf_dir)).withColumn(
        "diff", F.col("gain_tuned") - F.col("gain_no_tuning"))
    folds = [f for f, *_ in K.FOLD_SPEC]
    wide = g.groupBy("cost_ratio").pivot("fold_id", folds).agg(
        F.first("gain_tuned").alias("tuned"), F.first("gain_no_tuning").alias("raw"),
        F.first("diff").alias("uplift"))
    return _round_cols(wide, [c for c in wide.columns if c != "cost_ratio"])
