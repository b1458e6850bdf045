"""Training flow: evaluate a sibling model on a holdout, train the
production interval model on the whole history, store state and metadata.

Modes: ``evaluation`` (holdout metrics only), ``production`` (model +
metadata), ``both`` (production metadata carries the holdout evaluation).
Every step is a Spark job; the driver only handles the small metric row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid import constants as K
from demandgrid.functions import metrics as M
from demandgrid.operators import checks as CH
from demandgrid.operators import conformal as CF
from demandgrid.operators import forecast as FC
from demandgrid.operators import panel as P
from demandgrid.operators import trees as T
from demandgrid.sources import state as ST

MODES = ("evaluation", "production", "both")


def evaluate_holdout(panel: DataFrame, train_end: dt.date, holdout_end: dt.date,
                     params: T.GBTParams, thresholds=K.DEFAULT_TIER_THRESHOLDS,
                     reference_date=K.TREND_REFERENCE_DATE) -> dict:
    """Fit the tree model on rows up to ``train_end``, forecast the holdout
    recursively, require a one-to-one match with the truth, metrics at 4 dp."""
    split = P.split_train_holdout(panel, train_end, train_end + dt.timedelta(days=1), holdout_end)
    train = split.where(F.col("split") == "train").drop("split")
    hold = split.where(F.col("split") == "holdout").drop("split")
    if train.isEmpty() or hold.isEmpty():
        raise ValueError("empty train or holdout split")
    fc = T.fit(train, params, thresholds, reference_date)
    horizon = (holdout_end - train_end).days
    pred = T.recursive_forecast(fc, train, horizon)
    joined = CH.one_to_one_join(hold, pred, [K.DATE_COL, K.ENTITY_COL])
    r = joined.agg(M.wape().alias("wape"), M.mae().alias("mae"), M.rmse().alias("rmse"),
                   F.count_distinct(K.DATE_COL).alias("n_days")).first()
    return {"window_start": train_end + dt.timedelta(days=1), "window_end": holdout_end,
            "n_days": int(r.n_days), "wape": round(r.wape, 4), "mae": round(r.mae, 4),
            "rmse": round(r.rmse, 4)}


BASES = ("seasonal_naive", "trees")


def fast_retrain_params() -> T.GBTParams:
    return T.GBTParams(max_iter=K.FAST_RETRAIN_TREES, max_depth=K.FAST_RETRAIN_DEPTH,
                       step_size=K.FAST_RETRAIN_RATE, min_instances=K.FAST_RETRAIN_MIN_LEAF)


def run(panel: DataFrame, mode: str, out_dir: str, train_end: dt.date | None = None,
        holdout_end: dt.date | None = None, params: T.GBTParams = T.GBTParams(),
        calibration_days: int = 60, alpha: float = 0.1, thresholds=K.DEFAULT_TIER_THRESHOLDS,
        reference_date=K.TREND_REFERENCE_DATE, base: str = "seasonal_naive",
        fast_retrain: bool = False) -> dict:
    """``base="trees"`` stores the boosted-tree forecaster wrapped in
    split-conformal offsets (model, per-entity volume state, metadata);
    ``base="seasonal_naive"`` the seasonal-naive state with its offsets.
    ``fast_retrain`` keeps the last ``FAST_RETRAIN_DAYS`` days and uses the
    small fast-retrain tree parameters."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if base not in BASES:
        raise ValueError(f"base must be one of {BASES}, got {base!r}")
    spark = panel.sparkSession
    if fast_retrain:
        panel = P.trailing_days(panel, K.FAST_RETRAIN_DAYS)
        params = fast_retrain_params()
    result: dict = {}
    if mode in ("evaluation", "both"):
        if train_end is None or holdout_end is None:
            raise ValueError("evaluation needs train_end and holdout_end")
        result["evaluation"] = evaluate_holdout(panel, train_end, holdout_end, params, thresholds,
                                                reference_date)
    if mode in ("production", "both"):
        extra: dict = {"alpha": alpha, "calibration_days": calibration_days, "fast_retrain": fast_retrain}
        if base == "trees":
            residuals = CF.tree_calibration_residuals(panel, calibration_days, params, thresholds,
                                                      reference_date)
            # The stored model is refitted on the whole history (calibration
            # days included) and forecasts from its end.
            fc = T.fit(panel, params, thresholds, reference_date)
            fc.model.write().overwrite().save(f"{out_dir.rstrip('/')}/trees")
            ST.write_state(fc.stats, out_dir)
            name = "conformal_trees"
            extra.update({"feature_names": list(T.MODEL_FEATURES), "thresholds": list(thresholds),
                          "reference_date": reference_date.isoformat(),
                          "params": {k: v for k, v in vars(params).items() if k != "extra"}})
        else:
            residuals = CF.calibration_residuals(panel, calibration_days)
            ST.write_state(FC.seasonal_naive_fit(panel, 7), out_dir)
            name = "conformal_seasonal_naive"
        off = CF.conformal_offsets(residuals, alpha).first()
        info = panel.agg(F.max(K.DATE_COL).alias("last"), F.sort_array(F.collect_set(K.ENTITY_COL)).alias("g")).first()
        ev = result.get("evaluation")
        meta = {"version": "1", "trained_at": ST.utc_now(), "last_train_date": info["last"],
                "data_cutoff": info["last"], "n_features": len(T.MODEL_FEATURES), "n_groups": len(info["g"]),
                "groups": list(info["g"]),
                "evaluation_metrics": (ev["window_start"], ev["window_end"], ev["n_days"], ev["wape"],
                                       ev["mae"], ev["rmse"]) if ev else None,
                "evaluation_note": "holdout of a sibling model trained up to train_end" if ev else None}
        extra.update({"lower_offset": off.lower_offset, "upper_offset": off.upper_offset,
                      "coverage": off.coverage})
        ST.write_metadata(spark, out_dir, name, meta, extra=extra)
        result["production"] = {"lower_offset": off.lower_offset, "upper_offset": off.upper_offset,
                                "coverage": off.coverage, "path": out_dir, "model": name}
    return result


def load_tree_forecaster(spark, out_dir: str) -> tuple[T.TreeForecaster, dict]:
    """The stored conformal tree model: forecaster + metadata extras
    (offsets, thresholds, trend anchor, parameters)."""
    import json
    from pyspark.ml.regression import GBTRegressionModel
    state, meta = ST.read_model(spark, out_dir, "conformal_trees")
    row = meta.first()
    extra = json.loads(row.extra) | {"last_train_date": row.last_train_date}
    model = GBTRegressionModel.load(f"{out_dir.rstrip('/')}/trees")
    fc = T.TreeForecaster(model, state, tuple(extra["thresholds"]),
                          dt.date.fromisoformat(extra["reference_date"]))
    return fc, extra


def tree_interval_forecast(fc: T.TreeForecaster, history: DataFrame, horizon: int,
                           lower_offset: float, upper_offset: float) -> DataFrame:
    """Recursive tree forecast with the conformal interval (lower clipped
    at 0, upper not)."""
    pred = T.recursive_forecast(fc, history, horizon)
    return pred.withColumns({
        "y_lower": F.greatest(F.lit(0.0), F.col("y_pred") + F.lit(float(lower_offset))),
        "y_upper": F.col("y_pred") + F.lit(float(upper_offset)),
    })
