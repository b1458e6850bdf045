"""Parameter search for the boosted-tree forecaster.

Each trial is a set of Spark ML fits (one per tuning fold) and recursive
forecasts; the driver only keeps the small trial table (per-fold WAPE) for
the median stopping rule: from the ``warmup_steps``-th fold on, once
``startup_trials`` trials have run, a trial stops when its fold WAPE is
worse than the median of earlier trials' WAPE at the same fold.
Parameters are sampled with a seeded generator (reproducible).
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid import constants as K
from demandgrid.functions import metrics as M
from demandgrid.operators import trees as T

# Search space: (name, kind, low, high) or choices. Spark GBT counterparts of
# leaves/depth, learning rate, column and row sampling, minimum leaf size.
SPACE = {
    "max_depth": ("choice", [3, 4, 5, 6]),
    "step_size": ("log", 0.01, 0.3),
    "feature_fraction": ("float", 0.5, 1.0),
    "subsampling_rate": ("float", 0.5, 1.0),
    "min_instances": ("int", 5, 100),
    # stands for the two penalties on leaf weights: a split must gain this much
    "min_info_gain": ("log", 1e-6, 1e-1),
}


def sample_params(rng: random.Random, max_iter: int) -> T.GBTParams:
    p = {}
    for name, spec in SPACE.items():
        kind = spec[0]
        if kind == "choice":
            p[name] = rng.choice(spec[1])
        elif kind == "log":
            p[name] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        elif kind == "float":
            p[name] = rng.uniform(spec[1], spec[2])
        else:
            p[name] = rng.randint(spec[1], spec[2])
    return T.GBTParams(max_iter=max_iter, max_depth=p["max_depth"], step_size=p["step_size"],
                       subsampling_rate=p["subsampling_rate"],
                       feature_subset=f"{p['feature_fraction']:.3f}", min_instances=p["min_instances"],
                       min_info_gain=p["min_info_gain"])


@dataclass
class FoldContext:
    """A tuning fold's parameter-free inputs: the assembled training rows
    (with the test rows flagged for early stopping), the test rows, the
    horizon and the recursive forecast's feature frame. Built once per fold
    and shared by every trial."""
    train: DataFrame
    test: DataFrame
    data: T.TrainingData
    horizon: int
    inputs: DataFrame


def fold_context(panel: DataFrame, train_end, test_start, test_end,
                 thresholds=K.DEFAULT_TIER_THRESHOLDS, reference_date=K.TREND_REFERENCE_DATE,
                 early_stopping: bool = True) -> FoldContext:
    from demandgrid.operators.panel import materialize
    d = F.col(K.DATE_COL)
    train = panel.where(d <= F.lit(train_end))
    test = panel.where(d.between(F.lit(test_start), F.lit(test_end)))
    data = T.prepare(train, thresholds, reference_date, validation=test if early_stopping else None)
    horizon = test.select(K.DATE_COL).distinct().count()
    inputs = materialize(T.forecast_inputs(data, train, horizon))
    return FoldContext(train, test, data, horizon, inputs)


def evaluate_fold(panel: DataFrame, params: T.GBTParams, train_end, test_start, test_end,
                  thresholds=K.DEFAULT_TIER_THRESHOLDS, reference_date=K.TREND_REFERENCE_DATE,
                  early_stopping: bool = True,
                  context: FoldContext | Callable[[], FoldContext] | None = None) -> float:
    """Fit on the fold's train rows (test rows drive early stopping, as in
    the tuning loop), forecast the test window recursively, WAPE on all days.
    ``context`` (from :func:`fold_context`, or a function returning it)
    skips the parameter-free work."""
    ctx = context() if callable(context) else context
    ctx = ctx or fold_context(panel, train_end, test_start, test_end, thresholds, reference_date,
                                  early_stopping)
    fc = T.fit_prepared(ctx.data, params)
    pred = T.recursive_forecast(fc, ctx.train, ctx.horizon,
                                inputs=ctx.inputs)
    j = pred.join(ctx.test, [K.DATE_COL, K.ENTITY_COL])
    return float(j.agg(M.wape().alias("w")).first().w)


def search(panel: DataFrame, n_trials: int, folds: Sequence = K.FOLD_SPEC[:3], max_iter: int = 20,
           seed: int = 42, startup_trials: int = 10, warmup_steps: int = 1,
           thresholds=K.DEFAULT_TIER_THRESHOLDS, reference_date=K.TREND_REFERENCE_DATE,
           parallel_folds: bool = True) -> DataFrame:
    """Run the trials; returns one row per trial with its state, mean WAPE,
    per-fold WAPEs and parameters (JSON).

    With ``parallel_folds`` the folds that the median rule cannot stop (all of
    a start-up trial, the warm-up folds of a later one) are submitted
    concurrently, so their Spark jobs share the executors; the others run one
    by one, and those after the stopping point never.
    """
    from concurrent.futures import ThreadPoolExecutor
    rng = random.Random(seed)
    history: list[list[float]] = []
    rows = []
    # Parameter-free fold inputs, built on first use and shared by all trials.
    contexts: dict[int, FoldContext] = {}

    def context(i: int) -> FoldContext:
        if i not in contexts:
            _, te, ts, tend, _ = folds[i]
            contexts[i] = fold_context(panel, te, ts, tend, thresholds, reference_date)
        return contexts[i]

    for trial in range(n_trials):
        params = sample_params(rng, max_iter)

        def run_fold(i, params=params):
            _, te, ts, tend, _ = folds[i]
            return evaluate_fold(panel, params, te, ts, tend, thresholds, reference_date,
                                 context=lambda: context(i))

        sure = 0
        if parallel_folds:
            sure = len(folds) if trial < startup_trials else min(warmup_steps, len(folds))
        with ThreadPoolExecutor(max_workers=max(1, sure)) as pool:
            ahead = list(pool.map(run_fold, range(sure)))
        wapes: list[float] = []
        state = "complete"
        for step in range(len(folds)):
            w = ahead[step] if step < sure else run_fold(step)
            wapes.append(w)
            if trial >= startup_trials and step >= warmup_steps:
                prior = [h[step] for h in history if len(h) > step]
                if prior and w > median(prior):
                    state = "pruned"
                    break
        history.append(wapes)
        rows.append((trial, state, sum(wapes) / len(wapes) if state == "complete" else None, wapes,
                     json.dumps({k: v for k, v in vars(params).items() if k != "extra"}, sort_keys=True)))
    spark: SparkSession = panel.sparkSession
    return spark.createDataFrame(rows, "trial int, state string, mean_wape double, fold_wapes array<double>, "
                                       "params string")


def summarize(trials: DataFrame) -> DataFrame:
    """Best complete trial and completed / pruned counts."""
    done = F.col("state") == "complete"
    return trials.agg(
        F.min_by(F.when(done, F.col("trial")), F.when(done, F.col("mean_wape"))).alias("best_trial"),
        F.min(F.when(done, F.col("mean_wape"))).alias("best_wape"),
        F.min_by(F.when(done, F.col("params")), F.when(done, F.col("mean_wape"))).alias("best_params"),
        F.count_if(done).alias("n_complete"),
        F.count_if(F.col("state") == "pruned").alias("n_pruned"))
