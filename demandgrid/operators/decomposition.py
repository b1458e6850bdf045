"""Additive decomposition forecaster, one fit per (keys, entity), from
sufficient statistics.

Re-aimed from a per-series Bayesian curve-fitting library: an additive
model ``trend + weekly + yearly + holiday`` on a piecewise-linear trend (hinge
functions at knots over the first 80% of the history), Fourier terms of period
7 and 365.25 days and a holiday indicator; predictions clipped at 0; an
``interval_width`` interval from the training-residual quantiles. A ridge term
holds all coefficients but the intercept; ``knot_penalty`` adds an absolute
(sparse) penalty on the slope changes, so that few knots bend the trend.
Numbers differ from the original library.

A fit needs only the normal equations ``X'X``, ``X'y`` of its group, and these
are sums over rows: rows are hash-partitioned by group once and streamed in
order, a task holds one pair of sums (about 1,500 numbers, whatever the length
of a history) and solves it when the group ends. Coefficients are an array
column; residuals, their exact quantiles and predictions are column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, FOLD_SPEC, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.functions import calendar as cal
from demandgrid.operators import folds as FO
from demandgrid.session import store

YEAR = 365.25
SWEEPS, SETTLED = 10_000, 1e-10        # of the coordinate descent


def knots(n: int) -> np.ndarray:
    """Places of the slope changes, as shares of the history's span."""
    return np.linspace(0, 0.8, n + 2)[1:-1]


def _waves(weekly: int, yearly: int) -> list[float]:
    """Angular speed per day of each Fourier pair."""
    return [2 * math.pi * k / 7.0 for k in range(1, weekly + 1)] + [2 * math.pi * k / YEAR for k in range(1, yearly + 1)]


def design(days: np.ndarray, span: np.ndarray, hol: np.ndarray, cps: np.ndarray, waves: Sequence[float]) -> np.ndarray:
    """One row per day: intercept, trend, hinges, Fourier pairs, holiday."""
    t = days / span
    cols = [np.ones_like(t), t] + [np.maximum(t - c, 0.0) for c in cps]
    for w in waves:
        cols += [np.sin(w * days), np.cos(w * days)]
    return np.column_stack([*cols, hol])


def _design_columns(days: Column, span: Column, hol: Column, cps: np.ndarray, waves: Sequence[float]) -> list[Column]:
    """The same row as column expressions."""
    t = days / span
    cols = [F.lit(1.0), t] + [F.greatest(t - F.lit(float(c)), F.lit(0.0)) for c in cps]
    for w in waves:
        cols += [F.sin(F.lit(w) * days), F.cos(F.lit(w) * days)]
    return [*cols, hol]


def solve(xx: np.ndarray, xy: np.ndarray, ridge: float, knot_penalty: float, n_knots: int) -> np.ndarray:
    """Coefficients that minimise ``½ b'(xx)b - b'(xy) + ½ ridge |b but b0|² +
    knot_penalty |slope changes|``. Without the absolute penalty a linear
    system; with it the other coefficients are eliminated exactly and the slope
    changes settle by coordinate descent with soft thresholds."""
    a = xx.copy()
    a[np.arange(1, len(a)), np.arange(1, len(a))] += ridge
    if knot_penalty == 0 or n_knots == 0:
        return np.linalg.solve(a, xy)
    k = np.arange(2, 2 + n_knots)
    o = np.setdiff1d(np.arange(len(a)), k)
    back = np.linalg.solve(a[np.ix_(o, o)], np.column_stack([a[np.ix_(o, k)], xy[o]]))
    s = a[np.ix_(k, k)] - a[np.ix_(k, o)] @ back[:, :-1]
    c = xy[k] - a[np.ix_(k, o)] @ back[:, -1]
    b = np.zeros(n_knots)
    rest = c.copy()                     # c - s b
    scale = max(float(np.abs(c).max()), 1.0)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(n_knots):
            z = rest[j] + s[j, j] * b[j]
            new = np.sign(z) * max(abs(z) - knot_penalty, 0.0) / s[j, j]
            if new != b[j]:
                rest -= s[:, j] * (new - b[j])
                moved = max(moved, abs(new - b[j]) * s[j, j])
                b[j] = new
        if moved <= SETTLED * scale:
            break
    beta = np.empty(len(a))
    beta[k], beta[o] = b, back[:, -1] - back[:, :-1] @ b
    return beta


def coefficients(history: DataFrame, keys: Sequence[str], n_changepoints: int, weekly: int, yearly: int, ridge: float,
                 knot_penalty: float, date_col: str, entity_col: str, target_col: str) -> DataFrame:
    """One row per (keys, entity): first day ``__d0``, ``__span`` in days and the
    coefficients ``__beta``. Rows without a date or target are left out."""
    groups = [*keys, entity_col]
    own = Window.partitionBy(*groups)
    rows = history.where(F.col(date_col).isNotNull() & F.col(target_col).isNotNull()).select(
        *groups, F.col(date_col).alias("__d"), F.col(target_col).cast("double").alias("__y"),
        cal.is_holiday(F.col(date_col)).cast("double").alias("__hol"))
    rows = rows.repartition(*groups).withColumns({"__d0": F.min("__d").over(own), "__d1": F.max("__d").over(own)})
    rows = rows.select(*groups, "__d0", F.greatest(F.datediff("__d1", "__d0"), F.lit(1)).cast("double").alias("__span"),
                       F.datediff("__d", "__d0").cast("double").alias("__day"), "__hol", "__y")
    cps, waves, size = knots(n_changepoints), _waves(weekly, yearly), len(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = xx = xy = None

        def done() -> pa.RecordBatch:
            beta = solve(xx, xy, ridge, knot_penalty, n_changepoints)
            return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(name, types)], pa.array([beta.tolist()])],
                                              [*titles, "__beta"])

        for batch in batches:
            types, titles = [c.type for c in batch.columns[:size + 2]], batch.schema.names[:size + 2]
            names = list(zip(*[c.to_pylist() for c in batch.columns[:size + 2]]))
            span, day, hol, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns[size + 1:])
            x = design(day, span, hol, cps, waves)
            starts = [0] + [i for i in range(1, len(names)) if names[i] != names[i - 1]] if names else []
            for a, b in zip(starts, [*starts[1:], len(names)]):
                if names[a] != name:
                    if name is not None:
                        yield done()
                    name, xx, xy = names[a], 0.0, 0.0
                xx, xy = xx + x[a:b].T @ x[a:b], xy + x[a:b].T @ y[a:b]
        if name is not None:
            yield done()

    ddl = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*groups, "__d0", "__span"])
    return rows.sortWithinPartitions(*groups, "__day").mapInArrow(run, f"{ddl}, __beta array<double>")


def fit_predict(history: DataFrame, future: DataFrame, keys: Sequence[str] = (),
                n_changepoints: int = 25, weekly: int = 3, yearly: int = 10, ridge: float = 1.0,
                interval: float = 0.8, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                target_col: str = TARGET_COL, knot_penalty: float = 0.0) -> DataFrame:
    """Fit on ``history`` rows and predict ``future`` rows (both keyed by
    ``keys + entity``); returns the future rows with y_pred / y_lower / y_upper.
    The numbers of knots and of weekly and yearly terms are the caller's, the
    same for every entity whatever its history (the ridge term keeps short ones
    solvable; ``yearly=0`` leaves the yearly terms out). Future rows of an
    entity without history are left out."""
    A.at_least("n_changepoints", n_changepoints, 0)
    A.at_least("knot_penalty", knot_penalty, 0)
    groups = [*keys, entity_col]
    # read twice (residuals, predictions): one stored row per group
    beta = store(coefficients(history, keys, n_changepoints, weekly, yearly, ridge, knot_penalty, date_col, entity_col, target_col))
    cps, waves = knots(n_changepoints), _waves(weekly, yearly)

    def fitted(df: DataFrame) -> DataFrame:
        day = F.datediff(F.col(date_col), F.col("__d0")).cast("double")
        terms = _design_columns(day, F.col("__span"), cal.is_holiday(F.col(date_col)).cast("double"), cps, waves)
        value = F.col("__beta")[0]
        for i, term in enumerate(terms[1:], 1):
            value = value + F.col("__beta")[i] * term
        return df.join(beta, groups).withColumn("__fit", value)

    tail = (1 - interval) / 2
    resid = fitted(history.select(*groups, date_col, target_col)).withColumn("__r", F.col(target_col).cast("double") - F.col("__fit"))
    # exact and partially aggregated; a group has at most a residual per day of its history
    bounds = resid.groupBy(*groups).agg(F.percentile("__r", F.array(F.lit(tail), F.lit(1 - tail))).alias("__q")).select(
        *groups, F.col("__q")[0].alias("__lo"), F.col("__q")[1].alias("__hi"))
    out = fitted(future.select(*groups, date_col)).join(bounds, groups)
    zero, yhat = F.lit(0.0), F.greatest(F.col("__fit"), F.lit(0.0))
    return out.select(*keys, date_col, entity_col, yhat.alias("y_pred"),
                      F.greatest(yhat + F.col("__lo"), zero).alias("y_lower"),
                      F.greatest(yhat + F.col("__hi"), zero).alias("y_upper"))


def backtest(panel: DataFrame, spec=FOLD_SPEC, date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
             target_col: str = TARGET_COL, **kw) -> DataFrame:
    """Every fold in one plan: fit per (fold_id, entity) on the fold's train
    rows, predict the fold's test dates (the horizon after the fold's last
    training date), join the truth."""
    assigned = FO.assign_folds(panel, spec, date_col=date_col)
    is_train = F.col("split") == "train"
    train = assigned.where(is_train)
    test = assigned.where(~is_train).select("fold_id", date_col, entity_col,
                                            F.col(target_col).cast("double").alias(target_col))
    info = assigned.groupBy("fold_id").agg(
        F.max(F.when(is_train, F.col(date_col))).alias("last_date"),
        F.count_distinct(F.when(~is_train, F.col(date_col))).cast("int").alias("horizon"))
    ents = train.select("fold_id", entity_col).distinct().join(info, "fold_id")
    future = ents.select("fold_id", entity_col, F.explode(F.sequence(
        F.date_add("last_date", 1), F.date_add("last_date", F.col("horizon")))).alias(date_col))
    pred = fit_predict(train, future, ["fold_id"], date_col=date_col, entity_col=entity_col,
                       target_col=target_col, **kw)
    return pred.join(test, ["fold_id", date_col, entity_col]).withColumn("model", F.lit("decomposition"))
