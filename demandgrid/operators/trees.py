"""Pooled boosted-tree forecaster (Spark ML GBT, absolute loss) with a
recursive multi-step forecast.

Fit: the default 23-feature table on operational rows without NULL
features, ``GBTRegressor(lossType="absolute")`` (distributed training).

Recursive forecast: every feature is entity-local (own lags / trailing
stats, own volume) or a calendar function of the date, so entities are
independent. Calendar, holiday, event, trend and volume columns of the
future days are computed by Spark; the days are then folded per entity over
an array of its last ``TAIL`` values (``operators.ensemble``): lags and trailing
stats from the state, the ensemble's sum, 0 on non-operational days, clip at 0,
append. The node table (read from the fitted model's printed form) is bounded by
``maxIter x 2^(maxDepth+1)`` nodes.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid import constants as K
from demandgrid.functions import args as A
from demandgrid.operators import boosting as B
from demandgrid.operators import ensemble as EN
from demandgrid.operators import features as X
from demandgrid.operators import forecast as FC

# Feature order of the model (the 23 canonical features).
MODEL_FEATURES = (
    "lag_7", "lag_14", "rolling_mean_7", "rolling_std_7", "day_of_week", "month", "is_weekend",
    "is_month_start", "is_month_end", "is_holiday", "is_business_day", "is_saturday", "is_sunday",
    "days_to_black_friday", "is_black_friday_window", "is_post_black_friday_peak",
    "days_to_dia_dos_namorados", "is_dia_dos_namorados_window", "is_post_dia_dos_namorados_peak",
    "days_since_start", "year_progress", "state_avg_volume", "volume_tier",
)
RECURSIVE = ("lag_7", "lag_14", "rolling_mean_7", "rolling_std_7")
TAIL = 14   # largest lag; covers the 7-row trailing window


@dataclass
class GBTParams:
    max_iter: int = 50
    max_depth: int = 5
    step_size: float = 0.1
    subsampling_rate: float = 1.0
    feature_subset: str = "all"
    min_instances: int = 1
    min_info_gain: float = 0.0
    seed: int = 42
    validation_tol: float = 0.01
    extra: dict = field(default_factory=dict)

    def estimator(self, validation_col: str | None = None) -> GBTRegressor:
        est = GBTRegressor(
            featuresCol="features", labelCol=K.TARGET_COL, predictionCol="y_pred", lossType="absolute",
            maxIter=self.max_iter, maxDepth=self.max_depth, stepSize=self.step_size,
            subsamplingRate=self.subsampling_rate, featureSubsetStrategy=self.feature_subset,
            minInstancesPerNode=self.min_instances, minInfoGain=self.min_info_gain, seed=self.seed,
            maxBins=64, validationTol=self.validation_tol)
        if validation_col:
            est = est.setValidationIndicatorCol(validation_col)
        return est


def numeric_features(df: DataFrame) -> DataFrame:
    """Feature columns as doubles; ``volume_tier`` as its ordinal."""
    cols = {c: F.col(c).cast("double") for c in MODEL_FEATURES if c != "volume_tier"}
    cols["volume_tier"] = X.tier_ordinal("volume_tier").cast("double")
    return df.withColumns(cols)


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features", handleInvalid="error")


def training_table(history: DataFrame, keys: Sequence[str] = (),
                   thresholds=K.DEFAULT_TIER_THRESHOLDS, reference_date=K.TREND_REFERENCE_DATE,
                   stats: DataFrame | None = None) -> DataFrame:
    """Featurised operational rows with every feature present."""
    stats = stats if stats is not None else X.volume_stats(history, keys)
    feats = X.default_pipeline(stats, keys, thresholds, reference_date).transform(history)
    feats = numeric_features(feats.where(F.col("is_operational") == 1))
    return feats.na.drop(subset=list(MODEL_FEATURES))


@dataclass
class TreeForecaster:
    model: GBTRegressionModel | B.Boosted
    stats: DataFrame
    thresholds: tuple
    reference_date: dt.date


@dataclass
class TrainingData:
    """Assembled, materialized training rows of one history (+ the inputs a
    forecaster needs besides the fitted model). Independent of the tree
    parameters, so a search prepares it once per fold for all its trials."""
    table: DataFrame
    stats: DataFrame
    thresholds: tuple
    reference_date: dt.date
    validation: bool


def prepare(history: DataFrame, thresholds=K.DEFAULT_TIER_THRESHOLDS,
            reference_date=K.TREND_REFERENCE_DATE, validation: DataFrame | None = None) -> TrainingData:
    """Featurise and assemble ``history``; ``validation`` rows (featurised
    with the same train statistics) are flagged for early stopping."""
    stats = X.volume_stats(history)
    if validation is not None:
        both = history.withColumn("__val", F.lit(False)).unionByName(validation.withColumn("__val", F.lit(True)))
        table = training_table(both, (), thresholds, reference_date, stats)
    else:
        table = training_table(history, (), thresholds, reference_date, stats)
    # Materialize the assembled table once: boosting scans it every round.
    from demandgrid.operators.panel import materialize
    cols = ["features", K.TARGET_COL] + (["__val"] if validation is not None else [])
    data = materialize(assembler().transform(table).select(*cols))
    return TrainingData(data, stats, thresholds, reference_date, validation is not None)


def fit_prepared(data: TrainingData, params: GBTParams = GBTParams()) -> TreeForecaster:
    est = params.estimator("__val" if data.validation else None)
    return TreeForecaster(est.fit(data.table), data.stats, data.thresholds, data.reference_date)


def fit(history: DataFrame, params: GBTParams = GBTParams(), thresholds=K.DEFAULT_TIER_THRESHOLDS,
        reference_date=K.TREND_REFERENCE_DATE, validation: DataFrame | None = None) -> TreeForecaster:
    """Train on ``history``; ``validation`` rows (featurised with the same
    train statistics) drive early stopping."""
    return fit_prepared(prepare(history, thresholds, reference_date, validation), params)


@dataclass
class FoldData:
    """Binned training rows of one or more histories and the inputs that a
    forecast of each needs besides the model."""
    blocks: B.Blocks
    sources: dict[int, TrainingData]

    def forecaster(self, fold: int, model: B.Boosted) -> TreeForecaster:
        src = self.sources[fold]
        return TreeForecaster(model, src.stats, src.thresholds, src.reference_date)


def prepare_folds(histories: dict[int, tuple[DataFrame, DataFrame | None]], thresholds=K.DEFAULT_TIER_THRESHOLDS,
                  reference_date=K.TREND_REFERENCE_DATE, bins: int = 64) -> FoldData:
    """Featurise, bin and store ``{fold: (history, validation or None)}`` for
    histogram boosting; validation rows (featurised with the history's statistics)
    only measure the loss that the patience watches."""
    tables, sources = None, {}
    for fold, (history, validation) in histories.items():
        stats = X.volume_stats(history)
        both = history.withColumn("__val", F.lit(False))
        if validation is not None:
            both = both.unionByName(validation.withColumn("__val", F.lit(True)))
        rows = training_table(both, (), thresholds, reference_date, stats).select(
            F.lit(fold).alias("__fold"), "__val", K.TARGET_COL, *MODEL_FEATURES)
        tables = rows if tables is None else tables.unionByName(rows)
        sources[fold] = TrainingData(rows, stats, thresholds, reference_date, validation is not None)
    return FoldData(B.pack(tables, MODEL_FEATURES, K.TARGET_COL, "__fold", "__val", bins), sources)


def fit_boosted(history: DataFrame, params: B.Params = B.Params(), thresholds=K.DEFAULT_TIER_THRESHOLDS,
                reference_date=K.TREND_REFERENCE_DATE, validation: DataFrame | None = None) -> TreeForecaster:
    """Histogram boosting on ``history`` (absolute loss, leaf penalties); with
    ``validation`` rows it stops when ``params.patience`` rounds bring nothing and
    keeps the best round (``model.rounds_used``, ``model.rounds_run``)."""
    data = prepare_folds({0: (history, validation)}, thresholds, reference_date)
    return data.forecaster(0, B.fit_many(data.blocks, [(0, params)])[0])


def tree_table(model: GBTRegressionModel) -> dict:
    """Node arrays of every tree (+ weights), from the fitted model's printed
    form (a tree's lines are its nodes in pre-order; all splits compare a
    feature with a number)."""
    trees: list[tuple] = []
    lines = iter(model.toDebugString.splitlines()[1:])
    split = re.compile(r"If \(feature (\d+) <= (\S+)\)")

    def read(nodes: list[list]) -> int:
        line = next(lines).strip()
        at = len(nodes)
        if line.startswith("Predict:"):
            nodes.append([0, 0.0, -1, -1, float(line.split(":")[1])])
            return at
        m = split.match(line)
        nodes.append([int(m[1]), float(m[2]), -1, -1, 0.0])
        nodes[at][2] = read(nodes)
        next(lines)                     # the matching "Else" line
        nodes[at][3] = read(nodes)
        return at

    for _ in range(model.getNumTrees):
        next(lines)                     # "Tree k (weight w):"
        nodes: list[list] = []
        read(nodes)
        feat, thr, left, right, pred = zip(*nodes)
        trees.append((np.array(feat, np.int64), np.array(thr), np.array(left, np.int64), np.array(right, np.int64), np.array(pred)))
    return {"trees": trees, "weights": np.asarray(model.treeWeights, dtype=np.float64)}


def score_table(table: dict, x: np.ndarray) -> np.ndarray:
    """Ensemble prediction for rows of ``x`` (continuous splits: x <= thr -> left)."""
    out = np.zeros(x.shape[0])
    rows = np.arange(x.shape[0])
    for (feat, thr, left, right, pred), w in zip(table["trees"], table["weights"]):
        node = np.zeros(x.shape[0], dtype=np.int64)
        active = left[node] >= 0
        while active.any():
            n = node[active]
            go_left = x[rows[active], feat[n]] <= thr[n]
            node[active] = np.where(go_left, left[n], right[n])
            active = left[node] >= 0
        out += w * pred[node]
    return out


def forecast_inputs(source, history: DataFrame, horizon: int, date_col: str = K.DATE_COL,
                    entity_col: str = K.ENTITY_COL, target_col: str = K.TARGET_COL) -> DataFrame:
    """Each entity's last ``TAIL`` days plus the ``horizon`` future days with
    every non-recursive feature computed by Spark. ``source`` (a
    :class:`TreeForecaster` or :class:`TrainingData`) gives the volume stats,
    thresholds and trend anchor; the tree parameters play no part, so a
    search builds this once per fold."""
    A.at_least("horizon", horizon, 1)
    future = FC.future_grid(history, horizon, date_col=date_col, entity_col=entity_col, target_col=target_col)
    w = Window.partitionBy(entity_col).orderBy(F.col(date_col).desc())
    tail = (history.select(date_col, entity_col, target_col)
            .withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= TAIL).drop("__rn"))
    both = tail.withColumn("__future", F.lit(0)).unionByName(future.withColumn("__future", F.lit(1)))
    # Event candidates: years of history U future, as when the pipeline runs on both.
    years = history.select(date_col).unionByName(future.select(date_col))
    yrs = years.agg(F.sort_array(F.collect_set(F.year(date_col)))).scalar()
    feats = X.add_holiday_features(both, date_col)
    feats = X.add_event_features(feats, date_col=date_col, years=yrs)
    feats = feats.withColumns(X.trend_columns(source.reference_date, date_col))
    feats = feats.withColumns(X.calendar_columns(date_col))
    feats = X.add_volume_features(feats, source.stats, (), source.thresholds, 0.0, entity_col)
    feats = numeric_features(feats.withColumns({c: F.lit(None).cast("double") for c in RECURSIVE}))
    return feats.select(date_col, entity_col, target_col, "__future", "is_operational", *MODEL_FEATURES)


def recursive_forecast(fc: TreeForecaster, history: DataFrame, horizon: int,
                       date_col: str = K.DATE_COL, entity_col: str = K.ENTITY_COL,
                       target_col: str = K.TARGET_COL, inputs: DataFrame | None = None) -> DataFrame:
    """``horizon`` days after the last date of ``history`` for every entity
    (``inputs``: a prebuilt :func:`forecast_inputs` frame for this history
    and horizon)."""
    A.at_least("horizon", horizon, 1)
    table = fc.model.table() if isinstance(fc.model, B.Boosted) else tree_table(fc.model)
    feats = inputs if inputs is not None else forecast_inputs(fc, history, horizon, date_col, entity_col,
                                                              target_col)
    return EN.walk(feats, EN.ensemble_value(history.sparkSession, table), MODEL_FEATURES, TAIL, date_col, entity_col, target_col)


def feature_importance(fc: TreeForecaster, spark: SparkSession) -> DataFrame:
    """Importance per feature and its share of the total, ranked."""
    imp = (fc.model.importance(len(MODEL_FEATURES)) if isinstance(fc.model, B.Boosted) else fc.model.featureImportances.toArray()).tolist()
    total = sum(imp) or 1.0
    rows = [(f, float(v), 100.0 * float(v) / total) for f, v in zip(MODEL_FEATURES, imp)]
    return spark.createDataFrame(rows, "feature string, importance double, share_pct double")
