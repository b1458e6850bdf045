"""Training into a model store, and scoring from it.

``train_version`` runs the training flow up to a cut-off: a sibling model is
evaluated on the days before the cut-off, the production state and its interval
offsets come from the whole history, and both are published as a version.
``score_version`` serves requests from a version: it reads the state's rows and
the offsets, never the history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.functions import metrics as M
from demandgrid.operators import checks as CH
from demandgrid.operators import conformal as CF
from demandgrid.operators import forecast as FC
from demandgrid.operators import scoring as SC
from demandgrid.session import store
from demandgrid.sources.models import VERSION, ModelStore

SEASON = 7


def train_version(models: ModelStore, panel: DataFrame, version: str, cutoff: dt.date, holdout_days: int = 90,
                  calibration_days: int = 60, alpha: float = 0.1) -> None:
    """Train on ``panel`` up to ``cutoff`` and publish as ``version``. Too short a
    history, for the holdout or the calibration, is an error."""
    A.at_least("holdout_days", holdout_days, 1)
    history = panel.where(F.col(DATE_COL) <= F.lit(cutoff))
    sibling_end = cutoff - dt.timedelta(days=holdout_days)
    before, held = history.where(F.col(DATE_COL) <= F.lit(sibling_end)), history.where(F.col(DATE_COL) > F.lit(sibling_end))
    if before.isEmpty() or held.isEmpty():
        raise ValueError(f"panel: no days on both sides of {sibling_end}")
    sibling = FC.seasonal_naive_predict(FC.seasonal_naive_fit(before, SEASON), holdout_days, SEASON)
    # one row each: evaluation, offsets, size
    pairs = CH.one_to_one_join(held.select(DATE_COL, ENTITY_COL, TARGET_COL), store(sibling), [DATE_COL, ENTITY_COL])
    evaluation = store(pairs.agg(M.wape().alias("eval_wape"), M.mae().alias("eval_mae"), M.rmse().alias("eval_rmse"),
                                 F.count_distinct(DATE_COL).alias("eval_days")))
    offsets = store(CF.conformal_offsets(CF.calibration_residuals(history, calibration_days), alpha))
    state = store(FC.seasonal_naive_fit(history, SEASON))
    size = state.agg(F.count(F.lit(1)).alias("n_entities"), F.max("n_obs").alias("n_days"))
    info = size.withColumns({c: part.select(c).scalar() for part in (offsets, evaluation) for c in part.columns})
    models.publish(version, state, info.withColumns({"data_cutoff": F.lit(cutoff), "alpha": F.lit(float(alpha)),
                                                     "calibration_days": F.lit(calibration_days)}))


def score_version(models: ModelStore, requests: DataFrame, version: str | None = None) -> DataFrame:
    """Scored rows of the valid requests under ``version`` (by default the
    latest), with the version's name. A request is checked against the version's
    own cut-off and entities."""
    version = version or models.latest()
    info, state = models.info(version), models.state(version)
    cutoff = info.select("data_cutoff").first()[0]
    checked = store(SC.validate_requests(requests, cutoff, state))
    horizon = max(SC.forecast_horizon(checked, cutoff), 1)
    forecast = CF.apply_offsets(FC.seasonal_naive_predict(state, horizon, SEASON), info)
    return SC.score_requests(forecast, checked).select(F.lit(version).alias(VERSION), "*")
