"""Naive and seasonal-naive forecasters as state tables.

``fit`` returns a *state DataFrame* with one row per (keys, entity); every
key column (``fold_id``, a calibration length, ...) turns one fit into many
independent fits in the same plan. ``predict`` explodes each state row into
its forecast dates. The forecast starts after the last training date of the
whole key group (not of the entity), as the batch forecasters do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.functions import args as A
from demandgrid.constants import DATE_COL, ENTITY_COL, NAIVE_INTERVAL_WIDTH, TARGET_COL


def _key_last_date(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the key group's last training date to every state row.

    The per-key maximum is taken over the (small) state table, one row per
    key group; it joins back on the keys (or, without keys, via a scalar).
    """
    if not keys:
        return state.withColumn("last_date", state.agg(F.max("__entity_last")).scalar())
    last = state.groupBy(*keys).agg(F.max("__entity_last").alias("last_date"))
    return state.join(last, list(keys))


def naive_fit(train: DataFrame, keys: Sequence[str] = (), date_col: str = DATE_COL,
              entity_col: str = ENTITY_COL, target_col: str = TARGET_COL) -> DataFrame:
    """Last value per entity and the sample std of its first differences
    (0 when fewer than two differences)."""
    w = Window.partitionBy(*keys, entity_col).orderBy(date_col)
    diffs = train.withColumn("__d", (F.col(target_col) - F.lag(target_col, 1).over(w)).cast("double"))
    state = diffs.groupBy(*keys, entity_col).agg(
        F.max_by(F.col(target_col), F.col(date_col)).cast("double").alias("last_value"),
        F.when(F.count("__d") > 1, F.stddev_samp("__d")).otherwise(0.0).alias("resid_std"),
        F.max(date_col).alias("__entity_last"))
    return _key_last_date(state, keys).drop("__entity_last")


def seasonal_naive_fit(train: DataFrame, season: int = 7, keys: Sequence[str] = (),
                       date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                       target_col: str = TARGET_COL) -> DataFrame:
    """Last ``season`` values per entity (oldest first) and the sample std
    of the seasonal differences (0 when fewer than two).

    Only the last ``season`` rows enter ``collect_list``, so each group's
    list is bounded by the season length, whatever the history length.
    """
    A.at_least("season", season, 1)
    w = Window.partitionBy(*keys, entity_col).orderBy(date_col)
    wall = Window.partitionBy(*keys, entity_col)
    x = F.col(target_col).cast("double")
    feat = train.withColumns({
        "__ds": x - F.lag(target_col, season).over(w),
        "__rn": F.row_number().over(w),
        "__n": F.count(F.lit(1)).over(wall),
    })
    tail = F.when(F.col("__rn") > F.col("__n") - season, F.struct(F.col(date_col).alias("d"), x.alias("v")))
    state = feat.groupBy(*keys, entity_col).agg(
        F.transform(F.sort_array(F.collect_list(tail)), lambda s: s["v"]).alias("season_values"),
        F.when(F.count("__ds") > 1, F.stddev_samp("__ds")).otherwise(0.0).alias("resid_std"),
        F.count(F.lit(1)).alias("n_obs"),
        F.max(date_col).alias("__entity_last"))
    return _key_last_date(state, keys).drop("__entity_last")


def check_min_history(state: DataFrame, season: int, entity_col: str = ENTITY_COL) -> None:
    """Raise when an entity has fewer than ``season`` observations."""
    short = state.where(F.col("n_obs") < season).select(entity_col, "n_obs").limit(1).collect()
    if short:
        raise ValueError(f"history: {short[0][0]!r} has {short[0][1]} of the {season} days that a season needs")


def _explode_horizon(state: DataFrame, horizon, date_col: str) -> DataFrame:
    h = horizon if isinstance(horizon, Column) else F.lit(int(horizon))
    return state.select("*", F.posexplode(F.sequence(F.lit(0), h - 1)).alias("__k", "__k2")) \
        .withColumn(date_col, F.date_add(F.col("last_date"), F.col("__k") + 1)).drop("__k2")


def _with_interval(df: DataFrame, width: float) -> DataFrame:
    margin = F.lit(float(width)) * F.col("resid_std")
    return df.withColumns({"y_lower": F.greatest(F.lit(0.0), F.col("y_pred") - margin),
                           "y_upper": F.col("y_pred") + margin})


def naive_predict(state: DataFrame, horizon, keys: Sequence[str] = (),
                  interval_width: float = NAIVE_INTERVAL_WIDTH, date_col: str = DATE_COL,
                  entity_col: str = ENTITY_COL) -> DataFrame:
    """``horizon`` days after the key group's last date, flat at the last value.

    ``horizon`` is an int or a column of the state (e.g. per fold).
    """
    if isinstance(horizon, int):
        A.at_least("horizon", horizon, 1)
    out = _explode_horizon(state, horizon, date_col).withColumn("y_pred", F.col("last_value"))
    return _with_interval(out, interval_width).select(
        *keys, date_col, entity_col, "y_pred", "y_lower", "y_upper")


def seasonal_naive_predict(state: DataFrame, horizon, season: int = 7, keys: Sequence[str] = (),
                           interval_width: float = NAIVE_INTERVAL_WIDTH, date_col: str = DATE_COL,
                           entity_col: str = ENTITY_COL) -> DataFrame:
    """Cycle the last ``season`` values: day k takes value k mod season."""
    if isinstance(horizon, int):
        A.at_least("horizon", horizon, 1)
    out = _explode_horizon(state, horizon, date_col).withColumn(
        "y_pred", season_value(season))
    return _with_interval(out, interval_width).select(
        *keys, date_col, entity_col, "y_pred", "y_lower", "y_upper")


def future_grid(history: DataFrame, horizon: int, keys: Sequence[str] = (),
                date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                target_col: str = TARGET_COL) -> DataFrame:
    """Rows for the ``horizon`` days after the last date, every entity,
    target NULL (to be unioned to a history before featurising)."""
    state = history.groupBy(*keys, entity_col).agg(F.max(date_col).alias("__entity_last"))
    state = _key_last_date(state, keys).drop("__entity_last")
    return (_explode_horizon(state, horizon, date_col)
            .select(*keys, date_col, entity_col, F.lit(None).cast("long").alias(target_col)))


# ---------------------------------------------------------------------------
# Both baselines in one pass (used by backtests and calibration)
# ---------------------------------------------------------------------------
BASELINES = ("naive", "seasonal_naive")


def fit_baselines(train: DataFrame, season: int = 7, keys: Sequence[str] = (),
                  date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                  target_col: str = TARGET_COL) -> DataFrame:
    """Naive and seasonal-naive state from ONE window pass and ONE grouped
    aggregate per (keys, entity). When ``train`` is already hash-partitioned
    by ``keys + entity`` neither step shuffles."""
    A.at_least("season", season, 1)
    w = Window.partitionBy(*keys, entity_col).orderBy(date_col)
    wall = Window.partitionBy(*keys, entity_col)
    x = F.col(target_col).cast("double")
    feat = train.withColumns({
        "__d1": x - F.lag(target_col, 1).over(w),
        "__ds": x - F.lag(target_col, season).over(w),
        "__rn": F.row_number().over(w),
        "__n": F.count(F.lit(1)).over(wall),
    })
    tail = F.when(F.col("__rn") > F.col("__n") - season, F.struct(F.col(date_col).alias("d"), x.alias("v")))
    return feat.groupBy(*keys, entity_col).agg(
        F.max_by(x, F.col(date_col)).alias("last_value"),
        F.when(F.count("__d1") > 1, F.stddev_samp("__d1")).otherwise(0.0).alias("naive_std"),
        F.transform(F.sort_array(F.collect_list(tail)), lambda s: s["v"]).alias("season_values"),
        F.when(F.count("__ds") > 1, F.stddev_samp("__ds")).otherwise(0.0).alias("seasonal_std"),
        F.count(F.lit(1)).alias("n_obs"))


def season_value(season: int) -> Column:
    """The value of step ``__k``'s day of the season; an entity with a shorter
    history is an error that names the rule."""
    values = F.col("season_values")
    return F.when(F.size(values) < season, F.raise_error(F.concat(
        F.lit("history: an entity has "), F.size(values).cast("string"), F.lit(f" of the {season} days that a season needs"))).cast("double")
    ).otherwise(F.get(values, F.col("__k") % season))


def baseline_columns(season: int = 7, width: float = NAIVE_INTERVAL_WIDTH,
                     models: Sequence[str] = BASELINES) -> dict[str, Column]:
    """Per-model prediction columns for a row whose step index is ``__k``
    (0 = first day after the key group's last training date)."""
    out: dict[str, Column] = {}
    for m in models:
        if m == "naive":
            y, sd = F.col("last_value"), F.col("naive_std")
        elif m == "seasonal_naive":
            y, sd = season_value(season), F.col("seasonal_std")
        else:
            A.among("models", [m], BASELINES)
        margin = F.lit(float(width)) * sd
        out[f"y_pred_{m}"] = y
        out[f"y_lower_{m}"] = F.greatest(F.lit(0.0), y - margin)
        out[f"y_upper_{m}"] = y + margin
    return out


def score_rows(rows: DataFrame, state: DataFrame, key_info: DataFrame, season: int = 7,
               keys: Sequence[str] = (), models: Sequence[str] = BASELINES,
               width: float = NAIVE_INTERVAL_WIDTH, date_col: str = DATE_COL,
               entity_col: str = ENTITY_COL) -> DataFrame:
    """Evaluate the baselines at the dates of ``rows`` (e.g. test truth).

    Equivalent to forecasting ``horizon`` days after the key group's last
    training date and inner-joining the truth, without materialising the
    forecast grid: ``rows`` join the state on (keys, entity) and the step
    is ``datediff(date, last_date) - 1``, kept in [0, horizon).
    ``key_info(keys, last_date, horizon)`` has one row per key group (a
    parameter-sized table); without keys its one row comes as scalars.
    """
    j = rows.join(state, [*keys, entity_col])
    if keys:
        j = j.join(key_info, list(keys))
    else:
        j = j.withColumns({c: key_info.select(c).scalar() for c in ("last_date", "horizon")})
    j = j.withColumn("__k", F.datediff(F.col(date_col), F.col("last_date")) - 1)
    j = j.where((F.col("__k") >= 0) & (F.col("__k") < F.col("horizon")))
    return j.withColumns(baseline_columns(season, width, models)).drop(
        "__k", "last_value", "naive_std", "season_values", "seasonal_std", "n_obs", "last_date", "horizon")
