"""Batch scoring of forecast requests with cost-aware recommendations.

Requests are rows of a table (id, window, entities, alpha, cost ratio,
flags). One forecast up to the largest horizon serves every request; each
request's window is exploded to its dates (at most 90 by the request
rules) and equi-joined to the forecast, so there is no range join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.constants import (ALPHA_RANGE, COST_RATIO_RANGE, DATE_COL, DEFAULT_ALPHA,
                                  DEFAULT_COST_RATIO, ENTITY_COL, MAX_WINDOW_DAYS)

REQUEST_SCHEMA = ("request_id string, start_date date, end_date date, entities array<string>, "
                  "alpha double, cost_ratio double, include_intervals boolean, "
                  "include_cost_aware boolean")


def requests_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), REQUEST_SCHEMA)


def recommended(y_pred="y_pred", y_lower="y_lower", y_upper="y_upper", alpha="alpha") -> Column:
    """alpha >= 0: y + alpha * (upper - y); alpha < 0: y + alpha * (y - lower);
    floored at 0."""
    c = lambda x: x if isinstance(x, Column) else F.col(x)
    a, y, lo, hi = c(alpha), c(y_pred), c(y_lower), c(y_upper)
    margin = F.when(a >= 0, hi - y).otherwise(y - lo)
    return F.greatest(F.lit(0.0), y + a * margin)


def resolve_cost_params(requests: DataFrame, default_alpha: float = DEFAULT_ALPHA,
                        default_ratio: float = DEFAULT_COST_RATIO) -> DataFrame:
    """Resolved alpha / cost ratio and where each came from; all NULL when
    the cost-aware output is off."""
    on = F.col("include_cost_aware")
    src = lambda c: F.when(on, F.when(F.col(c).isNotNull(), "request").otherwise("server_default"))
    return requests.withColumns({
        "alpha_used": F.when(on, F.coalesce(F.col("alpha"), F.lit(float(default_alpha)))),
        "alpha_source": src("alpha"),
        "cost_ratio_used": F.when(on, F.coalesce(F.col("cost_ratio"), F.lit(float(default_ratio)))),
        "cost_ratio_source": src("cost_ratio"),
    })


def validate_requests(requests: DataFrame, last_train_date, known_entities: DataFrame,
                      entity_col: str = ENTITY_COL) -> DataFrame:
    """Adds ``reason`` (NULL when valid): window order and length, alpha and
    ratio ranges, window after the training end, unknown entities (an
    anti join of the exploded request entities against the known ones)."""
    last = last_train_date if isinstance(last_train_date, Column) else F.lit(last_train_date)
    a_lo, a_hi = ALPHA_RANGE
    r_lo, r_hi = COST_RATIO_RANGE
    asked = requests.select("request_id", F.explode_outer("entities").alias(entity_col)) \
        .where(F.col(entity_col).isNotNull())
    unknown = (asked.join(known_entities.select(entity_col).distinct(), entity_col, "left_anti")
               .groupBy("request_id").agg(F.sort_array(F.collect_set(entity_col)).alias("__unknown")))
    checked = requests.join(unknown, "request_id", "left")
    reason = (F.when(F.col("end_date") < F.col("start_date"), "end_date before start_date")
              .when(F.datediff("end_date", "start_date") + 1 > MAX_WINDOW_DAYS,
                    f"window longer than {MAX_WINDOW_DAYS} days")
              .when(F.col("alpha").isNotNull() & ~F.col("alpha").between(a_lo, a_hi), "alpha out of range")
              .when(F.col("cost_ratio").isNotNull() & ~F.col("cost_ratio").between(r_lo, r_hi),
                    "cost_ratio out of range")
              .when(F.col("start_date") <= last, "start_date not after last training date")
              .when(F.col("__unknown").isNotNull(),
                    F.concat(F.lit("unknown entities: "), F.array_join("__unknown", ","))))
    return checked.withColumn("reason", reason).drop("__unknown")


def score_requests(forecast: DataFrame, requests: DataFrame, date_col: str = DATE_COL,
                   entity_col: str = ENTITY_COL, default_alpha: float = DEFAULT_ALPHA,
                   default_ratio: float = DEFAULT_COST_RATIO) -> DataFrame:
    """One output row per (valid request, date in its window, entity kept by
    its filter): point, optional interval, optional recommendation, the
    parameters used and their source."""
    req = resolve_cost_params(requests.where(F.col("reason").isNull()), default_alpha, default_ratio)
    days = req.withColumn(date_col, F.explode(F.sequence("start_date", "end_date")))
    # No broadcast hint: the request table has no proven size bound, so
    # Spark's measured-size rule (and AQE at run time) picks the strategy.
    # Requests that name entities join on (date, entity), so they meet only the
    # rows they asked for; the others join on the date, as they take all rows.
    named = F.size(F.coalesce("entities", F.array())) > 0
    some = days.where(named).withColumn(entity_col, F.explode(F.array_distinct("entities")))
    j = forecast.join(days.where(~named), date_col).unionByName(forecast.join(some, [date_col, entity_col]))
    iv = F.col("include_intervals")
    return j.select(
        "request_id", F.col(date_col).alias("date"), F.col(entity_col).alias("entity"),
        F.col("y_pred").alias("point"),
        F.when(iv, F.col("y_lower")).alias("lower_90"),
        F.when(iv, F.col("y_upper")).alias("upper_90"),
        F.when(F.col("include_cost_aware"), recommended(alpha="alpha_used")).alias("recommended"),
        "alpha_used", "cost_ratio_used", "alpha_source", "cost_ratio_source")


def forecast_horizon(checked: DataFrame, last_train_date: dt.date) -> int:
    """Days from the training end to the latest end date of the valid requests
    (0 without any): one number from the small request table."""
    row = checked.where(F.col("reason").isNull()).agg(F.max(F.datediff("end_date", F.lit(last_train_date)))).first()
    return int(row[0] or 0)


def alpha_sweep(forecast: DataFrame, alphas: Sequence[float]) -> DataFrame:
    """The recommendation under several alphas side by side (long form)."""
    return forecast.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas]))) \
        .withColumn("recommended", recommended())


def day_snapshot(scored: DataFrame, day: dt.date, value: str = "recommended",
                 entity_col: str = "entity", date_col: str = "date") -> DataFrame:
    """All entities on one day, highest ``value`` first."""
    return scored.where(F.col(date_col) == F.lit(day)).orderBy(F.col(value).desc(), F.col(entity_col))
