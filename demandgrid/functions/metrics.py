"""Forecast-error aggregate expressions (use inside ``agg``).

Grouped WAPE is NULL for a group whose truth sums to zero; ``strict_wape`` and
``strict_metrics`` raise instead, also on no rows at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import args as A


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def abs_error_sum(y, yhat) -> Column:
    return F.sum(F.abs(_c(y) - _c(yhat)))


def wape(y="n_shipments", yhat="y_pred") -> Column:
    """sum|y - yhat| / sum|y|; NULL when sum|y| = 0."""
    den = F.sum(F.abs(_c(y)))
    return F.try_divide(abs_error_sum(y, yhat), F.nullif(den, F.lit(0)))


def strict_wape(y="n_shipments", yhat="y_pred") -> Column:
    """WAPE that fails, when evaluated, on no rows or a truth that sums to 0."""
    return F.coalesce(wape(y, yhat), F.raise_error(F.lit("wape: the truth is empty or sums to zero")).cast("double"))


def strict_metrics(df: DataFrame, y="n_shipments", yhat="y_pred") -> DataFrame:
    """One row of WAPE, MAE, RMSE and bias of all of ``df``, strict."""
    return df.agg(strict_wape(y, yhat).alias("wape"), mae(y, yhat).alias("mae"), rmse(y, yhat).alias("rmse"),
                  bias(y, yhat).alias("bias"))


def mae(y="n_shipments", yhat="y_pred") -> Column:
    return F.avg(F.abs(_c(y) - _c(yhat)))


def rmse(y="n_shipments", yhat="y_pred") -> Column:
    return F.sqrt(F.avg(F.pow(_c(y) - _c(yhat), 2)))


def bias(y="n_shipments", yhat="y_pred") -> Column:
    """mean(yhat - y): positive = over-prediction."""
    return F.avg(_c(yhat) - _c(y))


def under_units(y, yhat) -> Column:
    """Row-level max(0, y - yhat)."""
    return F.greatest(_c(y) - _c(yhat), F.lit(0.0))


def over_units(y, yhat) -> Column:
    """Row-level max(0, yhat - y)."""
    return F.greatest(_c(yhat) - _c(y), F.lit(0.0))


def asymmetric_cost(y, yhat, c_under: float, c_over: float) -> Column:
    """c_under * sum max(0, y - yhat) + c_over * sum max(0, yhat - y)."""
    A.all_at_least("costs", (c_under, c_over), 0)
    return (F.lit(float(c_under)) * F.sum(under_units(y, yhat))
            + F.lit(float(c_over)) * F.sum(over_units(y, yhat)))


def metric_columns(y="n_shipments", yhat="y_pred") -> list[Column]:
    return [wape(y, yhat).alias("wape"), mae(y, yhat).alias("mae"),
            rmse(y, yhat).alias("rmse"), bias(y, yhat).alias("bias"),
            F.count(F.lit(1)).alias("n_rows")]
