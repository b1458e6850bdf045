"""demandgrid: daily demand panels, features, backtests, intervals and
cost analysis expressed as Spark DataFrame plans.

Layout
------
sources/    table reads, sinks, model-state persistence, profiling
functions/  column-expression building blocks (calendar, metrics, quantiles,
            argument checks)
operators/  DataFrame -> DataFrame operators (panel, windows, features,
            folds, forecasters, conformal, evaluation, costs, scoring)
plans/      named end-to-end queries and their DuckDB oracle SQL
llm/        operators for large training-data pipelines (optional)
"""

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL

__all__ = ["DATE_COL", "ENTITY_COL", "TARGET_COL"]
__version__ = "0.1.0"
