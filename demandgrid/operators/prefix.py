"""Baselines fitted on many prefixes of one history, in one pass.

Every fold's training part, and the fit part of every calibration length, is a
prefix of the same history. What a baseline needs to know of a prefix (last
values, spread of the differences, row count) is the running state at the
prefix's last row, so one ordered pass per entity yields all of them: the
history is hash-partitioned by entity once, never copied per prefix, and the
rows to be scored find the state of their prefix in the same pass, without a
join.

A prefix is ``(key, cut, first, last)``: its rows are those up to ``cut``, and
rows from ``first`` to ``last`` (after ``cut``) are scored with its state.
Dates are columns, so a cut may depend on the history (its last day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, NAIVE_INTERVAL_WIDTH, TARGET_COL
from demandgrid.functions import args as A
from demandgrid.operators import forecast as FC
from demandgrid.operators.checks import require_columns

Prefixes = Sequence[tuple[int, Column, Column, Column]]
STATE = ("last_value", "naive_std", "season_values", "seasonal_std", "n_obs")


def running_states(history: DataFrame, season: int = 7, date_col: str = DATE_COL,
                   entity_col: str = ENTITY_COL, target_col: str = TARGET_COL,
                   out_col: str = "state") -> DataFrame:
    """``history`` with the state of both baselines up to and including each row
    (the struct of :data:`STATE`): running frames over one sort per entity, so
    a task keeps ``season`` values and a few sums, whatever the length."""
    A.at_least("season", season, 1)
    require_columns(history, [date_col, entity_col, target_col])
    w = Window.partitionBy(entity_col).orderBy(date_col)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.col(target_col).cast("double")
    steps = history.withColumns({"__d1": x - F.lag(x, 1).over(w), "__ds": x - F.lag(x, season).over(w)})

    def spread(c):
        return F.when(F.count(c).over(upto) > 1, F.stddev_samp(c).over(upto)).otherwise(0.0)

    return steps.withColumn(out_col, F.struct(
        x.alias("last_value"), spread("__d1").alias("naive_std"),
        F.collect_list(x).over(w.rowsBetween(1 - season, Window.currentRow)).alias("season_values"),
        spread("__ds").alias("seasonal_std"),
        F.count(F.lit(1)).over(upto).alias("n_obs"))).drop("__d1", "__ds")


def _bounds(history: DataFrame, prefixes: Prefixes, date_col: str) -> Column:
    """Last date and number of scored days of each prefix, over all entities: one
    row from the distinct days. A prefix without a day on either side is an error."""
    d = F.col(date_col)

    def one(key, cut, first, last):
        ends, days = F.max(F.when(d <= cut, d)), F.count_if(d.between(first, last)).cast("int")
        return F.struct(
            F.when(ends.isNull(), F.raise_error(F.lit(f"history: no train rows for {key}")).cast("date")).otherwise(ends).alias("last_date"),
            F.when(days == 0, F.raise_error(F.lit(f"history: no test rows for {key}")).cast("int")).otherwise(days).alias("horizon"))

    days = history.groupBy(date_col).agg(F.first("__end").alias("__end"))
    return days.agg(F.array(*[one(*p) for p in prefixes])).scalar()


def score_prefixes(history: DataFrame, prefixes, key_col: str, season: int = 7,
                   models: Sequence[str] = FC.BASELINES, width: float = NAIVE_INTERVAL_WIDTH,
                   date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                   target_col: str = TARGET_COL) -> DataFrame:
    """One row per (prefix, scored row): the truth and every model's prediction
    and interval from the prefix's state. Entities without a row in a prefix are
    not scored for it. ``prefixes`` is a list, or a function that makes it from
    the column of the history's last day."""
    require_columns(history, [date_col, entity_col, target_col])
    base = history.select(date_col, entity_col, target_col)
    base = base.withColumn("__end", base.agg(F.max(date_col)).scalar())
    chosen = prefixes(F.col("__end")) if callable(prefixes) else prefixes
    A.some("prefixes", chosen)
    d = F.col(date_col)
    seen = Window.partitionBy(entity_col).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = running_states(base, season, date_col, entity_col, target_col, "__state")
    rows = rows.withColumns({f"__s{i}": F.last(F.when(d <= cut, F.col("__state")), ignorenulls=True).over(seen)
                             for i, (_, cut, _, _) in enumerate(chosen)})
    rows = rows.withColumn("__bounds", _bounds(base, chosen, date_col))
    cases = F.array(*[F.struct(F.lit(key).alias("key"), d.between(first, last).alias("hit"), F.col(f"__s{i}").alias("state"),
                               F.col("__bounds")[i].alias("bound")) for i, (key, _, first, last) in enumerate(chosen)])
    hits = rows.select(date_col, entity_col, F.col(target_col).cast("double").alias(target_col),
                       F.explode(F.filter(cases, lambda c: c["hit"] & c["state"].isNotNull())).alias("__c"))
    flat = hits.select(F.col("__c.key").alias(key_col), date_col, entity_col, target_col,
                       *[F.col(f"__c.state.{s}").alias(s) for s in STATE],
                       (F.datediff(d, F.col("__c.bound.last_date")) - 1).alias("__k"), F.col("__c.bound.horizon").alias("__h"))
    flat = flat.where((F.col("__k") >= 0) & (F.col("__k") < F.col("__h")))
    return flat.withColumns(FC.baseline_columns(season, width, models)).drop("__k", "__h", *STATE)
