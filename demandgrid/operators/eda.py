"""Exploratory aggregates over a daily panel (all one-pass groupBy plans)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.constants import DATE_COL, ENTITY_COL, TARGET_COL

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def national_total(panel: DataFrame, date_col: str = DATE_COL,
                   target_col: str = TARGET_COL) -> DataFrame:
    """Sum over entities per day."""
    return panel.groupBy(date_col).agg(F.sum(target_col).cast("long").alias("total"))


def monthly_summary(daily: DataFrame, value: str = "total", date_col: str = DATE_COL) -> DataFrame:
    """Per month: days, mean per day (1 decimal) and total."""
    return daily.groupBy(F.date_format(date_col, "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_days"), F.round(F.avg(value), 1).alias("mean_per_day"),
        F.sum(value).cast("long").alias("total"))


def weekday_stats(daily: DataFrame, value: str = "total", date_col: str = DATE_COL) -> DataFrame:
    """Per weekday (Monday = 0): mean, median, sample std, days."""
    return daily.groupBy(F.weekday(date_col).alias("dow_num"),
                         F.date_format(date_col, "EEEE").alias("dow_name")).agg(
        F.avg(value).alias("avg_value"), F.median(value).alias("median_value"),
        F.stddev_samp(value).alias("std_value"), F.count(F.lit(1)).alias("n_days"))


def share_of_peak(stats: DataFrame, value: str = "avg_value") -> DataFrame:
    """Each row's value as % of the largest (a lazy scalar subquery)."""
    peak = stats.agg(F.max(value)).scalar()
    return stats.withColumn("pct_of_peak", F.lit(100.0) * F.col(value) / peak)


def group_stats(df: DataFrame, group_col: str, value: str = "total") -> DataFrame:
    """Per group: n, mean, median, min, max."""
    return df.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_days"), F.avg(value).alias("avg_value"),
        F.median(value).alias("median_value"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation), max."""
    q = F.percentile(F.col(col).cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).cast("double").alias("min"), q[0].alias("p25"), q[1].alias("p50"),
                  q[2].alias("p75"), F.max(col).cast("double").alias("max"))


def retained_share(df: DataFrame, predicate, value: str = "total") -> DataFrame:
    """Share of the total kept by ``predicate``."""
    return df.agg((F.sum(F.when(predicate, F.col(value)).otherwise(0)) / F.sum(value)).alias("share"),
                  F.count_if(predicate).alias("n_kept"), F.count(F.lit(1)).alias("n_total"))


def month_weekday_matrix(daily: DataFrame, value: str = "total", date_col: str = DATE_COL,
                         weekdays: Sequence[str] = WEEKDAYS[:6]) -> DataFrame:
    """Mean per (year-month, weekday name), one column per weekday in fixed
    order; missing cells NULL."""
    return (daily.withColumns({"year_month": F.date_format(date_col, "yyyy-MM"),
                               "dow_name": F.date_format(date_col, "EEEE")})
            .groupBy("year_month").pivot("dow_name", list(weekdays)).agg(F.avg(value)))


def zero_days(panel: DataFrame, target_col: str = TARGET_COL) -> DataFrame:
    return panel.where(F.col(target_col) == 0)
