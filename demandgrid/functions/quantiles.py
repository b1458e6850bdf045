"""Exact quantiles (linear interpolation between order statistics) per key
group without holding a group's values in one task.

Values are counted first (one row per distinct value, so ties cost nothing).
Approximate quantiles of the distinct values cut each group into ``slices``;
running counts over the slices (a row each) and then within each slice (one
task holds about 1 / slices of a group's distinct values) give every value's
cumulative count, from which the order statistics are read. The cuts decide
only how rows are dealt, never a result, and there is one way for all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.functions import args as A


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    keys: Sequence[str] = (), slices: int = 256,
                    out_cols: Sequence[str] | None = None, count_col: str | None = None) -> DataFrame:
    """One row per key group (without keys: one row) with the quantiles
    ``out_cols`` and the number of non-null values ``count_col``."""
    probs = [float(p) for p in probs]
    A.all_at_least("probs", [min(p, 1 - p) for p in probs], 0)
    A.at_least("slices", slices, 2)
    names = list(out_cols) if out_cols else [f"q_{i}" for i in range(len(probs))]
    ks = list(keys)
    x = F.col("__x")
    counts = (df.select(*ks, F.col(value_col).cast("double").alias("__x")).where(x.isNotNull())
              .groupBy(*ks, "__x").agg(F.count(F.lit(1)).alias("__c")))
    cuts = F.percentile_approx("__x", F.array(*[F.lit(i / slices) for i in range(1, slices)]), 20 * slices)
    groups = counts.groupBy(*ks).agg(F.sum("__c").alias("__n"), cuts.alias("__cuts"))
    if ks:
        dealt = counts.join(groups, ks)
    else:
        dealt = counts.withColumns({c: groups.select(c).scalar() for c in ("__n", "__cuts")})
    dealt = dealt.withColumn("__slice", F.size(F.filter("__cuts", lambda c: c < x))).drop("__cuts")
    before = Window.partitionBy(*ks).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice: at most ``slices`` rows of a group meet in this window
    sizes = dealt.groupBy(*ks, "__slice").agg(F.sum("__c").alias("__s"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s")
    inside = Window.partitionBy(*ks, "__slice").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    upto = dealt.join(sizes, [*ks, "__slice"]).withColumn("__upto", F.col("__before") + F.sum("__c").over(inside))
    aggs, out = [F.first("__n").alias("__n")], []
    for i, p in enumerate(probs):
        rank = (F.col("__n") - 1) * F.lit(p)
        aggs += [F.min(F.when(F.col("__upto") > F.floor(rank), x)).alias(f"__lo{i}"),
                 F.min(F.when(F.col("__upto") > F.ceil(rank), x)).alias(f"__hi{i}")]
        out.append((F.col(f"__lo{i}") + (rank - F.floor(rank)) * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(names[i]))
    extra = [F.col("__n").alias(count_col)] if count_col else []
    return upto.groupBy(*ks).agg(*aggs).select(*ks, *out, *extra)
