"""Tree ensembles scored, and recursive forecasts walked, by column expressions.

The nodes of all trees are one array value (a scalar subquery over one stored
row, so a plan does not grow with the ensemble). A tree is descended by a fold
over its depth, the ensemble's sum is a fold over the trees, and a recursive
forecast is a fold over an entity's future days whose state is the entity's last
values: no Python worker and no model object in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENSEMBLE = ("array<struct<feature:array<int>,threshold:array<double>,below:array<int>,above:array<int>,"
            "value:array<double>,weight:double,steps:array<int>>>")


def _depth(below, above) -> int:
    """Splits on the longest path (children come after their parent)."""
    depth = [0] * len(below)
    for at, (b, a) in enumerate(zip(below, above)):
        for child in (b, a):
            if child >= 0:
                depth[child] = depth[at] + 1
    return max(depth)


def ensemble_value(spark: SparkSession, table: dict) -> Column:
    """The node arrays of ``table`` (``trees.tree_table``, ``boosting`` models) as
    one value. Its size is that of the model: trees x nodes."""
    rows = []
    for (feature, threshold, below, above, value), weight in zip(table["trees"], table["weights"]):
        below, above = [int(i) for i in below], [int(i) for i in above]
        rows.append(([int(i) for i in feature], [float(v) for v in threshold], below, above, [float(v) for v in value],
                     float(weight), list(range(_depth(below, above)))))
    return spark.createDataFrame([(rows,)], f"trees {ENSEMBLE}").scalar()


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ensemble_score(trees: Column, x: Column) -> Column:
    """Weighted sum of the trees' leaves for the feature array ``x``. A value up to
    the threshold goes below; a missing one goes above."""
    def leaf(tree):
        def step(at, _):
            split = F.get(x, F.get(tree["feature"], at)) <= F.get(tree["threshold"], at)
            child = F.when(split, F.get(tree["below"], at)).otherwise(F.get(tree["above"], at))
            return F.when(F.get(tree["below"], at) < 0, at).otherwise(child)
        return F.get(tree["value"], F.aggregate(tree["steps"], F.lit(0), step))
    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["weight"] * leaf(tree))


def trailing_features(last: Column, tail: int) -> Column:
    """``lag_7, lag_14, rolling_mean_7, rolling_std_7`` of the day after the
    ``tail`` (14 or more) values ``last``, oldest first."""
    def stats(week):
        mean = F.aggregate(week, F.lit(0.0), lambda s, v: s + v) / 7
        return bound(mean, lambda m: F.array(
            F.get(last, F.lit(tail - 7)), F.get(last, F.lit(tail - 14)), m,
            F.sqrt(F.aggregate(week, F.lit(0.0), lambda s, v: s + (v - m) * (v - m)) / 6)))
    return bound(F.slice(last, tail - 6, 7), stats)


def walk(inputs: DataFrame, trees: Column, features: Sequence[str], tail: int, date_col: str,
         entity_col: str, target_col: str) -> DataFrame:
    """The recursive forecast: one row per entity and future day of ``inputs``
    (``trees.forecast_inputs``: an entity's last ``tail`` days and its future days
    with all features but the first four, which follow from the days before).

    An entity is one row here, of ``tail`` + horizon days, whatever its history;
    a fold over its days carries the last ``tail`` values. Days without operation
    are 0, others at least 0. An entity with a shorter history is an error."""
    day = F.struct(F.col(date_col).alias("day"), F.col("__future").alias("future"), F.col(target_col).cast("double").alias("y"),
                   (F.col("is_operational") == 1).alias("open"), F.array(*features[4:]).alias("known"))
    entities = inputs.groupBy(entity_col).agg(F.sort_array(F.collect_list(day)).alias("days"))
    entities = entities.select(
        entity_col, F.filter("days", lambda d: d["future"] == 1).alias("ahead"),
        F.transform(F.filter("days", lambda d: d["future"] == 0), lambda d: d["y"]).alias("past"))
    message = F.concat(F.lit("entity '"), F.col(entity_col), F.lit(f"' has fewer than {tail} days of history"))
    last = F.when(F.size("past") < tail, F.raise_error(message).cast("array<double>")).otherwise(F.slice("past", -tail, tail))
    entities = entities.select(entity_col, "ahead", last.alias("last")).withColumn("trees", trees)

    def predicted(last, d):
        score = bound(F.concat(trailing_features(last, tail), d["known"]), lambda x: ensemble_score(F.col("trees"), x))
        return F.when(d["open"], F.greatest(score, F.lit(0.0))).otherwise(0.0)

    def step(state, d):
        return bound(predicted(state["last"], d), lambda y: F.struct(
            F.concat(F.slice(state["last"], 2, tail - 1), F.array(y)).alias("last"),
            F.concat(state["done"], F.array(y)).alias("done")))

    start = F.struct(F.col("last").alias("last"), F.array().cast("array<double>").alias("done"))
    done = F.aggregate("ahead", start, step, lambda state: state["done"])
    pairs = F.arrays_zip(F.transform("ahead", lambda d: d["day"]).alias("day"), done.alias("y"))
    return entities.select(entity_col, F.inline(pairs).alias("day", "y")).select(
        F.col("day").alias(date_col), entity_col, F.col("y").alias("y_pred"))
