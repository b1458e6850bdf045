"""Column-expression ensembles and the recursive walk against plain loops."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import ensemble as EN
from demandgrid.operators import trees as T
from tests.conftest import D


def _random_table(rng, n_features, n_trees, splits):
    trees = []
    for _ in range(n_trees):
        feat, thr, below, above, value = [0], [0.0], [-1], [-1], [rng.gauss(0, 1)]
        for _ in range(splits):
            leaf = rng.choice([i for i, b in enumerate(below) if b < 0])
            feat[leaf], thr[leaf] = rng.randrange(n_features), rng.choice([0.0, 1.0, 2.5])
            below[leaf], above[leaf] = len(feat), len(feat) + 1
            for _ in range(2):
                feat.append(0), thr.append(0.0), below.append(-1), above.append(-1), value.append(rng.gauss(0, 1))
        trees.append(tuple(np.array(v) for v in (feat, thr, below, above, value)))
    return {"trees": trees, "weights": np.array([rng.uniform(0.05, 1) for _ in range(n_trees)])}


@pytest.mark.parametrize("n_trees, splits", [(1, 0), (7, 12), (120, 30)])
def test_score_equals_numpy(spark, n_trees, splits):
    rng = random.Random(n_trees)
    table = _random_table(rng, 5, n_trees, splits)
    x = [[rng.choice([-1.0, 0.0, 1.0, 2.0, 2.5, 3.0]) for _ in range(5)] for _ in range(60)]
    x[0] = [float("nan")] * 5
    df = spark.createDataFrame([(i, row) for i, row in enumerate(x)], "i int, x array<double>")
    df = df.withColumn("t", EN.ensemble_value(spark, table))
    got = [r.y for r in df.select("i", EN.ensemble_score(F.col("t"), F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == pytest.approx(T.score_table(table, np.array(x)).tolist(), abs=1e-12)


def _inputs(spark, rng, horizon, days=T.TAIL):
    names = T.MODEL_FEATURES
    rows = []
    for entity, n in (("A", days), ("B", T.TAIL)):
        for i in range(n + horizon):
            ahead = int(i >= n)
            known = [None] * 4 + [float(rng.randint(0, 3)) for _ in names[4:]]
            rows.append((D("2024-01-01") + dt.timedelta(days=i - n), entity, None if ahead else rng.randint(0, 9), ahead,
                         int(rng.random() < .8), *known))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long, __future int, is_operational int, "
                                       + ", ".join(f"{n} double" for n in names))


def test_walk_equals_a_loop(spark):
    rng = random.Random(5)
    table = _random_table(rng, len(T.MODEL_FEATURES), 15, 10)
    table["trees"].append((np.array([2, 0, 0]), np.array([4.0, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0, 3.0, 6.0])))
    table["weights"] = np.append(table["weights"], 1.0)
    rows, df = _inputs(spark, rng, 40)
    got = {(r.shipment_date, r.entity): r.y_pred for r in
           EN.walk(df, EN.ensemble_value(spark, table), T.MODEL_FEATURES, T.TAIL, "shipment_date", "entity", "n_shipments").collect()}
    want = {}
    for entity in "AB":
        own = sorted(r for r in rows if r[1] == entity)
        series = [float(r[2]) for r in own if not r[3]]
        for r in (r for r in own if r[3]):
            week = series[-7:]
            x = [series[-7], series[-14], sum(week) / 7, statistics.stdev(week), *r[9:]]
            y = max(T.score_table(table, np.array([x]))[0], 0.0) if r[4] else 0.0
            want[(r[0], entity)] = y
            series.append(y)
    assert got.keys() == want.keys() and len(got) == 80
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert len({round(v, 6) for v in want.values()}) > 10


def test_short_history_is_an_error_and_no_python_in_the_plan(spark):
    table = _random_table(random.Random(1), 23, 2, 3)
    _, df = _inputs(spark, random.Random(2), 3, days=T.TAIL - 1)
    out = EN.walk(df, EN.ensemble_value(spark, table), T.MODEL_FEATURES, T.TAIL, "shipment_date", "entity", "n_shipments")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InPandas" not in plan and "PythonUDF" not in plan
    with pytest.raises(Exception, match="fewer than 14 days"):
        out.collect()
