import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import checks as CH
from demandgrid.operators import panel as P
from demandgrid.operators import trees as T
from demandgrid.operators import training as TRN
from demandgrid.sources import state as ST
from tests.conftest import D


def _panel(spark, days=150, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(days):
        d = dt.date(2023, 1, 1) + dt.timedelta(days=i)
        for e, b in (("SP", 50), ("RJ", 10), ("AC", 2)):
            rows.append((d, e, 0 if d.weekday() == 6 else max(0, int(rng.gauss(b, 0.2 * b + 1)))))
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")


def test_split_train_holdout(spark, two_entity_panel):
    s = P.split_train_holdout(two_entity_panel, D("2024-01-03"), D("2024-01-04"), D("2024-01-05"))
    got = {r.split: r.c for r in s.groupBy("split").agg(F.count("*").alias("c")).collect()}
    assert got == {"train": 6, "holdout": 4}
    with pytest.raises(ValueError):
        P.split_train_holdout(two_entity_panel, D("2024-01-03"), D("2024-01-05"), D("2024-01-05"))


def test_one_to_one_join(spark, two_entity_panel):
    k = ["shipment_date", "entity"]
    other = two_entity_panel.withColumnRenamed("n_shipments", "y")
    assert CH.one_to_one_join(two_entity_panel, other, k).count() == 10
    with pytest.raises(ValueError):
        CH.one_to_one_join(two_entity_panel, other.limit(9), k)
    with pytest.raises(ValueError):
        CH.one_to_one_join(two_entity_panel, other.unionByName(other.limit(1)), k)


def test_recursive_forecast_matches_driver_loop(spark):
    """First days of the grouped recursion equal a driver loop that re-runs
    the full feature pipeline and model.transform with injected predictions."""
    from demandgrid.operators import features as X
    panel = _panel(spark)
    fc = T.fit(panel, T.GBTParams(max_iter=5, max_depth=3), (5.0, 20.0), D("2023-01-01"))
    pred = {(r.shipment_date, r.entity): r.y_pred
            for r in T.recursive_forecast(fc, panel, 3).collect()}
    work = panel.withColumn("n_shipments", F.col("n_shipments").cast("double"))
    last = D("2023-01-01") + dt.timedelta(days=149)
    for step in range(1, 4):
        day = last + dt.timedelta(days=step)
        fut = work.where(F.col("shipment_date") == day - dt.timedelta(days=1)).select(
            F.lit(day).alias("shipment_date"), "entity", F.lit(None).cast("double").alias("n_shipments"))
        feats = X.default_pipeline(fc.stats, (), (5.0, 20.0), D("2023-01-01")).transform(work.unionByName(fut))
        rows = T.numeric_features(feats.where(F.col("shipment_date") == day))
        scored = fc.model.transform(T.assembler().transform(rows)).collect()
        inj = []
        for r in scored:
            y = max(r.y_pred, 0.0) if r.is_operational == 1 else 0.0
            assert pred[(day, r.entity)] == pytest.approx(y, abs=1e-9)
            inj.append((day, r.entity, y))
        add = spark.createDataFrame(inj, "shipment_date date, entity string, n_shipments double")
        work = work.unionByName(add)
        last_day = day  # noqa: F841
    assert len(pred) == 9


def test_training_flow_both(spark):
    out = tempfile.mkdtemp(prefix="dg-train-")
    panel = _panel(spark)
    res = TRN.run(panel, "both", out, train_end=D("2023-04-30"), holdout_end=D("2023-05-30"),
                  params=T.GBTParams(max_iter=3, max_depth=3), thresholds=(5.0, 20.0),
                  reference_date=D("2023-01-01"))
    ev = res["evaluation"]
    assert ev["n_days"] == 30 and ev["wape"] >= 0
    state, meta = ST.read_model(spark, out, "conformal_seasonal_naive")
    assert state.count() == 3
    info = ST.model_info(meta).first()
    assert info.eval_wape == ev["wape"] and info.n_groups == 3
    with pytest.raises(ValueError):
        TRN.run(panel, "bogus", out)


def test_recursive_forecast_does_not_collapse(spark):
    """Over a 28-day horizon the recursion keeps each entity's level and
    weekly shape: no drift to zero or to one constant."""
    panel = _panel(spark, days=200)
    fc = T.fit(panel, T.GBTParams(max_iter=15, max_depth=4), (5.0, 20.0), D("2023-01-01"))
    pred = T.recursive_forecast(fc, panel, 28).toPandas()
    assert len(pred) == 3 * 28 and pred.y_pred.notna().all() and (pred.y_pred >= 0).all()
    pred["dow"] = [d.weekday() for d in pred.shipment_date]
    for ent, level in (("SP", 50), ("RJ", 10)):
        p = pred[(pred.entity == ent) & (pred.dow != 6)]
        last_week = p[p.shipment_date >= max(p.shipment_date) - dt.timedelta(days=6)].y_pred
        assert 0.6 * level <= last_week.mean() <= 1.4 * level
    assert (pred[pred.dow == 6].y_pred == 0).all()                 # Sundays: not operational
    assert pred[pred.entity == "SP"].y_pred.round(6).nunique() > 1


def test_conformal_trees_production_and_reload(spark):
    """Tree base: residuals on operational calibration days only; stored
    model reloads and forecasts the same values with the stored interval."""
    from demandgrid.operators import conformal as CF
    out = tempfile.mkdtemp(prefix="dg-train-trees-")
    panel = _panel(spark, days=160)
    params = T.GBTParams(max_iter=4, max_depth=3)
    res = CF.tree_calibration_residuals(panel, 21, params, (5.0, 20.0), D("2023-01-01")).collect()
    last = D("2023-01-01") + dt.timedelta(days=159)
    assert res and all(last - dt.timedelta(days=20) <= r.shipment_date <= last for r in res)
    assert all(r.shipment_date.weekday() != 6 for r in res)                # Sundays excluded
    corpus_christi = D("2023-06-08")                                     # Easter 2023 + 60: holiday
    assert all(r.shipment_date != corpus_christi for r in res)
    days = [last - dt.timedelta(days=i) for i in range(21)]
    assert len(res) == 3 * sum(1 for d in days if d.weekday() != 6 and d != corpus_christi)
    prod = TRN.run(panel, "production", out, params=params, calibration_days=21, thresholds=(5.0, 20.0),
                   reference_date=D("2023-01-01"), base="trees")["production"]
    assert prod["model"] == "conformal_trees" and prod["lower_offset"] <= prod["upper_offset"]
    fc, extra = TRN.load_tree_forecaster(spark, out)
    assert extra["calibration_days"] == 21 and extra["last_train_date"] == last
    a = {(r.shipment_date, r.entity): r for r in TRN.tree_interval_forecast(
        fc, panel, 5, extra["lower_offset"], extra["upper_offset"]).collect()}
    refit = T.fit(panel, params, (5.0, 20.0), D("2023-01-01"))
    b = {(r.shipment_date, r.entity): r.y_pred
         for r in T.recursive_forecast(refit, panel, 5).collect()}
    assert a.keys() == b.keys() and len(a) == 15
    for k, r in a.items():
        assert r.y_pred == pytest.approx(b[k], abs=1e-9)
        assert r.y_lower == pytest.approx(max(0.0, r.y_pred + extra["lower_offset"]))
        assert r.y_upper == pytest.approx(r.y_pred + extra["upper_offset"])
    with pytest.raises(ValueError):
        TRN.run(panel, "production", out, base="prophet")


def test_fast_retrain_uses_last_180_days(spark, monkeypatch):
    seen = {}
    real_fit = T.fit

    def spy(history, params, *a, **k):
        seen["min"] = history.agg(F.min("shipment_date")).first()[0]
        seen["params"] = params
        return real_fit(history, T.GBTParams(max_iter=2, max_depth=2), *a, **k)
    monkeypatch.setattr(T, "fit", spy)
    panel = _panel(spark, days=200)
    TRN.run(panel, "evaluation", tempfile.mkdtemp(prefix="dg-fast-"), train_end=D("2023-07-01"),
            holdout_end=D("2023-07-10"), thresholds=(5.0, 20.0), reference_date=D("2023-01-01"),
            fast_retrain=True)
    last = D("2023-01-01") + dt.timedelta(days=199)
    assert seen["min"] == last - dt.timedelta(days=180)
    assert seen["params"].max_iter == 50 and seen["params"].min_instances == 20


def test_tree_table_scores_as_the_model(spark):
    """The node arrays read from the printed form give the model's predictions."""
    import numpy as np
    panel = _panel(spark, days=60)
    data = T.prepare(panel, (5.0, 20.0), D("2023-01-01"))
    fc = T.fit_prepared(data, T.GBTParams(max_iter=4, max_depth=3))
    rows = fc.model.transform(data.table).select("features", "y_pred").collect()
    table = T.tree_table(fc.model)
    assert len(table["trees"]) == fc.model.getNumTrees
    got = T.score_table(table, np.array([r.features.toArray() for r in rows]))
    assert np.allclose(got, [r.y_pred for r in rows], atol=1e-9)
