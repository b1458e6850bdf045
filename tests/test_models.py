import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import evaluation as E
from demandgrid.operators import folds as FO
from demandgrid.operators import forecast as FC
from tests.conftest import D


def _panel(spark, series: dict, start=dt.date(2024, 1, 1)):
    rows = [(start + dt.timedelta(days=i), e, v) for e, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")


def test_naive(spark):
    df = _panel(spark, {"SP": list(range(100, 200, 10)), "RJ": list(range(50, 100, 5))})
    pred = FC.naive_predict(FC.naive_fit(df), 3)
    got = {(r.entity, r.shipment_date): r for r in pred.collect()}
    assert len(got) == 6
    assert got[("SP", D("2024-01-11"))].y_pred == 190 and got[("RJ", D("2024-01-13"))].y_pred == 95
    assert all(r.y_lower >= 0 and r.y_lower <= r.y_pred <= r.y_upper for r in got.values())
    with pytest.raises(ValueError):
        FC.naive_predict(FC.naive_fit(df), 0)


def test_seasonal_naive_cycles(spark):
    sp = [100 + i for i in range(7)] + [200 + 10 * i for i in range(7)]
    rj = [10 + i for i in range(7)] + [80 + 10 * i for i in range(7)]
    df = _panel(spark, {"SP": sp, "RJ": rj})
    pred = FC.seasonal_naive_predict(FC.seasonal_naive_fit(df, 7), 16, 7)
    sp_pred = [r.y_pred for r in pred.where("entity = 'SP'").orderBy("shipment_date").collect()]
    assert sp_pred[:7] == [200.0 + 10 * i for i in range(7)]
    assert sp_pred[7:14] == sp_pred[:7] and sp_pred[14:] == sp_pred[:2]
    st = FC.seasonal_naive_fit(_panel(spark, {"A": [1, 2, 3]}), 7)
    with pytest.raises(ValueError):
        FC.check_min_history(st, 7)


def test_forecast_starts_after_global_last_date(spark):
    df = _panel(spark, {"A": [1, 2, 3, 4, 5], "B": [7, 8, 9]})
    pred = FC.naive_predict(FC.naive_fit(df), 1).collect()
    assert {r.shipment_date for r in pred} == {D("2024-01-06")}


def test_one_pass_baselines_equal_separate_fits(spark):
    import random
    rng = random.Random(1)
    df = _panel(spark, {e: [rng.randint(0, 30) for _ in range(60)] for e in "ABC"})
    train = df.where(F.col("shipment_date") <= D("2024-02-09"))
    test = df.where(F.col("shipment_date") > D("2024-02-09")).withColumn("n_shipments", F.col("n_shipments").cast("double"))
    sep = FC.seasonal_naive_predict(FC.seasonal_naive_fit(train, 7), 20, 7).join(test, ["shipment_date", "entity"])
    info = spark.createDataFrame([(D("2024-02-09"), 20)], "last_date date, horizon int")
    one = FC.score_rows(test, FC.fit_baselines(train, 7), info, 7)
    a = sorted((r.shipment_date, r.entity, r.y_pred, r.y_upper) for r in sep.collect())
    b = sorted((r.shipment_date, r.entity, r.y_pred_seasonal_naive, r.y_upper_seasonal_naive) for r in one.collect())
    assert a == b


def test_folds_expanding_and_leakage(spark):
    df = _panel(spark, {"SP": [100] * 120, "RJ": [100] * 120}, start=dt.date(2017, 1, 1))
    spec = [(1, D("2017-02-28"), D("2017-03-01"), D("2017-03-31"), "f1"),
            (2, D("2017-03-31"), D("2017-04-01"), D("2017-04-30"), "f2")]
    sizes = {(r.fold_id, r.split): r for r in FO.fold_sizes(FO.assign_folds(df, spec)).collect()}
    assert sizes[(1, "train")].last_date == D("2017-02-28") and sizes[(1, "test")].first_date == D("2017-03-01")
    assert sizes[(2, "train")].n_rows > sizes[(1, "train")].n_rows       # expanding
    with pytest.raises(ValueError):
        FO.validate_spec([(1, D("2017-03-01"), D("2017-03-01"), D("2017-03-31"), "bad")])
    # Changing a test value must not change the fitted state of that fold.
    base = E.backtest_wide(df, spec)
    changed = df.withColumn("n_shipments", F.when(F.col("shipment_date") == D("2017-03-15"), 9999)
                            .otherwise(F.col("n_shipments")))
    other = E.backtest_wide(changed, spec)
    p1 = sorted((r.fold_id, r.shipment_date, r.entity, r.y_pred_naive) for r in base.where("fold_id = 1").collect())
    p2 = sorted((r.fold_id, r.shipment_date, r.entity, r.y_pred_naive) for r in other.where("fold_id = 1").collect())
    assert p1 == p2


def test_decomposition_contract(spark):
    from demandgrid.operators import decomposition as DC
    rows = []
    for i in range(450):
        d = dt.date(2023, 1, 1) + dt.timedelta(days=i)
        for e, b in (("SP", 100.0), ("RJ", 20.0)):
            rows.append((d, e, int(round(b * (1 + 0.3 * math.sin(2 * math.pi * d.weekday() / 7)) + 0.02 * i))))
    df = spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")
    spec = [(1, D("2024-02-29"), D("2024-03-01"), D("2024-03-25"), "f")]
    out = DC.backtest(df, spec)
    got = out.collect()
    assert len(got) == 50
    assert all(r.y_pred >= 0 and r.y_lower <= r.y_pred <= r.y_upper for r in got)
    err = sum(abs(r.n_shipments - r.y_pred) for r in got) / sum(r.n_shipments for r in got)
    assert err < 0.05                                  # weekly shape and drift recovered


@pytest.mark.parametrize("knots,yearly", [(20, 0), (25, 10)])
def test_decomposition_equals_a_driver_side_fit(spark, knots, yearly):
    """The grouped fit equals a plain numpy ridge fit of each entity's
    series (brute force on the driver): hinge trend, weekly and yearly terms,
    holiday flag, unpenalised intercept, residual-quantile interval."""
    import numpy as np
    from demandgrid.functions import calendar as cal
    from demandgrid.operators import decomposition as DC
    start, n, h = dt.date(2023, 1, 1), 200, 10
    rows = []
    for i in range(n):
        d = start + dt.timedelta(days=i)
        for e, b in (("SP", 40.0), ("RJ", 8.0)):
            rows.append((d, e, int(b + (i % 7) * (2 if e == "SP" else 1) + (i * 37 % 11))))
    hist = spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")
    fut = spark.createDataFrame([(start + dt.timedelta(days=n + j), e) for j in range(h) for e in ("SP", "RJ")],
                                "shipment_date date, entity string")
    got = {(r.shipment_date, r.entity): r for r in DC.fit_predict(hist, fut, n_changepoints=knots, yearly=yearly).collect()}
    days_all = [start + dt.timedelta(days=i) for i in range(n + h)]
    hol = {r.d: r.h for r in spark.createDataFrame([(d,) for d in days_all], "d date")
           .select("d", cal.is_holiday(F.col("d")).cast("int").alias("h")).collect()}

    def design(t_days, span, cps):
        t = t_days / span
        cols = [np.ones_like(t), t] + [np.maximum(t - c, 0) for c in cps]
        for k in (1, 2, 3):
            cols += [np.sin(2 * np.pi * k * t_days / 7), np.cos(2 * np.pi * k * t_days / 7)]
        for k in range(1, yearly + 1):
            cols += [np.sin(2 * np.pi * k * t_days / 365.25), np.cos(2 * np.pi * k * t_days / 365.25)]
        return np.column_stack(cols)

    for ent in ("SP", "RJ"):
        y = np.array([v for d, e, v in rows if e == ent], float)
        td, tf = np.arange(n, dtype=float), np.arange(n, n + h, dtype=float)
        span, n_cp = float(n - 1), knots
        cps = np.linspace(0, 0.8, n_cp + 2)[1:-1]
        xh = np.column_stack([design(td, span, cps), [hol[d] for d in days_all[:n]]])
        xf = np.column_stack([design(tf, span, cps), [hol[d] for d in days_all[n:]]])
        pen = np.eye(xh.shape[1])
        pen[0, 0] = 0.0
        beta = np.linalg.solve(xh.T @ xh + pen, xh.T @ y)
        lo, hi = np.quantile(y - xh @ beta, [0.1, 0.9])
        for j, d in enumerate(days_all[n:]):
            yhat = max(float(xf[j] @ beta), 0.0)
            r = got[(d, ent)]
            assert r.y_pred == pytest.approx(yhat, abs=1e-6)
            assert r.y_lower == pytest.approx(max(yhat + lo, 0.0), abs=1e-6)
            assert r.y_upper == pytest.approx(max(yhat + hi, 0.0), abs=1e-6)


def test_sparse_knots_from_sufficient_statistics():
    """The coordinate descent meets the optimality conditions of the penalised
    fit, equals a proximal gradient descent on the rows, and bends the trend at
    few knots."""
    import numpy as np
    from demandgrid.operators import decomposition as DC
    rng = np.random.default_rng(3)
    n, n_knots, lam = 400, 6, 8.0
    day = np.arange(n, dtype=float)
    cps = DC.knots(n_knots)
    x = DC.design(day, np.full(n, n - 1.0), (day % 90 == 0).astype(float), cps, DC._waves(2, 0))
    y = 10 + 8 * np.maximum(day / (n - 1) - cps[2], 0) + np.sin(2 * np.pi * day / 7) + rng.normal(0, 0.3, n)
    xx, xy = x.T @ x, x.T @ y
    b = DC.solve(xx, xy, 1.0, lam, n_knots)
    k = slice(2, 2 + n_knots)
    ridge = np.r_[0.0, np.ones(x.shape[1] - 1)]
    g = xx @ b + ridge * b - xy
    assert np.abs(np.delete(g, np.arange(2, 2 + n_knots))).max() < 1e-6
    on = b[k] != 0
    assert 0 < on.sum() < n_knots
    assert np.abs(g[k][on] + lam * np.sign(b[k][on])).max() < 1e-5 and np.abs(g[k][~on]).max() <= lam + 1e-6
    step = 1 / np.linalg.eigvalsh(xx + np.diag(ridge)).max()
    p = q = np.zeros_like(b)
    t = 1.0
    for _ in range(60_000):             # accelerated proximal gradient
        z = q - step * (xx @ q + ridge * q - xy)
        z[k] = np.sign(z[k]) * np.maximum(np.abs(z[k]) - step * lam, 0)
        t, old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        p, q = z, z + (old - 1) / t * (z - p)
    assert b == pytest.approx(p, abs=1e-4)
    assert DC.solve(xx, xy, 1.0, 0.0, n_knots) == pytest.approx(np.linalg.solve(xx + np.diag(ridge), xy))


def test_decomposition_runs_no_grouped_pandas(spark):
    from demandgrid.operators import decomposition as DC
    rows = [(D("2024-01-01") + dt.timedelta(days=i), "SP", i % 7) for i in range(60)]
    hist = spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")
    fut = spark.createDataFrame([(D("2024-03-01"), "SP"), (D("2024-03-01"), "none")], "shipment_date date, entity string")
    out = DC.fit_predict(hist, fut, n_changepoints=3, yearly=0, knot_penalty=5.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "FlatMapGroupsInArrow" not in plan
    got = out.collect()
    assert [r.entity for r in got] == ["SP"] and got[0].y_pred == pytest.approx((D("2024-03-01") - rows[0][0]).days % 7, abs=0.5)
