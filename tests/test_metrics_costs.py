import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandgrid.functions import metrics as M
from demandgrid.operators import costs as CO
from demandgrid.operators import evaluation as E
from demandgrid.operators import scoring as SC
from tests.conftest import D


def _pairs(spark, y, yhat, entity="SP", start=dt.date(2017, 11, 20)):
    rows = [(start + dt.timedelta(days=i), entity, float(a), float(b)) for i, (a, b) in enumerate(zip(y, yhat))]
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments double, y_pred double")


def _agg(df, col):
    return df.agg(col.alias("x")).first().x


def test_point_metrics(spark):
    assert _agg(_pairs(spark, [10, 20], [12, 19]), M.wape()) == pytest.approx(0.10)
    assert _agg(_pairs(spark, [0, 0, 10], [1, 1, 12]), M.wape()) == pytest.approx(0.40)
    assert _agg(_pairs(spark, [10, 20], [12, 24]), M.mae()) == pytest.approx(3.0)
    assert _agg(_pairs(spark, [0, 0], [3, 4]), M.rmse()) == pytest.approx(math.sqrt(12.5))
    assert _agg(_pairs(spark, [10, 20], [12, 24]), M.bias()) == pytest.approx(3.0)
    assert _agg(_pairs(spark, [0, 0], [3, 4]), M.wape()) is None          # undefined -> NULL


def test_wape_by_segment(spark):
    df = _pairs(spark, [100, 200], [110, 180], "SP").unionByName(_pairs(spark, [50, 150], [55, 150], "RJ")) \
        .unionByName(_pairs(spark, [0, 0], [1, 1], "AC"))
    got = {r.entity: r.wape for r in E.wape_by_segment(df, "entity").collect()}
    assert got == {"SP": pytest.approx(0.10), "RJ": pytest.approx(0.025)}     # zero-truth AC absent
    with pytest.raises(KeyError):
        E.wape_by_segment(df, "nope")


def test_event_window(spark):
    df = _pairs(spark, [10 + i for i in range(10)], [12 + i for i in range(10)])
    w = E.wape_in_event_window(df, [D("2017-11-24")], 3).first()
    assert 0 < w.wape < 1 and w.n_rows == 7
    assert E.in_event_windows(df, [D("2019-01-01")], 3).count() == 0


def test_asymmetric_cost(spark):
    df = _pairs(spark, [10, 20, 30], [5, 15, 25])
    assert _agg(df, M.asymmetric_cost("n_shipments", "y_pred", 2, 1)) == pytest.approx(30)
    df2 = _pairs(spark, [10, 20, 30], [15, 25, 35])
    assert _agg(df2, M.asymmetric_cost("n_shipments", "y_pred", 2, 1)) == pytest.approx(15)
    df3 = _pairs(spark, [10, 20, 30, 40], [5, 25, 25, 45])
    assert _agg(df3, M.asymmetric_cost("n_shipments", "y_pred", 3, 1)) == pytest.approx(40)
    with pytest.raises(ValueError):
        M.asymmetric_cost("n_shipments", "y_pred", -1, 1)


def test_best_multiplier_first_minimum(spark):
    # Under-prediction 5x as costly: pushing predictions up wins.
    df = _pairs(spark, [10, 20, 30], [5, 10, 15]).withColumn("g", F.lit(1))
    r = CO.best_multiplier(df, ["g"], 5.0, 1.0).first()
    assert r.best_alpha == 1.0 and r.best_cost == pytest.approx(0.0)
    # All-zero predictions: every multiplier costs the same -> first grid point.
    z = _pairs(spark, [1, 2], [0, 0]).withColumn("g", F.lit(1))
    assert CO.best_multiplier(z, ["g"], 1.0, 1.0).first().best_alpha == -0.2


def test_gain_table(spark):
    rows = [(1, D("2024-01-01"), "A", 10.0, 8.0, 10.0, 1), (1, D("2024-01-02"), "A", 10.0, 12.0, 7.0, 1)]
    paired = spark.createDataFrame(rows, "fold_id int, shipment_date date, entity string, n_shipments double, "
                                         "y_pred_model double, y_pred_base double, is_operational int")
    g = {r.cost_ratio: r for r in CO.gain_by_fold(paired, ratios=(1.0, 3.0)).collect()}
    # ratio 1: model cost 2 + 2 = 4, baseline 0 + 3 = 3 -> gain -1
    assert g[1.0].cost_model_no_tuning == 4 and g[1.0].cost_baseline == 3 and g[1.0].gain_no_tuning == -1
    assert g[3.0].cost_baseline == 9 and g[3.0].gain_tuned >= g[3.0].gain_no_tuning


def test_recommendation_and_flags(spark):
    fc = spark.createDataFrame([(D("2024-02-01"), "SP", 100.0, 80.0, 120.0), (D("2024-02-01"), "RJ", 100.0, 80.0, 120.0)],
                               "shipment_date date, entity string, y_pred double, y_lower double, y_upper double")
    req = SC.requests_frame(spark, [("a", D("2024-02-01"), D("2024-02-01"), [], 1.0, None, True, True),
                                    ("b", D("2024-02-01"), D("2024-02-01"), ["RJ"], -1.0, 2.0, False, True),
                                    ("c", D("2024-02-01"), D("2024-02-01"), [], None, None, True, False)])
    known = fc.select("entity")
    checked = SC.validate_requests(req, D("2024-01-31"), known)
    out = {(r.request_id, r.entity): r for r in SC.score_requests(fc, checked).collect()}
    assert out[("a", "SP")].recommended == 120.0 and out[("a", "SP")].alpha_source == "request"
    assert out[("a", "SP")].cost_ratio_source == "server_default" and out[("a", "SP")].cost_ratio_used == 3.0
    assert ("b", "SP") not in out and out[("b", "RJ")].recommended == 80.0 and out[("b", "RJ")].lower_90 is None
    c = out[("c", "SP")]
    assert c.recommended is None and c.alpha_used is None and c.alpha_source is None and c.upper_90 == 120.0


def test_request_rules(spark):
    req = SC.requests_frame(spark, [
        ("ok", D("2024-02-01"), D("2024-02-10"), ["SP"], None, None, True, True),
        ("order", D("2024-02-10"), D("2024-02-01"), [], None, None, True, True),
        ("long", D("2024-02-01"), D("2024-06-01"), [], None, None, True, True),
        ("alpha", D("2024-02-01"), D("2024-02-02"), [], 2.5, None, True, True),
        ("ratio", D("2024-02-01"), D("2024-02-02"), [], None, 0.1, True, True),
        ("past", D("2024-01-15"), D("2024-02-02"), [], None, None, True, True),
        ("who", D("2024-02-01"), D("2024-02-02"), ["ZZ", "SP"], None, None, True, True)])
    known = spark.createDataFrame([("SP",)], "entity string")
    got = {r.request_id: r.reason for r in SC.validate_requests(req, D("2024-01-31"), known).collect()}
    assert got["ok"] is None and got["order"].startswith("end_date") and got["long"].startswith("window")
    assert got["alpha"].startswith("alpha") and got["ratio"].startswith("cost_ratio")
    assert got["past"].startswith("start_date") and got["who"] == "unknown entities: ZZ"
