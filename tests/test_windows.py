import datetime as dt
import math
import random

from demandgrid.operators import features as X
from demandgrid.operators import windows as W
from tests.conftest import D


def _series(df, entity, col):
    return [r[col] for r in df.where(df.entity == entity).orderBy("shipment_date").collect()]


def test_lags(two_entity_panel):
    out = W.add_lags(two_entity_panel, (1,))
    assert _series(out, "SP", "lag_1") == [None, 10, 20, 30, 40]
    assert _series(out, "RJ", "lag_1") == [None, 5, 15, 25, 35]


def test_rolling_excludes_current_row(two_entity_panel):
    out = W.add_rolling(two_entity_panel, (2, 3), ("mean", "max"))
    assert _series(out, "SP", "rolling_mean_2") == [None, 10, 15, 25, 35]
    assert _series(out, "SP", "rolling_mean_3")[3] == 20 and _series(out, "SP", "rolling_max_3")[3] == 30
    assert _series(out, "RJ", "rolling_mean_2")[2] == 10


def test_rolling_order_insensitive(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "SP", 100 + 10 * i) for i in range(10)]
    random.Random(7).shuffle(rows)
    df = spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")
    assert _series(W.add_rolling(df, (3,)), "SP", "rolling_mean_3")[4] == 120


def test_rolling_std_is_sample_std_and_min_periods(two_entity_panel):
    out = W.add_rolling(two_entity_panel, (3,), ("std",), min_periods=2)
    s = _series(out, "SP", "rolling_std_3")
    assert s[0] is None and s[1] is None            # < 2 prior rows
    assert math.isclose(s[2], math.sqrt(50.0))       # std(10, 20), ddof=1


def test_rolling_dev_matches_brute_force(spark):
    rng = random.Random(3)
    vals = [rng.randint(0, 20) for _ in range(40)]
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", v) for i, v in enumerate(vals)],
                               "shipment_date date, entity string, n_shipments long")
    got = _series(W.sql_feature_table(df), "A", "rolling_dev_7")
    for t in range(40):
        h = vals[max(0, t - 7):t]
        if len(h) < 2:
            assert got[t] is None
            continue
        sq = [(h[k] - sum(h[:k]) / k) ** 2 for k in range(1, len(h))]
        assert math.isclose(got[t], math.sqrt(sum(sq) / len(sq)), rel_tol=1e-9)


def test_argument_errors():
    import pytest
    with pytest.raises(ValueError):
        W.lag_columns([])
    with pytest.raises(ValueError):
        W.lag_columns([0])
    with pytest.raises(ValueError):
        W.rolling_columns([-1])
    with pytest.raises(ValueError):
        W.rolling_columns([3], ["median"])


def test_pipeline_contract(two_entity_panel):
    import pytest
    with pytest.raises(ValueError):
        X.FeaturePipeline([])
    with pytest.raises(ValueError):
        X.FeaturePipeline([X.lag_step((1,)), X.lag_step((1,))])
    broken = X.FeatureStep("broken", ("ghost",), lambda df: df)
    with pytest.raises(RuntimeError):
        X.FeaturePipeline([broken]).transform(two_entity_panel)
    X.FeaturePipeline([broken], validate_outputs=False).transform(two_entity_panel)
    pipe = X.FeaturePipeline([X.lag_step((1,)), X.calendar_step()])
    out = pipe.transform(two_entity_panel)
    assert set(pipe.feature_names) <= set(out.columns) and out.count() == 10


def test_default_pipeline_has_23_features(spark, two_entity_panel):
    stats = X.volume_stats(two_entity_panel)
    out = X.default_pipeline(stats).transform(two_entity_panel)
    assert len(X.feature_columns(out)) == 23
    assert out.count() == 10
    assert D("2024-01-01") in {r.shipment_date for r in out.select("shipment_date").collect()}
