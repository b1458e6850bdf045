"""Day-based windows over a panel with holes equal the dense windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import panel as P
from demandgrid.operators import sparse as SP
from demandgrid.operators import windows as W
from tests.conftest import D

KEY = ["shipment_date", "entity"]


@pytest.fixture(scope="module")
def counts(spark):
    rng = random.Random(21)
    rows = [(D("2024-01-01") + dt.timedelta(days=i), e, rng.randint(1, 40)) for e, keep in (("A", .9), ("B", .3), ("rare", .05))
            for i in range(120) if rng.random() < keep]
    rows += [(D("2024-01-01"), "first", 3), (D("2024-05-15"), "last", 1000000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long").cache()


def _table(df):
    return {(r.shipment_date, r.entity): r.asDict() for r in df.collect()}


def _same(got, want):
    assert got.keys() <= want.keys() and got
    for k, r in got.items():
        for c, v in r.items():
            assert v == (pytest.approx(want[k][c], abs=1e-9) if want[k][c] is not None else None), (k, c)


def test_sql_features_equal_the_dense_table(counts):
    got = _table(SP.sql_feature_table(counts))
    assert len(got) == counts.count()
    _same(got, _table(W.sql_feature_table(P.densify(counts))))


@pytest.mark.parametrize("min_periods", [1, 3])
def test_all_stats_equal_the_dense_windows(counts, min_periods):
    cols = SP.rolling_columns((1, 2, 7, 28), W.ROLLING_STATS, min_periods)
    got = _table(SP.with_day(counts).withColumns(cols).drop(SP.DAY, SP.AGE))
    _same(got, _table(W.add_rolling(P.densify(counts), (1, 2, 7, 28), W.ROLLING_STATS, min_periods)))


def test_earlier_start_and_keys(spark, counts):
    start = D("2023-12-20")
    keyed = counts.withColumn("fold_id", F.explode(F.array(F.lit(1), F.lit(2)))).where(
        (F.col("fold_id") == 1) | (F.col("shipment_date") > F.lit(D("2024-02-01"))))
    out = SP.with_day(keyed, start).withColumns(SP.lag_columns((1, 14), keys=["fold_id"])).where(F.col("fold_id") == 2)
    alone = counts.where(F.col("shipment_date") > F.lit(D("2024-02-01")))
    want = _table(W.add_lags(P.densify(alone, start=start), (1, 14)))
    _same({k: {c: r[c] for c in ("lag_1", "lag_14")} for k, r in _table(out).items()}, want)


def test_one_shuffle_no_grid_and_errors(counts, capsys):
    SP.sql_feature_table(counts, start=D("2024-01-01")).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 1 and "Join" not in plan and "Generate" not in plan
    with pytest.raises(ValueError):
        SP.lag_columns((0,))
    with pytest.raises(ValueError):
        SP.rolling_columns((7,), ("median",))
    with pytest.raises(KeyError, match="entity"):
        SP.sql_feature_table(counts.drop("entity"))
    assert SP.sql_feature_table(counts.limit(0)).collect() == []
