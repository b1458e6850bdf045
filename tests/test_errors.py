"""Error behaviour of the API entry points, and no memory between calls."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from demandgrid.functions import calendar as cal
from demandgrid.functions import metrics as M
from demandgrid.operators import costs as CO
from demandgrid.operators import folds as FO
from demandgrid.operators import forecast as FC
from demandgrid.operators import windows as W
from demandgrid.operators import scoring as SC


def _preds(spark, rows):
    return spark.createDataFrame(rows, "n_shipments double, y_pred double")


@pytest.mark.parametrize("rows", [[], [(0.0, 1.0), (0.0, 2.0)]])
def test_strict_wape_needs_a_truth(spark, rows):
    with pytest.raises(Exception, match="truth"):
        M.strict_metrics(_preds(spark, rows)).collect()


def test_negative_costs(spark):
    df = _preds(spark, [(1.0, 2.0)])
    with pytest.raises(ValueError):
        CO.best_multiplier(df, [], -1.0, 1.0)


def test_empty_fold(spark, two_entity_panel):
    d = dt.date
    spec = ((1, d(2024, 1, 3), d(2024, 6, 1), d(2024, 6, 30), "x"),)
    with pytest.raises(ValueError, match="fold 1"):
        FO.check_nonempty(FO.assign_folds(two_entity_panel, spec), spec)


def test_short_history_names_the_rule(spark, two_entity_panel):
    state = FC.seasonal_naive_fit(two_entity_panel, 7)
    with pytest.raises(ValueError, match="season"):
        FC.check_min_history(state, 7)
    with pytest.raises(Exception, match="season"):
        FC.seasonal_naive_predict(state, 3, 7).collect()


@pytest.mark.parametrize("call", [lambda df: W.add_lags(df, ()), lambda df: W.add_lags(df, (0,)),
                                  lambda df: W.add_rolling(df, (7,), ("median",))])
def test_window_arguments(two_entity_panel, call):
    with pytest.raises(ValueError):
        call(two_entity_panel)


def test_request_window_limit_counts_both_ends(spark, two_entity_panel):
    d = dt.date
    rows = [("ok", d(2024, 2, 1), d(2024, 4, 30), [], None, None, True, True),      # 90 days
            ("long", d(2024, 2, 1), d(2024, 5, 1), [], None, None, True, True)]     # 91 days
    out = {r.request_id: r.reason for r in SC.validate_requests(
        SC.requests_frame(spark, rows), d(2024, 1, 5), two_entity_panel).collect()}
    assert out["ok"] is None and "90" in out["long"]
    assert SC.forecast_horizon(SC.validate_requests(SC.requests_frame(spark, rows), d(2024, 1, 5), two_entity_panel),
                               d(2024, 1, 5)) == (d(2024, 4, 30) - d(2024, 1, 5)).days


def test_easter_of_known_years(spark):
    known = {1961: (4, 2), 1981: (4, 19), 1954: (4, 18), 2000: (4, 23), 2024: (3, 31), 2038: (4, 25), 2285: (3, 22)}
    got = {r.y: (r.e.month, r.e.day) for r in spark.createDataFrame([(y,) for y in known], "y int")
           .select("y", cal.easter("y").alias("e")).collect()}
    assert got == known


def test_replaced_input_changes_the_result(spark):
    """Nothing is kept between calls: a table replaced under the same path (of a
    kind that os.stat cannot see) is read again."""
    from demandgrid.plans.queries import QUERIES
    src = "/root/testdata/sf0.001"
    folder = tempfile.mkdtemp(prefix="dg-replaced-")
    for t in ("orders", "customer", "nation", "region"):
        os.symlink(f"{src}/{t}.parquet", f"{folder}/{t}.parquet")
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    totals = []
    for part in (li, li.where(F.col("l_orderkey") % 2 == 0)):
        part.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
        totals.append(QUERIES["panel_summary"](spark, f"file:{folder}").first().total_shipments)
    assert totals[1] < totals[0]
