"""Prefix states against separate fits, ranks against brute force, errors."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import conformal as CF
from demandgrid.operators import evaluation as E
from demandgrid.operators import forecast as FC
from tests.conftest import D

SPEC = ((1, D("2024-02-10"), D("2024-02-11"), D("2024-02-25"), "a"),
        (2, D("2024-03-01"), D("2024-03-02"), D("2024-03-20"), "b"),
        (3, D("2024-02-20"), D("2024-02-28"), D("2024-03-05"), "gap and overlap"))


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(11)
    rows = [(D("2024-01-01") + dt.timedelta(days=i), e, rng.randint(0, 30))
            for e, first in (("A", 0), ("B", 0), ("late", 45)) for i in range(first, 90)]
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long").cache()


def _rounded(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_backtest_equals_a_fit_per_fold(panel):
    cols = ["shipment_date", "entity", "y_pred", "y_lower", "y_upper"]
    out = E.backtest(panel, spec=SPEC)
    for fid, end, first, last, _ in SPEC:
        train = panel.where(F.col("shipment_date") <= F.lit(end))
        n_days = (last - first).days + 1
        tests = panel.where(F.col("shipment_date").between(F.lit(first), F.lit(last))).select("shipment_date", "entity")
        for model, pred in (("naive", FC.naive_predict(FC.naive_fit(train), n_days)),
                            ("seasonal_naive", FC.seasonal_naive_predict(FC.seasonal_naive_fit(train), n_days))):
            got = out.where((F.col("model") == model) & (F.col("fold_id") == fid))
            want = pred.join(tests, ["shipment_date", "entity"])
            assert _rounded(got, cols) == _rounded(want, cols), (fid, model)
    assert "late" not in {r.entity for r in out.where(F.col("fold_id") == 1).collect()}


def test_calibration_lengths_equal_copies(panel):
    hist = panel.where(F.col("entity") != "late")
    lengths = (5, 12, 30)
    keyed = hist.withColumn("calib_days", F.explode(F.array(*[F.lit(n) for n in lengths])))
    cols = ["calib_days", "shipment_date", "entity", "residual"]
    want = CF.calibration_residuals(keyed, None, keys=["calib_days"], calib_col="calib_days")
    assert _rounded(CF.residuals_by_length(hist, lengths), cols) == _rounded(want, cols)


def test_history_is_shuffled_once_and_not_copied(panel, capsys):
    CF.residuals_by_length(panel, (5, 12, 30)).explain("simple")
    plan = capsys.readouterr().out.split("Subqueries")[0]
    assert plan.count("hashpartitioning(entity") == 1 and "Join" not in plan
    above = plan[:plan.index("hashpartitioning(entity")]
    assert "Generate" in above and "Generate" not in plan[len(above):]


@pytest.mark.parametrize("spec, side", [
    (((1, D("2024-02-10"), D("2025-02-11"), D("2025-02-25"), "x"),), "test rows for 1"),
    (((7, D("2023-02-10"), D("2024-02-11"), D("2024-02-25"), "x"),), "train rows for 7")])
def test_empty_fold_raises_through_the_backtest(panel, spec, side):
    with pytest.raises(Exception, match=side):
        E.metrics_by(E.backtest(panel, spec=spec), ["model"]).collect()


def test_no_event_rows_and_missing_columns_raise(panel):
    preds = panel.withColumn("y_pred", F.lit(1.0))
    with pytest.raises(ValueError, match="no row within"):
        E.wape_in_event_window(preds, [D("1999-01-01")])
    assert E.wape_in_event_window(preds, [D("2024-01-05")], 1).first().n_rows == 6
    with pytest.raises(KeyError, match="y_pred"):
        E.metrics_by(panel, ["entity"])
    with pytest.raises(KeyError, match="n_shipments"):
        E.backtest(panel.drop("n_shipments"), spec=SPEC)


def _ranks(v):
    return [sum(o < x for o in v) + (sum(o == x for o in v) + 1) / 2 for x in v]


def _p(r, n):
    """Riemann sum of the density in the angle, fine enough for small n."""
    k, lo = 200000, math.asin(abs(r))
    area = lambda a: sum(math.cos(a + (math.pi / 2 - a) * (i + .5) / k) ** (n - 3) for i in range(k)) * (math.pi / 2 - a) / k
    return area(lo) / area(0.0)


@pytest.mark.parametrize("n, kinds", [(400, 12), (25, 1000), (4, 50)])
def test_spearman_and_p_value(spark, n, kinds):
    rng = random.Random(n)
    x = [rng.randint(0, kinds) for _ in range(n)]
    y = [v + rng.randint(0, 3 * kinds) for v in x]
    rows = [*zip(x, y), (None, 1), (1, None)]
    got = E.spearman(spark.createDataFrame(rows, "a int, b int"), "a", "b").first()
    rx, ry = _ranks(x), _ranks(y)
    mx, my = sum(rx) / n, sum(ry) / n
    r = sum((a - mx) * (b - my) for a, b in zip(rx, ry)) / math.sqrt(sum((a - mx) ** 2 for a in rx) * sum((b - my) ** 2 for b in ry))
    assert got.n == n and math.isclose(got.spearman, r, rel_tol=1e-9)
    assert math.isclose(got.p_value, _p(r, n), rel_tol=1e-6)


def test_p_value_at_the_ends(spark):
    df = spark.createDataFrame([(1.0, 30), (0.0, 3), (0.0, 10 ** 7), (0.5, 2), (0.001, 10 ** 6)], "r double, n long")
    p = [row.p for row in df.select(E.correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()]
    assert p[0] == 0 and math.isclose(p[1], 1) and math.isclose(p[2], 1) and p[3] is None
    assert math.isclose(p[4], math.erfc(1.0 / math.sqrt(2)), rel_tol=1e-4)      # t is 1, almost normal


def test_ranks_take_few_exchanges(spark, capsys):
    df = spark.createDataFrame([(i % 7, i % 5) for i in range(50)], "a int, b int")
    E.spearman(df, "a", "b").explain("simple")
    assert capsys.readouterr().out.count("Exchange ") < 15
