import pytest
import datetime as dt
import random

from pyspark.sql import functions as F

from demandgrid.operators import conformal as CF


def _synthetic(spark, days=200, seed=42):
    rng = random.Random(seed)
    base = {"SP": 100.0, "RJ": 20.0, "AC": 1.0}
    rows = []
    for i in range(days):
        d = dt.date(2023, 1, 1) + dt.timedelta(days=i)
        for e, b in base.items():
            wd = d.weekday()
            v = 0.0 if wd == 6 else (0.08 * b if wd == 5 else max(0.0, rng.gauss(b, 0.2 * b)))
            rows.append((d, e, int(round(v))))
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")


def test_offsets_and_interval_invariants(spark):
    df = _synthetic(spark)
    off = CF.conformal_offsets(CF.calibration_residuals(df, 60), 0.1).first()
    assert off.lower_offset <= off.upper_offset
    assert abs(off.coverage - 0.9) <= 0.05
    fc = CF.conformal_forecast(df, 14, CF.conformal_offsets(CF.calibration_residuals(df, 60), 0.1))
    rows = fc.collect()
    assert len(rows) == 42
    assert all(r.y_lower >= 0 and r.y_lower <= r.y_upper for r in rows)
    assert min(r.shipment_date for r in rows) == dt.date(2023, 7, 20)


def test_calibration_excluded_from_fit(spark):
    df = _synthetic(spark)
    last = dt.date(2023, 1, 1) + dt.timedelta(days=199)
    spiked = df.withColumn("n_shipments", F.when(F.col("shipment_date") > last - dt.timedelta(days=30),
                                                 F.col("n_shipments") + 1000).otherwise(F.col("n_shipments")))
    a = CF.calibration_residuals(df, 30).agg(F.sum("residual")).first()[0]
    b = CF.calibration_residuals(spiked, 30).agg(F.sum("residual")).first()[0]
    n = CF.calibration_residuals(df, 30).count()
    assert abs((b - a) - 1000 * n) < 1e-6        # only the truth moved, not the fitted base


def test_keyed_calibration_lengths(spark):
    df = _synthetic(spark).withColumn("calib_days", F.explode(F.array(F.lit(30), F.lit(60))))
    res = CF.calibration_residuals(df, None, keys=["calib_days"], calib_col="calib_days")
    off = {r.calib_days: r for r in CF.conformal_offsets(res, 0.1, ["calib_days"]).collect()}
    assert set(off) == {30, 60} and off[60].n_residuals > off[30].n_residuals


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from demandgrid.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(0)
    vals = {g: rng.normal(size=n) for g, n in (("a", 1), ("b", 2), ("c", 1000), ("d", 20000))}
    rows = [(g, float(v)) for g, vs in vals.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, residual double")
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "residual", probs, ["g"], slices=16).collect()}
    for g, vs in vals.items():
        want = np.quantile(vs, probs)
        assert [got[g][f"q_{i}"] for i in range(5)] == pytest.approx(list(want), abs=1e-12)
    ints = spark.createDataFrame([(float(i % 7),) for i in range(5000)], "residual double")
    one = exact_quantiles(ints, "residual", [0.05, 0.95]).first()
    assert (one.q_0, one.q_1) == tuple(np.quantile([i % 7 for i in range(5000)], [0.05, 0.95]))


def test_quantiles_of_few_distinct_values(spark):
    """A million rows with seven values: ties are counted, not collected."""
    import numpy as np
    from pyspark.sql import functions as F
    from demandgrid.functions.quantiles import exact_quantiles
    df = spark.range(1_000_000).select((F.col("id") * F.col("id") % 7 - 3).cast("double").alias("residual"))
    probs = [0.05, 0.3333, 0.5, 0.95]
    row = exact_quantiles(df, "residual", probs, count_col="n").first()
    ids = np.arange(1_000_000, dtype=np.int64)
    expected = np.quantile((ids * ids % 7 - 3).astype(float), probs)
    assert row.n == 1_000_000 and np.allclose([row[f"q_{i}"] for i in range(4)], expected)


def test_empty_calibration_is_an_error(spark):
    import pytest
    from demandgrid.operators.conformal import conformal_offsets
    with pytest.raises(ValueError):
        conformal_offsets(spark.createDataFrame([], "residual double"))
