import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import scoring as SC
from demandgrid.operators import serving as SV
from demandgrid.sources.models import ModelStore
from tests.conftest import D

START = D("2023-10-02")


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(START + dt.timedelta(days=i), e, b + i % 7 + (i * 13) % 5) for i in range(200) for e, b in (("SP", 40), ("RJ", 9))]
    return spark.createDataFrame(rows, "shipment_date date, entity string, n_shipments long")


def values(panel, cutoff):
    """Last seven values of each entity up to the cut-off, by a driver loop."""
    rows = sorted((r.shipment_date, r.entity, r.n_shipments) for r in panel.collect() if r.shipment_date <= cutoff)
    return {e: [float(v) for _, k, v in rows if k == e][-7:] for e in ("SP", "RJ")}


def test_two_versions_are_served_from_their_state(spark, panel, tmp_path):
    models = ModelStore(spark, str(tmp_path / "models"))
    cuts = {"a": START + dt.timedelta(days=150), "b": START + dt.timedelta(days=180)}
    for version, cutoff in cuts.items():
        SV.train_version(models, panel, version, cutoff, holdout_days=20, calibration_days=30)
    day = cuts["b"] + dt.timedelta(days=3)
    early = cuts["a"] + dt.timedelta(days=1)
    requests = SC.requests_frame(spark, [("all", day, day + dt.timedelta(days=1), [], None, None, True, True),
                                         ("one", day, day, ["RJ"], 1.0, None, True, True),
                                         ("early", early, early, ["SP"], None, None, False, False),
                                         ("nobody", day, day, ["XX"], None, None, True, True)])
    info = {r.version: r for r in models.versions().collect()}
    for version, cutoff in cuts.items():
        out = SV.score_version(models, requests, version)
        assert str(tmp_path) in "".join(out.inputFiles())
        got = {(r.request_id, r.date, r.entity): r for r in out.collect()}
        want = {("all", day + dt.timedelta(days=k), e) for k in range(2) for e in ("SP", "RJ")} | {("one", day, "RJ")}
        assert set(got) == want | ({("early", early, "SP")} if version == "a" else set())
        last = values(panel, cutoff)
        for (request, date, entity), r in got.items():
            assert r.version == version
            assert r.point == last[entity][((date - cutoff).days - 1) % 7]
            if request != "early":
                assert r.upper_90 == pytest.approx(r.point + info[version].upper_offset)
                assert r.lower_90 == pytest.approx(max(r.point + info[version].lower_offset, 0.0))
    assert info["a"].data_cutoff == cuts["a"] and info["a"].n_entities == 2 and info["a"].eval_days == 20
    assert models.latest() == "b"
    assert {r.version for r in SV.score_version(models, requests).select("version").distinct().collect()} == {"b"}
    assert models.entities().count() == 4


def test_reading_a_version_reads_its_partition_only(spark, panel, tmp_path):
    models = ModelStore(spark, str(tmp_path / "m"))
    for version in ("a", "b"):
        SV.train_version(models, panel, version, START + dt.timedelta(days=150), holdout_days=20, calibration_days=30)
    shutil.rmtree(tmp_path / "m" / "state" / "batch=a")
    assert models.state("b").count() == 2


def test_versions_are_written_once_and_visible_when_whole(spark, panel, tmp_path):
    models = ModelStore(spark, str(tmp_path / "m"))
    state = spark.createDataFrame([("SP", [1.0])], "entity string, season_values array<double>")
    info = spark.createDataFrame([(D("2024-01-01"),)], "data_cutoff date")
    with pytest.raises(ValueError, match="info"):
        models.publish("x", state, info.unionAll(info))
    assert not models.has("x")
    # state without its row, as after a lost publication: not there
    from demandgrid.sources import incremental as INC
    INC.append_batch(state, str(tmp_path / "m" / "state"), "y")
    assert not models.has("y")
    with pytest.raises((KeyError, FileNotFoundError)):
        models.state("y")
    models.publish("y", state, info)
    assert models.state("y").count() == 1
    with pytest.raises(ValueError, match="published"):
        models.publish("y", state, info)
    with pytest.raises(KeyError):
        models.info("z")
    with pytest.raises(ValueError, match="no rows"):
        models.publish("w", state.where(F.lit(False)), info)


def test_too_short_a_history_raises(spark, panel, tmp_path):
    models = ModelStore(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="panel"):
        SV.train_version(models, panel, "x", START + dt.timedelta(days=10), holdout_days=20)
    assert not models.has("x")
