"""Appends that can be repeated, and a stored panel that equals a full rebuild."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import panel as P
from demandgrid.sources import incremental as INC
from demandgrid.sources import tables as S
from tests.conftest import D

SCHEMA = "shipment_date date, entity string, n_shipments long"


def _batch(seed, first, days, entities, n=60):
    rng = random.Random(seed)
    got = {}
    for _ in range(n):
        key = (D(first) + dt.timedelta(days=rng.randrange(days)), rng.choice(entities))
        got[key] = got.get(key, 0) + rng.randint(1, 4)
    ends = [(D(first), entities[0]), (D(first) + dt.timedelta(days=days - 1), entities[-1])]
    return [(d, e, c) for (d, e), c in {**dict.fromkeys(ends, 1), **got}.items()]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _full(spark, *batches):
    all_rows = _frame(spark, [r for b in batches for r in b]).groupBy("shipment_date", "entity").agg(
        F.sum("n_shipments").alias("n_shipments"))
    return _rows(P.densify(all_rows))


def _stamps(path):
    return {m: sorted((f, os.stat(f"{path}/{m}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{m}"))
            for m in os.listdir(path) if m.startswith("month=")}


@pytest.fixture
def stored(spark):
    return INC.PanelStore(spark, tempfile.mkdtemp(prefix="dg-panel-"))


def test_batches_equal_a_full_rebuild_and_touch_their_months_only(spark, stored):
    a, late = _batch(1, "2024-01-10", 150, ["A", "B", "C"]), _batch(2, "2024-03-03", 40, ["A", "C"])
    assert stored.load(_frame(spark, a), "a").whole
    before = _stamps(stored.panel_path)
    loaded = stored.load(_frame(spark, late), "late")
    after = _stamps(stored.panel_path)
    assert loaded.months == ("2024-03", "2024-04") and not loaded.whole
    assert {m for m in after if after[m] != before[m]} == {"month=2024-03", "month=2024-04"}
    assert _rows(stored.panel()) == _full(spark, a, late)
    again = stored.load(_frame(spark, late), "late")
    assert again.months == loaded.months and _rows(stored.panel()) == _full(spark, a, late)


def test_corrected_batch_replaces_its_earlier_version(spark, stored):
    a, wrong = _batch(3, "2024-01-01", 120, ["A", "B"]), _batch(4, "2024-02-01", 60, ["A", "B"])
    right = _batch(5, "2024-03-05", 9, ["B"])
    stored.load(_frame(spark, a), "01")
    stored.load(_frame(spark, wrong), "1")               # another batch than "01"
    loaded = stored.load(_frame(spark, right), "1")
    assert {"2024-02", "2024-03"} <= set(loaded.months) and not loaded.whole
    assert _rows(stored.panel()) == _full(spark, a, right)


def test_longer_range_new_entity_and_shrunk_range(spark, stored):
    a, b = _batch(6, "2024-02-10", 30, ["A", "B"]), _batch(7, "2024-05-05", 10, ["A", "B"])
    stored.load(_frame(spark, a), "a")
    assert stored.load(_frame(spark, b), "b").months == ("2024-03", "2024-04", "2024-05")
    assert _rows(stored.panel()) == _full(spark, a, b)
    c = _batch(8, "2024-04-01", 5, ["new"])
    assert stored.load(_frame(spark, c), "c").whole
    assert _rows(stored.panel()) == _full(spark, a, b, c)
    stored.load(_frame(spark, []), "b")                  # withdrawn: the range ends earlier
    assert _rows(stored.panel()) == _full(spark, a, c)
    for name in "ac":
        stored.load(_frame(spark, []), name)
    assert stored.panel().count() == 0
    stored.load(_frame(spark, a), "a")
    assert _rows(stored.panel()) == _full(spark, a)


def test_lost_panel_write_is_mended_by_the_same_batch(spark, stored):
    a = _batch(9, "2024-01-01", 100, ["A", "B"])
    stored.load(_frame(spark, a), "a")
    own = f"{stored.panel_path}/month=2024-02"
    for f in os.listdir(own):
        os.unlink(f"{own}/{f}")
    late = _batch(10, "2024-03-01", 5, ["A"])
    assert stored.load(_frame(spark, late), "late").whole
    assert _rows(stored.panel()) == _full(spark, a, late)


def test_empty_first_batch_and_bad_ids(spark, stored):
    assert stored.load(_frame(spark, []), "none").months == ()
    assert stored.panel() is None or stored.panel().count() == 0
    for bad in ("", "a/b", "x=1"):
        with pytest.raises(ValueError, match="batch"):
            stored.load(_frame(spark, []), bad)
    with pytest.raises(KeyError):
        stored.load(_frame(spark, []).drop("entity"), "x")


def test_append_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="dg-append-") + "/t"
    one, two = spark.range(5).toDF("x"), spark.range(100, 103).toDF("x")
    assert INC.append_batch(one, path, "01") == 5 and INC.append_batch(two, path, "1") == 3
    assert INC.append_batch(one, path, "01") == 5
    assert sorted(map(tuple, INC.read_batches(spark, path).collect())) == \
        [*((i, "01") for i in range(5)), *((i, "1") for i in range(100, 103))]
    with pytest.raises(FileNotFoundError):
        INC.read_batches(spark, path + "-none")
    with pytest.raises(ValueError, match="batch"):
        INC.append_batch(one.withColumn("batch", F.lit(1)), path, "2")


def test_load_raw_appends_by_batch(spark):
    src, out = tempfile.mkdtemp(prefix="dg-raw-"), tempfile.mkdtemp(prefix="dg-raw-out-")
    for table, schema in S.RAW_SCHEMAS.items():
        with open(f"{src}/{table}.csv", "w") as f:
            f.write(",".join(schema.names) + "\n" + ",".join("1" for _ in schema.names) + "\n")
    for batch in ("jan", "feb", "jan"):
        assert set(S.load_raw(spark, src, out, batch).values()) == {1}
    assert INC.read_batches(spark, f"{out}/sellers").count() == 2
