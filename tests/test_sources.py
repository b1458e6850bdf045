import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import checks as CH
from demandgrid.sources import profile as PR
from demandgrid.sources import state as ST
from demandgrid.sources import tables as S
from tests.conftest import D


def test_panel_table_roundtrip_and_pruning(spark, two_entity_panel):
    path = os.path.join(tempfile.mkdtemp(prefix="dg-panel-"), "panel")
    S.write_panel(two_entity_panel, path)
    S.write_panel(two_entity_panel, path)                 # overwrite, not append
    back = S.read_panel(spark, path)
    assert back.count() == 10 and back.columns == ["shipment_date", "entity", "n_shipments"]
    plan = spark.read.parquet(path).where(F.col("month") == "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    with pytest.raises(FileNotFoundError):
        S.read_panel(spark, path + "-missing")


def test_metadata_roundtrip_and_type_check(spark, two_entity_panel):
    path = tempfile.mkdtemp(prefix="dg-model-")
    ST.write_state(two_entity_panel.groupBy("entity").agg(F.max("n_shipments").alias("last_value")), path)
    meta = {"version": "1", "trained_at": dt.datetime(2024, 1, 6), "last_train_date": D("2024-01-05"),
            "data_cutoff": D("2024-01-05"), "n_features": 1, "n_groups": 2, "groups": ["RJ", "SP"],
            "evaluation_metrics": (D("2024-01-01"), D("2024-01-05"), 5, 0.1, 1.0, 2.0),
            "evaluation_note": "x"}
    ST.write_metadata(spark, path, "naive", meta, extra={"version": "2", "owner": "team"})
    state, md = ST.read_model(spark, path, "naive")
    assert state.count() == 2
    row = md.first()
    assert row.version == "2" and json.loads(row.extra) == {"owner": "team"}
    info = ST.model_info(md).first()
    assert info.eval_wape == 0.1 and info.groups == ["RJ", "SP"]
    with pytest.raises(TypeError):
        ST.read_model(spark, path, "seasonal_naive")


def test_read_params(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="dg-params-"), "best.json")
    with open(path, "w") as f:
        json.dump({"best_wape": 0.4, "best_params": {"max_depth": 5, "step_size": 0.12}}, f, indent=2)
    assert S.read_table is not None
    assert ST.read_params(spark, path, ("max_depth",)) == {"max_depth": 5, "step_size": 0.12}
    with pytest.raises(KeyError):
        ST.read_params(spark, path, ("min_instances",))


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, None)], "k long, n int, v string")
    nulls = {r.column_name: r.n_violations for r in CH.null_counts(df, ["k", "v"], "t").collect()}
    assert nulls == {"k": 0, "v": 1}
    dup = CH.duplicate_keys(df, ["k", "n"], "t").first()
    assert dup.n_duplicate_keys == 1 and dup.n_extra_rows == 1
    parent = spark.createDataFrame([(1,)], "k long")
    assert CH.orphans(df, parent, "k", "k", "t").first().n_orphans == 1
    with pytest.raises(ValueError):
        CH.assert_clean(CH.null_counts(df, ["v"], "t"), "n_violations")
    prof = {r.column_name: r for r in PR.column_profile(df, "t").collect()}
    assert prof["v"].n_nulls == 1 and prof["k"].n_distinct == 2 and prof["v"].pct_nulls == 33.33
    rec = {r.table_name: r.status for r in PR.reconcile(spark, {"t": 3, "u": 1},
                                                          PR.row_counts({"t": df, "u": parent.limit(0)})).collect()}
    assert rec == {"t": "ok", "u": "MISMATCH"}


def test_contract_report_one_pass(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, None)], "k long, q double")
    rep = {(r.check, r.column_name): r.n_violations for r in
           CH.contract_report(df, "t", ["k", "q"], {"q_pos": F.col("q") > 0}).collect()}
    assert rep == {("not_null", "k"): 1, ("not_null", "q"): 1, ("rule", "q_pos"): 1}


def test_csv_sink_and_scan(spark, two_entity_panel):
    path = os.path.join(tempfile.mkdtemp(prefix="dg-csv-"), "preds")
    S.write_table(two_entity_panel, path, fmt="csv")
    back = S.read_csv(spark, path, "shipment_date date, entity string, n_shipments long")
    assert sorted(back.collect()) == sorted(two_entity_panel.collect())


def test_products_rename_and_category_join(spark):
    path = tempfile.mkdtemp(prefix="dg-raw-")
    with open(os.path.join(path, "products.csv"), "w") as f:
        f.write("product_id,product_category_name,product_name_lenght,product_description_lenght,"
                "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
                "p1,beleza,10,100,1,200,10,10,10\np2,,12,80,2,300,20,5,5\np3,outra,5,50,1,100,5,5,5\n")
    with open(os.path.join(path, "translation.csv"), "w") as f:
        f.write("product_category_name,product_category_name_english\nbeleza,beauty\n")
    prods = S.read_raw_csv(spark, os.path.join(path, "products.csv"), "products")
    assert "product_name_length" in prods.columns and "product_name_lenght" not in prods.columns
    tr = S.read_raw_csv(spark, os.path.join(path, "translation.csv"), "translation")
    got = {r.product_id: r.product_category_name_english for r in S.products_with_category(prods, tr).collect()}
    assert got == {"p1": "beauty", "p2": None, "p3": None}       # unmatched kept, NULL never matches


def test_scale_conf_sizes_partitions(spark):
    from demandgrid.session import input_bytes, scale_conf
    path = S.table_path("/root/testdata/sf0.001", "lineitem")
    n = input_bytes(spark, [path])
    assert n == (os.path.getsize(path) if os.path.isfile(path) else n) and n > 0
    small = scale_conf(n, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"           # floor: 3 per core
    big = scale_conf(100 << 40, 8000)                               # 100 TB on 8,000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 40960        # 10 TB shuffled / 256 MB
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
    with pytest.raises(ValueError):
        scale_conf(1, 0)


def test_ordered_load_returns_the_rows_of_each_table(spark, tmp_path):
    """Raw CSVs -> tables, in load order, reconciled against what was stored."""
    from pyspark.sql import types as T

    from demandgrid.sources import profile as PR
    from demandgrid.sources import tables as S
    value = {T.StringType: "a", T.IntegerType: "1", T.LongType: "1", T.DoubleType: "1.5", T.TimestampType: "2018-01-02 03:04:05"}
    for name, schema in S.RAW_SCHEMAS.items():
        line = ",".join(value[type(f.dataType)] for f in schema.fields)
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(schema.names), *[line] * 3]) + "\n")
    rows = S.load_raw(spark, str(tmp_path), str(tmp_path / "out"))
    assert rows == dict.fromkeys(S.RAW_SCHEMAS, 3) and list(rows) == list(S.RAW_SCHEMAS)
    stored = PR.row_counts({t: spark.read.parquet(str(tmp_path / "out" / t)) for t in rows})
    assert {r.status for r in PR.reconcile(spark, rows, stored).collect()} == {"ok"}


def test_read_panel_names_a_missing_table_only(spark, tmp_path):
    import pytest

    from demandgrid.sources import tables as S
    with pytest.raises(FileNotFoundError):
        S.read_panel(spark, str(tmp_path / "none"))
    spark.range(2).write.parquet(str(tmp_path / "other"))
    with pytest.raises(Exception, match="shipment_date"):
        S.read_panel(spark, str(tmp_path / "other"))


def test_several_foreign_keys_in_one_scan(spark, capsys):
    from demandgrid.operators import checks as CH
    child = spark.createDataFrame([(1, 10), (1, 99), (7, None), (None, 98), (8, 99)], "a int, b long")
    one, two = spark.createDataFrame([(1,), (2,)], "p long"), spark.createDataFrame([(10,)], "q int")
    keys = [("a", one, "p"), ("b", two, "q"), ("a", child, "a")]
    out = {r.fk: r.n_orphans for r in CH.orphans_many(child, keys, "t").collect()}
    assert out == {"a->p": 2, "b->q": 3, "a->a": 0}
    for c, parent, p in keys:
        assert out[f"{c}->{p}"] == CH.orphans(child, parent, c, p, "t").first().n_orphans
