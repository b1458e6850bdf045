import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["shipment_date", "entity", "n_shipments"]
    assert len(df.columns) == 3 + 25          # 23 model features + is_operational + day_type


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_queries_run_on_smallest_data(spark):
    qs = entry.queries()
    for name in ("features_default", "backtest_metrics", "gain_by_fold", "conformal_offsets", "table_checks"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 1


def test_tree_scoring_serves_the_same_request_rows(spark):
    qs = entry.queries()
    sf = "/root/testdata/sf0.001"
    keys = lambda df: {(r.request_id, r.date, r.entity) for r in df.collect()}
    tree = qs["gbt_batch_scoring"](spark, sf)
    assert keys(tree) == keys(qs["batch_scoring"](spark, sf))
    rows = tree.where("lower_90 IS NOT NULL").collect()
    assert rows and all(0 <= r.lower_90 and r.lower_90 <= r.upper_90 + 1e-9 for r in rows)


def test_tree_backtest_baseline_rows_equal_the_checked_backtest(spark):
    """The seasonal-naive rows of the tree comparison are the oracle-checked
    backtest's (same folds, same rows): the pairing loses no test row."""
    qs = entry.queries()
    sf = "/root/testdata/sf0.001"
    tree = {r.fold_id: r for r in qs["gbt_backtest_metrics"](spark, sf).collect() if r.model == "seasonal_naive"}
    base = {r.fold_id: r for r in qs["backtest_metrics"](spark, sf).collect() if r.model == "seasonal_naive"}
    assert tree.keys() == base.keys() and len(tree) == 4
    for f in tree:
        assert tree[f].n_rows == base[f].n_rows
        for c in ("wape", "mae", "rmse", "bias"):
            assert (tree[f][c] is None and base[f][c] is None) or abs(tree[f][c] - base[f][c]) < 1e-6


def test_a_missing_optional_library_leaves_the_other_queries(monkeypatch):
    """A library that only the optional queries need may be absent: the entry
    still imports and offers all the others."""
    import importlib
    import sys
    for name in [m for m in sys.modules if m.startswith(("demandgrid.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    spec = importlib.util.spec_from_file_location("entry_without", entry.__file__)
    without = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(without)
    assert set(without.queries()) == set(without.QUERIES) and len(without.queries()) >= 50
