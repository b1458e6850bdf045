import datetime as dt

from pyspark.sql import functions as F

from demandgrid.operators import panel as P
from demandgrid.sources import tables as S
from tests.conftest import D


def test_raw_layout_panel_zero_fills(spark):
    customers = spark.createDataFrame(
        [("c1", "u1", 1000, "sao paulo", "SP"), ("c2", "u2", 2000, "rio", "RJ"), ("c3", "u3", 3000, "bh", "MG")],
        S.RAW_SCHEMAS["customers"])
    ts = lambda s: dt.datetime.fromisoformat(s) if s else None
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", ts("2017-01-01 10:00:00"), None, ts("2017-01-02 09:00:00"), None, None),
        ("o2", "c2", "shipped", ts("2017-01-01 11:00:00"), None, ts("2017-01-03 12:00:00"), None, None),
        ("o3", "c3", "canceled", ts("2017-01-01 12:00:00"), None, None, None, None),
    ], S.RAW_SCHEMAS["orders"])
    panel = P.build_panel(S.raw_shipments(orders, customers), entity_col="customer_state")
    rows = {(r.shipment_date, r.customer_state): r.n_shipments for r in panel.collect()}
    assert len(rows) == 4                      # 2 days x {SP, RJ}; MG never shipped
    assert sum(rows.values()) == 2
    assert rows[(D("2017-01-02"), "RJ")] == 0 and rows[(D("2017-01-03"), "SP")] == 0


def test_densify_fills_gaps_and_summary(spark):
    counts = spark.createDataFrame([(D("2020-01-01"), "A", 3), (D("2020-01-04"), "A", 1), (D("2020-01-02"), "B", 2)],
                                   "shipment_date date, entity string, n_shipments long")
    panel = P.densify(counts)
    assert panel.count() == 8
    s = P.panel_summary(panel).first()
    assert (s.total_rows, s.n_days, s.n_entities, s.total_shipments, s.zero_days) == (8, 4, 2, 6, 5)
    assert s.first_date == D("2020-01-01") and s.last_date == D("2020-01-04")


def test_filters(spark, two_entity_panel):
    assert P.with_cutoff(two_entity_panel, D("2024-01-02")).count() == 4
    assert P.date_window(two_entity_panel, D("2024-01-02"), D("2024-01-03")).count() == 4
    assert P.trailing_days(two_entity_panel, 1).count() == 4
    assert P.entity_filter(two_entity_panel, []).count() == 10
    assert P.entity_filter(two_entity_panel, ["SP"]).count() == 5


def test_shipments_on_driver_tables(spark):
    panel = P.panel_from_counts(S.shipment_counts(spark, "/root/testdata/sf0.001", "region"))
    s = P.panel_summary(panel).first()
    assert s.total_rows == s.n_days * s.n_entities
    assert s.n_entities == 5
    raw = S.shipments(spark, "/root/testdata/sf0.001", "region").count()
    assert s.total_shipments == raw
