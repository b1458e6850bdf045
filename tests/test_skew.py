"""Hot keys in the fact path: one customer owns a third of the orders and
one order a third of the line items. The shipment counts must stay exact,
and with broadcasts off (as for tables of cluster size) AQE must split the
hot partition of the sort-merge join instead of giving it to one task."""

import collections
import datetime as dt
import os
import tempfile

from demandgrid.sources import tables as S


def _skewed_tables(spark, root):
    n_orders, hot_cust, hot_order = 600, 7, 1
    orders = [(k, hot_cust if k % 3 == 0 else 100 + k, "FOP"[k % 3]) for k in range(1, n_orders + 1)]
    lines, day0 = [], dt.date(2020, 1, 1)
    for k in range(1, n_orders + 1):
        for ln in range(1, 3):
            lines.append((k, ln, dt.datetime.combine(day0 + dt.timedelta(days=(k * ln) % 40), dt.time())))
    # The hot order carries as many lines as all the others together.
    lines += [(hot_order, 10 + i, dt.datetime.combine(day0 + dt.timedelta(days=i % 40), dt.time()))
              for i in range(len(lines))]
    customers = [(c, c % 5) for c in {o[1] for o in orders}]
    frames = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp"),
        "customer": spark.createDataFrame(customers, "c_custkey long, c_nationkey int"),
        "nation": spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(5)],
                                        "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
    }
    for name, df in frames.items():
        df.repartition(4).write.mode("overwrite").parquet(S.table_path(root, name))
    return orders, lines, dict(customers)


def test_hot_keys_exact_counts_and_split_join(spark):
    root = tempfile.mkdtemp(prefix="dg-skew-")
    orders, lines, nation_of = _skewed_tables(spark, root)
    status = {k: s for k, _, s in orders}
    cust = {k: c for k, c, _ in orders}
    expect = collections.Counter((ts.date(), f"N{nation_of[cust[k]]}") for k, _, ts in lines
                                 if status[k] in ("F", "O"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = S.shipment_counts(spark, root, "nation")
        got = {(r.shipment_date, r.entity): r.n_shipments for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == dict(expect)
    assert "skew=true" in plan.replace(" ", "").lower() or "isskewjoin=true" in plan.replace(" ", "").lower(), plan
    assert os.path.isdir(root)


def test_bucketed_facts_skip_the_line_item_shuffle(spark):
    import uuid
    sf = "/root/testdata/sf0.001"
    tag = uuid.uuid4().hex[:8]
    names = (f"facts_lineitem_{tag}", f"facts_orders_{tag}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    S.write_bucketed_facts(spark, sf, tempfile.mkdtemp(prefix="dg-bucketed-"), n, names)
    want = {tuple(r) for r in S.shipment_counts(spark, sf, "nation").collect()}
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = S.bucketed_shipment_counts(spark, sf, names, "nation")
        got = {tuple(r) for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want
    assert "Bucketed: true" in plan
    assert "hashpartitioning(l_orderkey" not in plan              # line items are not shuffled
