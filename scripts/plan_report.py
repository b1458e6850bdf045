"""Physical-plan summary of the headline queries (writes PLANS.md).

Usage: python scripts/plan_report.py [sf_dir] [out.md]
For each query: exchanges by kind, join strategies, windows, pandas
(Arrow) nodes, codegen stages, and every Parquet scan with its pushed
filters and read schema. The fact path is shown on its own
(``shipment_counts``): downstream queries start from the checkpointed panel.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandgrid.plans.queries import QUERIES  # noqa: E402
from demandgrid.session import get_spark  # noqa: E402
from demandgrid.sources import tables as S  # noqa: E402

SHOWN = ("panel_nation", "features_default", "features_sql_table", "backtest_metrics", "gain_by_fold",
         "conformal_coverage_by_calibration", "batch_scoring", "table_checks", "events_panel_features",
         "decomposition_backtest_metrics")

COUNTS = {
    "hash exchanges": r"Exchange hashpartitioning",
    "single-partition exchanges": r"Exchange SinglePartition",
    "range exchanges": r"Exchange rangepartitioning",
    "broadcast exchanges": r"BroadcastExchange",
    "reused exchanges": r"ReusedExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "cartesian products": r"CartesianProduct",
    "nested-loop joins": r"BroadcastNestedLoopJoin",
    "windows": r"(?<!\w)Window \[",
    "pandas (Arrow) nodes": r"FlatMapGroupsInPandas|ArrowEvalPython|MapInPandas",
    "row-at-a-time Python UDF nodes": r"BatchEvalPython",
    "codegen stages": r"\*\(\d+\)",
}


def summarize(name: str, df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [f"### {name}", ""]
    counts = {k: len(re.findall(p, plan)) for k, p in COUNTS.items()}
    lines.append(", ".join(f"{k}: {v}" for k, v in counts.items()))
    lines.append("")
    for scan in sorted({m.group(0) for m in re.finditer(r"FileScan parquet [^\n]*", plan)}):
        table = re.search(r"/([a-z_]+)\.parquet", scan) or re.search(r"default\.([a-z_]+)\[", scan)
        pushed = re.search(r"PushedFilters: (\[.*?\]), ReadSchema", scan)
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", scan)
        lines.append(f"- scan `{table.group(1) if table else '?'}`: pushed {pushed.group(1) if pushed else '[]'}; "
                     f"read `{schema.group(1) if schema else '?'}`")
    lines.append("")
    return lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="demandgrid-plans-wh-")})
    names = S.write_bucketed_facts(spark, sf_dir, tempfile.mkdtemp(prefix="demandgrid-plans-bk-"), 8)
    # Static plans: the strategy Catalyst picks before runtime statistics
    # (AQE may still turn a sort-merge join into a broadcast join on small
    # data); broadcasts by size are off so the plan is the one a cluster-size
    # input gets.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    doc = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/plan_report.py` on `{sf_dir}` with AQE off and size-based broadcasts off,",
           "i.e. the static plan a cluster-size input gets (explicit broadcasts of parameter-bounded tables",
           "remain). Counts are plan nodes; scans list the filters pushed into the Parquet reader and the",
           "pruned read schema.", "",
           "Reading it: only the fact path scans data that grows with the input. Its three sort-merge joins",
           "are the two key joins of `lineitem ⋈ orders ⋈ customer` plus the 25-row nation lookup, which",
           "Spark's size rule turns into a broadcast join at any scale (size broadcasts are off here). Every",
           "scan reads only the columns it needs and the status and NOT NULL predicates reach the Parquet",
           "reader. Over the order-key bucketed facts the line items are read bucket by bucket and their",
           "exchange disappears (one hash exchange fewer; only the orders-with-nation side is shuffled).",
           "All later queries start from the checkpointed panel (`Scan ExistingRDD`). No plan has a",
           "row-at-a-time Python UDF; the only Arrow node is the decomposition's solver. `table_checks`",
           "scans each fact table once per check on purpose: every check is one aggregate or one anti join,",
           "and the NOT NULL counts need unfiltered rows.", ""]
    doc += summarize("fact path: shipment_counts (nation grain)", S.shipment_counts(spark, sf_dir, "nation"))
    doc += summarize("fact path over order-key bucketed facts: bucketed_shipment_counts",
                     S.bucketed_shipment_counts(spark, sf_dir, names, "nation"))
    for name in SHOWN:
        doc += summarize(name, QUERIES[name](spark, sf_dir))
    with open(out, "w") as f:
        f.write("\n".join(doc))
    print(f"wrote {out}")


if __name__ == "__main__":
    main(sys.argv)
