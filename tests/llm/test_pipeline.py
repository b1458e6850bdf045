import os
import shutil
import tempfile

import corpus_pipeline as CP
from demandgrid.llm import queries
from demandgrid.llm.common import table
from tests.llm.helpers import AWKWARD, frame

SF = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark):
    docs = table(spark, SF, "documents")
    seen = [docs.count()]
    for name, stage in CP.STAGES:
        docs = CP.cut(stage(spark, docs, SF))
        seen.append(docs.select("doc_id").distinct().count())
        if name != CP.STAGES[-1][0]:
            assert docs.columns == CP.COLUMNS
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not [i for i in kept if labels.get(i) == 0]


def test_stages_on_awkward_and_empty_documents(spark):
    folder = tempfile.mkdtemp(prefix="llm-labels-")
    shutil.copy(f"{SF}/labels.parquet", os.path.join(folder, "labels.parquet"))
    for rows in (AWKWARD, []):
        for _, stage in CP.STAGES:
            assert stage(spark, frame(spark, rows), folder).count() >= 0


def test_names():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE) <= set(queries.QUERIES)
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
