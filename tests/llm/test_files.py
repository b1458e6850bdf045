import time

from pyspark.sql import functions as F

from demandgrid.llm import substring as S
from demandgrid.llm.common import REMOVE_SHUFFLES, cut


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in found.mkString("\n").split("\n") if "/shuffle_" in x}


def test_cut_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(REMOVE_SHUFFLES, None)
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    out = cut(df)
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(REMOVE_SHUFFLES, None) == setting
    want = [(k, 100) for k in range(10)]
    assert sorted(map(tuple, out.collect())) == want and sorted(map(tuple, df.collect())) == want
    assert sorted(map(tuple, df.join(out.select("k"), "k").collect())) == want


def test_links_are_only_pairs_that_are_similar(spark):
    s = S.Settings(sketch=64, margin=1.0)               # sketches rule out nothing
    sets = {1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 5], 3: [1, 2, 3, 4, 6], 4: [1, 2, 3, 4]}
    grams = spark.createDataFrame([(c, x, [0]) for c, x in sets.items()], "content long, grams array<long>, sketch array<long>")
    rest = spark.createDataFrame([(7, c, c) for c in sets] + [(8, 1, 1), (8, 2, 1)], "key long, content long, label long")
    got = S._links(rest, rest.where("content < 3"), grams, s, 2).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 1), (4, 1), (4, 2)]
