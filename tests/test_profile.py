"""Column profiles by digests, samples."""

import datetime as dt

from demandgrid.sources import profile as PR


def test_profile_counts_every_type_exactly(spark, capsys):
    d, t = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(1, 0.0, "a" * 100000, True, d, t, b"\x00", [1.0, 2.0], ["null"], (1, "x"), None),
            (1, -0.0, "a" * 100000, False, d, t.replace(microsecond=2), b"\x00", [1.0, 2.0], [None], (1, "x"), None),
            (-2, float("nan"), "", None, None, None, None, [], [], (None, "x"), None),
            (None, float("nan"), None, None, d, t, b"", None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, f double, s string, b boolean, d date, t timestamp, y binary, e array<float>, "
                                     "l array<string>, r struct<a:int,b:string>, `odd.name` string")
    out = PR.column_profile(df, "t")
    got = {r.column_name: (r.n_nulls, r.pct_nulls, r.n_distinct) for r in out.collect()}
    assert got == {"i": (1, 25.0, 2), "f": (0, 0.0, 2), "s": (1, 25.0, 2), "b": (2, 50.0, 2), "d": (1, 25.0, 1), "t": (1, 25.0, 2),
                   "y": (1, 25.0, 2), "e": (1, 25.0, 2), "l": (1, 25.0, 3), "r": (1, 25.0, 2), "odd.name": (4, 100.0, 0)}
    PR.column_profile(df, "t").explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Scan ") == 1 and plan.count("Exchange ") == 3


def test_profile_of_an_empty_table(spark):
    out = PR.column_profile(spark.createDataFrame([], "a int, b string"), "t").collect()
    assert [(r.column_name, r.n_nulls, r.pct_nulls, r.n_distinct) for r in out] == [("a", 0, None, 0), ("b", 0, None, 0)]


def test_sample_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(i, None if i == 2 else f"v{i}") for i in (5, 2, 9, 1)], "k int, v string")
    got = {r.column_name: r["sample"] for r in PR.sample_rows(df, 3, ["k"]).collect()}
    assert got == {"k": ["1", "2", "5"], "v": ["v1", None, "v5"]}
    assert all(len(r["sample"]) == 3 for r in PR.sample_rows(df).collect())
    assert [r["sample"] for r in PR.sample_rows(df.limit(0)).collect()] == [[], []]
