import numpy as np

from demandgrid.llm import hnsw as H
from tests.llm.helpers import components


def rows_of(seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for b in rng.normal(size=(60, 16)):
        for _ in range(rng.integers(1, 12)):
            v = b + rng.normal(scale=0.12, size=16) * rng.integers(0, 3)
            rows.append((i, [float(x) for x in v.astype(np.float32)]))
            i += 1
    v0 = rows[0][1]
    rows += [(i, v0), (i + 1, v0), (i + 2, None), (i + 3, [0.0] * 16), (i + 4, [float("nan")] * 16), (i + 5, [None] + [1.0] * 15),
             (i + 6, [1.0, 2.0]), (i + 7, [2.0, 4.0]), (i + 8, []), (i + 9, [float("inf")] + [1.0] * 15), (i + 3, [0.0] * 16)]
    return rows


def test_links_and_components_equal_all_pairs(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, v int")
    out = H.near_duplicates(df).collect()
    good = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}

    def linked(a, b):
        x, y = good[a], good[b]
        return len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9

    want = components(list(good), linked)
    n = {a: sum(a != b and linked(a, b) for b in good) for a in good}
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_links, r.component_id) == ((n[r.vec_id], want[r.vec_id]) if r.vec_id in good else (0, r.vec_id))
        assert r.kept == (r.vec_id == r.component_id)


def test_recall_of_a_dense_group_and_noise():
    """Beams widen until a group of several hundred comes out whole."""
    rng = np.random.default_rng(1)
    centre = rng.normal(size=32)
    x = np.concatenate([centre + rng.normal(scale=0.1, size=(400, 32)), rng.normal(size=(1500, 32))])[rng.permutation(1900)]
    s = H.Settings()
    g = H.Graph.load(H.build(x, np.arange(len(x)), np.ones(len(x), np.int64), s).dump())
    q, p = H.within(g, x, s)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = set(zip(*np.nonzero(u @ u.T >= 0.9)))
    found = set(zip(q.tolist(), p.tolist()))
    assert found <= truth and len(found) >= 0.97 * len(truth)


def test_forest_keeps_components():
    a, b = np.array([5, 7, 9, 2, 30]), np.array([7, 9, 5, 11, 31])
    low, high = H._forest(a, b)
    assert set(zip(low.tolist(), high.tolist())) == {(5, 7), (5, 9), (2, 11), (30, 31)}


def test_empty_table(spark):
    assert H.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
