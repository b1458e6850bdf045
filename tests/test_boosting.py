import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import boosting as B
from demandgrid.operators import search as S
from demandgrid.operators import trees as T
from tests.conftest import D
from tests.test_training import _panel


def table(spark, n=600, seed=1, fold=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.uniform(0, 10), rng.randint(0, 5), rng.gauss(0, 1)
        rows.append((fold, i % 5 == 4, a, float(b), c, 3 * math.floor(a / 2) + (10 if b > 2 else 0) + 0.3 * c + rng.gauss(0, 0.2)))
    return rows, "fold int, held boolean, a double, b double, c double, y double"


def brute_fit(rows, edges, p):
    """The same boosting on plain arrays, one row and one split at a time."""
    x = np.array([[np.searchsorted(e, v, side="left") for e, v in zip(edges, r[2:5])] for r in rows])
    y, held = np.array([r[5] for r in rows]), np.array([r[1] for r in rows])
    score = np.full(len(y), np.median(y[~held]))
    losses, history = [], [score.copy()]
    shrink = lambda g, n: max(abs(g) - p.l1, 0) ** 2 / max(n + p.l2, 1e-12)
    for _ in range(p.rounds):
        leaves, done, level = {(): np.flatnonzero(~held)}, {}, 0
        conditions = {(): []}
        while leaves:
            able = []
            for order, (key, idx) in enumerate(leaves.items()):
                g = np.sign(score[idx] - y[idx])
                best = (0.0, None)
                for f in range(3):
                    for b in range(len(edges[f]) + 1):
                        left = x[idx, f] <= b
                        if left.sum() < p.min_leaf or (~left).sum() < p.min_leaf:
                            continue
                        gain = shrink(g[left].sum(), left.sum()) + shrink(g[~left].sum(), (~left).sum()) - shrink(g.sum(), len(g))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, b))
                able.append((-best[0], order, key, best[1]))
            room, following, made = p.leaves - len(leaves) - len(done), {}, 0
            able.sort()
            split_keys = {key: cut for _, _, key, cut in [c for c in able if c[0] < 0][:room]}
            fresh = {}
            for _, _, key, cut in able:
                if key in split_keys:
                    f, b = cut
                    idx = leaves[key]
                    fresh[key + ((f, b, True),)], fresh[key + ((f, b, False),)] = idx[x[idx, f] <= b], idx[x[idx, f] > b]
                    made += 1
                else:
                    done[key] = leaves[key]
            level += 1
            if made and (p.depth < 0 or level < p.depth) and made < room:
                leaves = fresh
            else:
                done.update(fresh)
                leaves = {}
        if len(done) == 1:
            break
        for key, idx in done.items():
            cells = {}
            for r in (y[idx] - score[idx]).tolist():
                cells.setdefault(int(np.sign(r) * math.floor(np.log2(1 + abs(r) * 16) * B.GRID)), []).append(r)
            means = [sum(v) / len(v) for v in cells.values()]
            sizes = [len(v) for v in cells.values()]
            cost = lambda v: sum(n * abs(m - v) for m, n in zip(means, sizes)) + p.l1 * abs(v) + p.l2 * v * v / 2  # noqa: B023,E731
            tried = [*means, 0.0]
            if p.l2:
                for k in [*means, 0.0]:                              # stationary points beside each kink
                    slope = sum(n * np.sign(k + 1e-12 - m) for m, n in zip(means, sizes)) + p.l1 * np.sign(k + 1e-12)
                    tried.append(-slope / p.l2)
                    slope = sum(n * np.sign(k - 1e-12 - m) for m, n in zip(means, sizes)) + p.l1 * np.sign(k - 1e-12)
                    tried.append(-slope / p.l2)
            least = min(map(cost, tried))
            value = min(v for v in tried if cost(v) <= least + 1e-9)
            inside = np.ones(len(y), bool)
            for f, b, left in key:
                inside &= (x[:, f] <= b) == left
            score[inside] += p.rate * value
        history.append(score.copy())
        if held.any():
            losses.append(np.abs(y[held] - score[held]).mean())
            if len(losses) - 1 - int(np.argmin(losses)) >= p.patience:
                break
    keep = int(np.argmin(losses)) + 1 if losses else len(history) - 1
    return history[keep], keep, losses


@pytest.mark.parametrize("p", [
    B.Params(rounds=6, leaves=6, rate=0.4, feature_fraction=1, bagging_fraction=1, min_leaf=5),
    B.Params(rounds=8, leaves=9, rate=0.3, feature_fraction=1, bagging_fraction=1, min_leaf=15, l1=4.0, l2=6.0, depth=2),
    B.Params(rounds=40, leaves=4, rate=0.9, feature_fraction=1, bagging_fraction=1, min_leaf=20, l2=0.5, patience=3),
])
def test_models_equal_a_plain_version(spark, monkeypatch, p):
    monkeypatch.setattr(B, "BLOCK_ROWS", 70)
    monkeypatch.setattr(B, "STORE_EVERY", 4)
    rows, schema = table(spark)
    blocks = B.pack(spark.createDataFrame(rows, schema).repartition(3), ["a", "b", "c"], "y", "fold", "held", bins=12)
    model = B.fit_many(blocks, [(0, p)])[0]
    want, keep, losses = brute_fit(rows, blocks.edges, p)
    got = T.score_table(model.table(), np.array([r[2:5] for r in rows]))
    assert np.allclose(got, want, atol=1e-6)
    assert model.rounds_used == keep and np.allclose(model.losses[:len(losses)], losses, atol=1e-6)
    assert all(len([f for f in t.feature if f < 0]) <= p.leaves for t in model.trees)
    if p.rounds == 40:
        assert model.rounds_run < 40                                 # the patience ended it
    assert np.argmax(model.importance(3)) in (0, 1)


def test_lockstep_equals_one_by_one(spark):
    """Models of several folds and parameters, sampling included, don't touch each other."""
    r0, schema = table(spark, 300, 1, 0)
    r1, _ = table(spark, 200, 2, 1)
    blocks = B.pack(spark.createDataFrame(r0 + r1, schema), ["a", "b", "c"], "y", "fold", "held", bins=10)
    asked = [(0, B.Params(rounds=3, leaves=4, rate=0.5, min_leaf=5)), (1, B.Params(rounds=5, leaves=3, rate=0.2, min_leaf=5, seed=7)),
             (0, B.Params(rounds=2, leaves=8, rate=0.3, min_leaf=3, feature_fraction=0.5, bagging_fraction=0.6))]
    together = B.fit_many(blocks, asked)
    for k in (1, 2):
        alone = B.fit_many(blocks, [asked[k]])[0]
        assert [t.arrays()[4].tolist() for t in alone.trees] == [t.arrays()[4].tolist() for t in together[k].trees]
        assert alone.losses == together[k].losses
    assert together[0].start == np.median([r[5] for r in r0 if not r[1]])


@pytest.mark.parametrize("l1,l2", [(0, 0), (3, 0), (0, 2.5), (4, 1.5)])
def test_leaf_value_minimises_its_cost(l1, l2):
    rng = np.random.default_rng(3)
    for _ in range(30):
        at, n = np.round(rng.normal(1, 3, 9), 2), rng.integers(1, 5, 9).astype(float)
        cost = lambda v: (n * np.abs(at - v)).sum() + l1 * abs(v) + l2 * v * v / 2  # noqa: B023,E731
        grid = np.r_[at, 0, np.linspace(-10, 10, 20_001)]
        assert cost(B.leaf_value(at, n, l1, l2)) <= min(map(cost, grid)) + 1e-9


def test_checks(spark):
    for bad in (B.Params(leaves=1), B.Params(l1=-1), B.Params(bagging_fraction=0), B.Params(patience=0)):
        with pytest.raises(ValueError):
            bad.check()
    rows, schema = table(spark, 50)
    blocks = B.pack(spark.createDataFrame(rows, schema), ["a"], "y", "fold")
    with pytest.raises(ValueError, match="fold"):
        B.fit_many(blocks, [(3, B.Params(rounds=1))])
    assert B.fit_many(blocks, [(0, B.Params(rounds=2, min_leaf=40))])[0].trees == []        # no split is allowed


def test_forecaster_of_the_panel(spark):
    """Boosted trees forecast recursively like the other trees, and beat the median."""
    panel = _panel(spark)
    cutoff = D("2023-05-01")
    history, test = panel.where(F.col("shipment_date") <= cutoff), panel.where(F.col("shipment_date") > cutoff)
    fc = T.fit_boosted(history, B.Params(rounds=12, leaves=8, rate=0.4, patience=4), (5.0, 20.0), D("2023-01-01"), validation=test)
    pred = T.recursive_forecast(fc, history, 29).join(test, ["shipment_date", "entity"])
    from demandgrid.functions import metrics as M
    assert pred.count() == 29 * 3 and pred.agg(M.wape().alias("w")).first().w < 0.35
    assert T.feature_importance(fc, spark).agg(F.sum("share_pct")).first()[0] == pytest.approx(100)
    assert 1 <= fc.model.rounds_used <= fc.model.rounds_run <= 12 and len(fc.model.losses) == fc.model.rounds_run


def trough(p):
    return (math.log(p["rate"] / 0.05) ** 2 + ((p["leaves"] - 90) / 40) ** 2 + 4 * (p["feature_fraction"] - 0.9) ** 2
            + (0 if p["depth"] == 7 else 0.5) + 0.1 * math.log10(p["l2"]) ** 2)


def test_parzen_beats_random_draws():
    best = {"parzen": [], "random": []}
    for seed in range(20):
        for kind in best:
            sampler = S.Parzen(S.SPACE, seed)
            found = []
            for _ in range(60):
                if kind == "parzen":
                    p = sampler.draw()
                    sampler.tell(p, trough(p))
                else:
                    p = sampler.random()
                found.append(trough(p))
            best[kind].append(min(found))
    assert np.mean(best["parzen"]) < 0.75 * np.mean(best["random"])
    assert sum(a < b for a, b in zip(best["parzen"], best["random"])) >= 14


def test_parzen_stays_in_the_space_and_repeats():
    drawn = []
    for _ in range(2):
        sampler, ps = S.Parzen(S.SPACE, 5, startup=4), []
        for k in range(40):
            ps.append(sampler.draw())
            sampler.tell(ps[-1], None if k % 7 == 6 else trough(ps[-1]))
        drawn.append(ps)
    assert drawn[0] == drawn[1]
    for p in drawn[0]:
        for name, spec in S.SPACE.items():
            assert p[name] in spec[1] if spec[0] == "choice" else spec[1] <= p[name] <= spec[2]


def test_trials_stop_between_folds():
    """Trials that run together are stopped by the median of all that were there;
    a stopped trial is asked for no further fold; start-up trials ask for all at once."""
    asked = []

    def scorer(batch):
        asked.append([(f, p["rate"]) for f, p in batch])
        return [(p["rate"] + f, 5) for f, p in batch]

    rows = S.run(3, 10, scorer, S.Parzen(S.SPACE, 1, startup=4), at_once=4, startup=4, warmup=1)
    assert [f for f, _ in asked[0]] == [0] * 4 + [1] * 4 + [2] * 4       # start-up
    assert [{f for f, _ in b} for b in asked[1:3]] == [{0}, {1}] and len(asked[2]) == 4
    states = [r[1] for r in rows]
    assert len(rows) == 10 and states[:4] == ["complete"] * 4 and "pruned" in states[4:]
    for r in rows:
        assert len(r[3]) == len(r[4]) and (r[2] is None) == (r[1] == "pruned") and (len(r[3]) == 3 or r[1] == "pruned")


def test_search_of_the_panel(spark):
    folds = [(1, D("2023-03-31"), D("2023-04-01"), D("2023-04-15"), "f1"), (2, D("2023-04-15"), D("2023-04-16"), D("2023-04-30"), "f2")]
    out = S.search(_panel(spark, days=120), 3, 3, folds, at_once=2, startup=2, patience=2, thresholds=(5.0, 20.0), reference_date=D("2023-01-01"))
    rows = out.collect()
    assert len(rows) == 3 and all(r.state in ("complete", "pruned") for r in rows)
    assert all(0 <= n <= 3 for r in rows for n in r.rounds_used) and all(r.seconds > 0 for r in rows)
    from demandgrid.operators.tuning import summarize
    assert summarize(out).first().best_wape == min(r.mean_wape for r in rows if r.mean_wape is not None)
