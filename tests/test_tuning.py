import pytest
import json

from demandgrid.operators import tuning as TU


def test_median_stopping_rule(spark, two_entity_panel, monkeypatch):
    # Deterministic fold scores per trial: trial t scores (t+1)/10 on every fold
    # except trial 2, which is best.
    calls = []

    def fake(panel, params, te, ts, tend, *a, **k):
        calls.append(str(te))
        return fake.scores.pop(0)

    folds = TU.K.FOLD_SPEC[:3]
    for parallel in (False, True):
        calls.clear()
        fake.scores = [0.5, 0.5, 0.5,      # trial 0 (start-up, complete)
                       0.6, 0.6,           # trial 1: worse than the median at its second fold -> pruned there
                       0.4, 0.4, 0.4]      # trial 2: better everywhere -> complete
        monkeypatch.setattr(TU, "evaluate_fold", fake)
        trials = {r.trial: r for r in TU.search(two_entity_panel, 3, folds, max_iter=2, startup_trials=1,
                                                 warmup_steps=1, parallel_folds=parallel).collect()}
        assert [trials[i].state for i in range(3)] == ["complete", "pruned", "complete"]
        assert trials[1].fold_wapes == [0.6, 0.6] and trials[1].mean_wape is None
        assert trials[2].mean_wape == pytest.approx(0.4)
        assert len(calls) == 8             # a pruned trial runs no fold after its stop, in parallel too
        best = TU.summarize(spark.createDataFrame(list(trials.values()))).first()
        assert best.best_trial == 2 and best.n_complete == 2 and best.n_pruned == 1
        assert json.loads(best.best_params)["max_iter"] == 2


def test_shared_fold_context_equals_fresh_preparation(spark, monkeypatch):
    """A trial scored on the shared fold context gets the same WAPE as one
    that featurises the fold itself; a search builds each context once."""
    from tests.test_training import _panel
    from tests.conftest import D
    panel = _panel(spark, days=120)
    params = TU.T.GBTParams(max_iter=3, max_depth=3, seed=7)
    args = (D("2023-04-10"), D("2023-04-11"), D("2023-04-30"), (5.0, 20.0), D("2023-01-01"))
    ctx = TU.fold_context(panel, *args)
    fresh = TU.evaluate_fold(panel, params, *args)
    shared = TU.evaluate_fold(panel, params, *args, context=ctx)
    assert shared == pytest.approx(fresh, rel=1e-12)

    built = []
    real = TU.fold_context
    monkeypatch.setattr(TU, "fold_context", lambda *a, **k: built.append(a[1]) or real(*a, **k))
    folds = [(1, D("2023-03-31"), D("2023-04-01"), D("2023-04-15"), "f1"),
             (2, D("2023-04-15"), D("2023-04-16"), D("2023-04-30"), "f2")]
    trials = TU.search(panel, 2, folds, max_iter=2, startup_trials=5, thresholds=(5.0, 20.0),
                       reference_date=D("2023-01-01")).collect()
    assert len(trials) == 2 and all(t.state == "complete" for t in trials)
    assert sorted(built) == [D("2023-03-31"), D("2023-04-15")]      # once per fold, not per trial


def test_sampled_parameters_stay_in_the_search_space():
    import random
    rng = random.Random(3)
    for _ in range(200):
        p = TU.sample_params(rng, max_iter=7)
        assert p.max_iter == 7 and p.max_depth in TU.SPACE["max_depth"][1]
        assert TU.SPACE["step_size"][1] <= p.step_size <= TU.SPACE["step_size"][2]
        assert TU.SPACE["subsampling_rate"][1] <= p.subsampling_rate <= TU.SPACE["subsampling_rate"][2]
        assert 0.5 <= float(p.feature_subset) <= 1.0
        assert TU.SPACE["min_instances"][1] <= p.min_instances <= TU.SPACE["min_instances"][2]
    # Same seed, same sequence: the search is reproducible.
    a, b = random.Random(11), random.Random(11)
    assert [vars(TU.sample_params(a, 5)) for _ in range(5)] == [vars(TU.sample_params(b, 5)) for _ in range(5)]
