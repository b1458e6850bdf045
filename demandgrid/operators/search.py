"""Parameter search for the boosted trees: a tree-structured Parzen sampler, trials
that run at the same time, and median stopping between folds.

The sampler splits the trials so far into good ones (the best tenth of those
completed) and the others, estimates a density of each parameter in both as a
mixture of Gaussians around the trials' values and one around the middle of the
range, draws candidates from the good density and takes the one whose ratio good to
others is largest. Numbers with a logarithmic range live in their logarithm;
choices are smoothed counts. Trials that were stopped, or still run, count as
others, so that trials drawn together spread out.

``at_once`` trials run in lockstep: their models of a fold are fitted by the same
Spark jobs (:mod:`boosting`) and their forecasts submitted together. After each fold
the median rule stops trials; the rest go on to the next fold. Start-up trials,
which it can't stop, fit all their folds in one go.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from statistics import median

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid import constants as K
from demandgrid.functions import args as A
from demandgrid.functions import metrics as M
from demandgrid.operators import boosting as B
from demandgrid.operators import trees as T
from demandgrid.operators.panel import materialize

# The eight parameters (fixed values of the original workflow): range or choices.
SPACE: dict[str, tuple] = {
    "leaves": ("int", 15, 127),
    "rate": ("log", 0.01, 0.3),
    "feature_fraction": ("float", 0.5, 1.0),
    "bagging_fraction": ("float", 0.5, 1.0),
    "min_leaf": ("int", 5, 100),
    "l1": ("log", 1e-3, 10.0),
    "l2": ("log", 1e-3, 10.0),
    "depth": ("choice", (-1, 5, 7, 10)),
}


@dataclass
class Parzen:
    """Sampler over ``space``; ``draw`` proposes, ``tell`` takes results (None: stopped)."""
    space: dict[str, tuple]
    seed: int = 42
    startup: int = 10
    candidates: int = 24
    good_share: float = 0.1
    most_good: int = 25
    told: list[tuple[dict, float | None]] = field(default_factory=list)
    pending: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.rng = np.random.default_rng(self.seed)

    def _scale(self, kind: str, v: float) -> float:
        return math.log(v) if kind == "log" else float(v)

    def _range(self, spec: tuple) -> tuple[float, float]:
        kind, low, high = spec
        return (low - 0.5, high + 0.5) if kind == "int" else (self._scale(kind, low), self._scale(kind, high))

    def _value(self, spec: tuple, at: float):
        kind, low, high = spec
        if kind == "int":
            return int(min(max(round(at), low), high))
        return float(min(max(math.exp(at) if kind == "log" else at, low), high))

    def _mixture(self, values: Sequence[float], low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """Centres and widths: each trial is as wide as the gap to its farther
        neighbour, within bounds; the range itself is one more member."""
        centre = np.sort(np.r_[np.array(values, float), (low + high) / 2])
        edged = np.r_[low, centre, high]
        width = np.maximum(edged[1:-1] - edged[:-2], edged[2:] - edged[1:-1])
        width = np.clip(width, (high - low) / min(100.0, 1.0 + len(centre)), high - low)
        width[np.searchsorted(centre, (low + high) / 2)] = high - low
        return centre, width

    def _density(self, mix: tuple[np.ndarray, np.ndarray], x: np.ndarray, low: float, high: float) -> np.ndarray:
        """Logarithm of the mixture's density, each member cut to the range."""
        centre, width = mix
        phi = np.vectorize(lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2))))
        inside = phi((high - centre) / width) - phi((low - centre) / width)
        z = (x[:, None] - centre) / width
        return np.log((np.exp(-0.5 * z * z) / (width * np.maximum(inside, 1e-12))).mean(axis=1) + 1e-300)

    def _from(self, mix: tuple[np.ndarray, np.ndarray], low: float, high: float) -> np.ndarray:
        centre, width = mix
        out = []
        while len(out) < self.candidates:
            k = int(self.rng.integers(len(centre)))
            x = self.rng.normal(centre[k], width[k])
            if low <= x <= high:
                out.append(x)
        return np.array(out)

    def random(self) -> dict:
        out = {}
        for name, spec in self.space.items():
            out[name] = spec[1][int(self.rng.integers(len(spec[1])))] if spec[0] == "choice" else self._value(spec, self.rng.uniform(*self._range(spec)))
        return out

    def draw(self) -> dict:
        done = sorted(((v, k) for k, (_, v) in enumerate(self.told) if v is not None and math.isfinite(v)))
        if len(done) < max(2, min(self.startup, len(self.told) + 1)) or len(self.told) < self.startup:
            p = self.random()
        else:
            n_good = min(max(1, math.ceil(self.good_share * len(done))), self.most_good)
            best = {k for _, k in done[:n_good]}
            good = [self.told[k][0] for k in sorted(best)]
            rest = [t[0] for k, t in enumerate(self.told) if k not in best] + self.pending
            p = {}
            for name, spec in self.space.items():
                if spec[0] == "choice":
                    share = [np.array([1.0 + sum(t[name] == c for t in group) for c in spec[1]]) for group in (good, rest)]
                    share = [s / s.sum() for s in share]
                    tried = self.rng.choice(len(spec[1]), self.candidates, p=share[0])
                    p[name] = spec[1][int(tried[np.argmax(np.log(share[0][tried]) - np.log(share[1][tried]))])]
                    continue
                low, high = self._range(spec)
                mixes = [self._mixture([self._scale(spec[0], t[name]) for t in group], low, high) for group in (good, rest)]
                tried = self._from(mixes[0], low, high)
                ratio = self._density(mixes[0], tried, low, high) - self._density(mixes[1], tried, low, high)
                p[name] = self._value(spec, float(tried[np.argmax(ratio)]))
        self.pending.append(p)
        return p

    def tell(self, params: dict, value: float | None) -> None:
        self.pending.remove(params)
        self.told.append((params, value))


@dataclass
class Folds:
    """Everything of the folds that the parameters don't touch, prepared once."""
    data: T.FoldData
    tests: list[DataFrame]
    histories: list[DataFrame]
    inputs: list[DataFrame]
    horizons: list[int]


def prepare(panel: DataFrame, folds: Sequence, thresholds=K.DEFAULT_TIER_THRESHOLDS, reference_date=K.TREND_REFERENCE_DATE) -> Folds:
    d = F.col(K.DATE_COL)
    histories = [panel.where(d <= F.lit(te)) for _, te, _, _, _ in folds]
    tests = [panel.where(d.between(F.lit(ts), F.lit(tend))) for _, _, ts, tend, _ in folds]
    data = T.prepare_folds({k: (h, t) for k, (h, t) in enumerate(zip(histories, tests))}, thresholds, reference_date)
    horizons = [t.select(K.DATE_COL).distinct().count() for t in tests]
    inputs = [materialize(T.forecast_inputs(data.sources[k], h, n)) for k, (h, n) in enumerate(zip(histories, horizons))]
    return Folds(data, tests, histories, inputs, horizons)


def score(folds: Folds, asked: Sequence[tuple[int, B.Params]]) -> list[tuple[float, int]]:
    """(WAPE on all days of the test window, rounds used) of each (fold,
    parameters): models in lockstep, forecasts together."""
    models = B.fit_many(folds.data.blocks, asked)

    def one(k: int) -> float:
        fold = asked[k][0]
        pred = T.recursive_forecast(folds.data.forecaster(fold, models[k]), folds.histories[fold], folds.horizons[fold], inputs=folds.inputs[fold])
        return float(pred.join(folds.tests[fold], [K.DATE_COL, K.ENTITY_COL]).agg(M.wape().alias("w")).first().w)

    with ThreadPoolExecutor(max_workers=8) as pool:
        wapes = list(pool.map(one, range(len(asked))))
    return [(w, m.rounds_used) for w, m in zip(wapes, models)]


TRIALS = ("trial int, state string, mean_wape double, fold_wapes array<double>, rounds_used array<int>, params string, "
          "seconds double")


def run(n_folds: int, trials: int, scorer: Callable[[list[tuple[int, dict]]], list[tuple[float, int]]], sampler: Parzen,
        at_once: int = 8, startup: int = 10, warmup: int = 1) -> list[tuple]:
    """The search itself, whatever ``scorer`` does with (fold, parameters): rows of
    :data:`TRIALS`. A trial stops after fold ``warmup`` or later if its WAPE there is
    above the median of at least ``startup`` trials that have been there, the ones
    running beside it included."""
    for name, value in (("trials", trials), ("at_once", at_once), ("folds", n_folds)):
        A.at_least(name, value, 1)
    reports: list[list[float]] = [[] for _ in range(n_folds)]
    rows = []
    while len(rows) < trials:
        began = time.perf_counter()
        batch = [sampler.draw() for _ in range(min(at_once, trials - len(rows)))]
        wapes: list[list[float]] = [[] for _ in batch]
        rounds: list[list[int]] = [[] for _ in batch]
        state = ["complete"] * len(batch)
        sure = n_folds if len(rows) + len(batch) <= startup else warmup
        step = 0
        while step < n_folds:
            steps = list(range(step, max(step + 1, sure)))
            alive = [k for k, s in enumerate(state) if s == "complete"]
            if not alive:
                break
            asked = [(f, batch[k]) for f in steps for k in alive]
            for (f, _), k, (w, n) in zip(asked, [k for _ in steps for k in alive], scorer(asked)):
                wapes[k].append(w)
                rounds[k].append(n)
                reports[f].append(w)
            step = steps[-1] + 1
            if step > warmup and step - 1 >= sure and len(reports[step - 1]) >= startup:
                limit = median(reports[step - 1])
                for k in alive:
                    if wapes[k][-1] > limit:
                        state[k] = "pruned"
        spent = (time.perf_counter() - began) / len(batch)
        for k, p in enumerate(batch):
            mean = sum(wapes[k]) / n_folds if state[k] == "complete" else None
            sampler.tell(p, mean)
            rows.append((len(rows), state[k], mean, wapes[k], rounds[k], json.dumps(p, sort_keys=True), spent))
    return rows


def search(panel: DataFrame, trials: int, rounds: int, folds: Sequence = K.FOLD_SPEC[:3], at_once: int = 8, startup: int = 10,
           warmup: int = 1, patience: int = 50, seed: int = 42, thresholds=K.DEFAULT_TIER_THRESHOLDS,
           reference_date=K.TREND_REFERENCE_DATE) -> DataFrame:
    """``trials`` trials of at most ``rounds`` rounds per fold: one row per trial with
    its state, mean and per-fold WAPE, the rounds each fold used, the parameters
    (JSON) and its share of the seconds. The folds' test rows drive the patience."""
    prepared = prepare(panel, folds, thresholds, reference_date)

    def scorer(asked: list[tuple[int, dict]]) -> list[tuple[float, int]]:
        return score(prepared, [(f, B.Params(rounds=rounds, patience=patience, seed=seed, **p)) for f, p in asked])

    rows = run(len(folds), trials, scorer, Parzen(SPACE, seed, startup), at_once, startup, warmup)
    return panel.sparkSession.createDataFrame(rows, TRIALS)


def default_budget() -> dict:
    """The original budget: 100 trials of up to 1,000 rounds, patience 50."""
    return {"trials": 100, "rounds": asdict(B.Params())["rounds"], "patience": 50}
