"""Histogram gradient boosting for the absolute loss, many models in lockstep.

Rows are binned once (quantile edges per feature) and stored as blocks of bytes,
a few thousand rows each. A round adds one tree to every model that is still
running: per level one job, in which every task adds up gradient signs and counts
per (model, node, feature, bin) of its blocks, and one shuffle adds up the tasks'
sums; the driver sees sums only (nodes x features x bins) and picks the splits. One
more job per tree collects residual counts per leaf on a signed logarithmic grid,
from which the leaf value is solved exactly for the binned residuals:
sum |r - v| + l1 |v| + l2 v^2 / 2 (a median, drawn to zero by the penalties).

A job costs about the same for one model as for thirty, so a search runs its
trials and folds side by side: ``fit_many`` takes any number of (fold, parameters).

Jobs per round: levels of the deepest tree + 1. Trees grow level by level, best
gains first within the leaf budget. The scores of the rows are kept with the blocks:
each round's are cached, and stored in the shared folder every ``STORE_EVERY``
rounds, which cuts the lineage on reliable storage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import args as A
from demandgrid.session import store

STORE_EVERY = 20
BLOCK_ROWS = 8192
DEEPEST = 64                    # levels of a tree of unlimited depth
GRID = 16                       # residual grid: cells per doubling
BLOCK = "fold int, keys binary, x binary, y binary, held binary, scores binary"
SUMS = "model int, node int, cells binary, n binary, s binary"


@dataclass(frozen=True)
class Params:
    """Budget, growth, sampling and penalties of one model."""
    rounds: int = 1000
    leaves: int = 31
    rate: float = 0.05
    feature_fraction: float = 0.9
    bagging_fraction: float = 0.9
    bagging_every: int = 5
    min_leaf: int = 20
    l1: float = 0.0
    l2: float = 0.0
    depth: int = -1
    patience: int = 50
    seed: int = 42

    def check(self) -> None:
        A.at_least("rounds", self.rounds, 1)
        A.at_least("leaves", self.leaves, 2)
        A.at_least("patience", self.patience, 1)
        A.at_least("min_leaf", self.min_leaf, 1)
        if min(self.l1, self.l2) < 0 or self.rate <= 0:
            raise ValueError("penalties must be >= 0 and the rate > 0")
        if not (0 < self.feature_fraction <= 1 and 0 < self.bagging_fraction <= 1):
            raise ValueError("fractions must lie in (0, 1]")


@dataclass
class Tree:
    feature: list[int] = field(default_factory=lambda: [-1])        # -1: a leaf
    bin: list[int] = field(default_factory=lambda: [0])             # up to this bin: left
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node], self.gain[node] = feature, cut, at, at + 1, gain
        for column, empty in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            column.extend([empty, empty])
        return at, at + 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.right), np.array(self.value)


def walk(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The node at which each row of bins ends."""
    feature, cut, left, right, _ = arrays
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        node = np.where(inner, np.where(x[rows, np.maximum(f, 0)] <= cut[node], left[node], right[node]), node)


@dataclass
class Boosted:
    """A fitted model: the trees up to the best round and how it got there."""
    params: Params
    edges: list[np.ndarray]
    start: float
    trees: list[Tree]
    losses: list[float]         # mean absolute error of the held rows after each round (empty: none held)
    rounds_run: int

    @property
    def rounds_used(self) -> int:
        return len(self.trees)

    def table(self) -> dict:
        """Node arrays of all trees and their weights, splits as ``x <= threshold``."""
        out = [(np.array([0]), np.array([0.0]), np.array([-1]), np.array([-1]), np.array([self.start]))]
        for t in self.trees:
            f, b, left, right, value = t.arrays()
            threshold = np.array([self.edges[i][k] if i >= 0 else 0.0 for i, k in zip(f.tolist(), b.tolist())])
            out.append((np.maximum(f, 0), threshold, left, right, value))
        return {"trees": out, "weights": np.array([1.0] + [self.params.rate] * len(self.trees))}

    def importance(self, n_features: int) -> np.ndarray:
        """Total gain of each feature's splits."""
        out = np.zeros(n_features)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    out[f] += g
        return out


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = 64, error: float = 0.001) -> list[np.ndarray]:
    """Upper edges of each feature's bins: distinct approximate quantiles (one
    job, sketches per partition)."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must lie in 2..256")
    found = rows.approxQuantile(list(features), [k / bins for k in range(1, bins)], error)
    return [np.unique(np.array(q, float)) for q in found]


@dataclass
class Blocks:
    """Stored binned rows of one or more folds, with what a fit needs beside them."""
    rows: DataFrame
    edges: list[np.ndarray]
    starts: dict[int, float]    # first score of each fold: the median of its training target


def pack(rows: DataFrame, features: Sequence[str], target: str, fold: str | None = None, held: str | None = None,
         bins: int = 64) -> Blocks:
    """Bin ``rows`` and store them as blocks. ``held`` marks rows that only measure
    the loss; ``fold`` separates data sets that models are fitted on one by one.
    Rows with a null feature or target raise."""
    src = rows.select((F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), (F.col(held) if held else F.lit(False)).alias("held"),
                      F.col(target).cast("double").alias("y"), F.xxhash64(target, *features).alias("key"),
                      *[F.col(c).cast("double").alias(f"f{k}") for k, c in enumerate(features)])
    src = store(src)                                                 # features are computed once for quantiles, medians and bins
    names = [f"f{k}" for k in range(len(features))]
    edges = bin_edges(src.where("NOT held"), names, bins)
    starts = {r["fold"]: r["m"] for r in src.where("NOT held").groupBy("fold").agg(F.median("y").alias("m")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("features, target and fold must not be null")
            fold_of = batch.column(0).to_numpy()
            for f in np.unique(fold_of).tolist():
                mine = np.flatnonzero(fold_of == f)
                for k in range(0, len(mine), BLOCK_ROWS):
                    some = mine[k:k + BLOCK_ROWS]
                    x = np.stack([np.searchsorted(e, c.to_numpy()[some], side="left") for e, c in zip(edges, batch.columns[4:])], axis=1)
                    keys, y, out = (batch.column(c).to_numpy(zero_copy_only=False)[some] for c in (3, 2, 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f], pa.int32()), *[pa.array([v.tobytes()], pa.binary())
                         for v in (keys, x.astype(np.uint8), y, out.astype(np.uint8))], pa.array([b""], pa.binary())],
                        ["fold", "keys", "x", "y", "held", "scores"])

    return Blocks(store(src.mapInArrow(run, BLOCK)), edges, starts)


def _bag(keys: np.ndarray, p: Params, turn: int) -> np.ndarray:
    """Rows that this turn's trees see: a hash of the row, so neither the order of
    the rows nor their blocks matter (equal rows go together)."""
    x = keys.view(np.uint64) ^ np.random.default_rng([p.seed, turn]).integers(1 << 63, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(11)).astype(float) / (1 << 53) < p.bagging_fraction


def _cells(residual: np.ndarray) -> np.ndarray:
    return (np.sign(residual) * np.floor(np.log2(1 + np.abs(residual) * 16) * GRID)).astype(np.int64)


@dataclass
class _Job:
    """What one model needs in a job: its place among the fold's models, the tree
    so far, the nodes of interest, the features it may use, and its bag."""
    model: int
    fold: int
    place: int
    tree: tuple[np.ndarray, ...]
    nodes: list[int]
    features: np.ndarray
    params: Params
    turn: int


def _opened(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for fold, keys, x, y, held, scores in zip(*(c.to_pylist() for c in batch.columns)):
            y = np.frombuffer(y, np.float64)
            yield (fold, np.frombuffer(keys, np.int64), np.frombuffer(x, np.uint8).reshape(-1, width), y, np.frombuffer(held, np.uint8) > 0,
                   np.frombuffer(scores, np.float64).reshape(-1, len(y)))


def _sums(rows: DataFrame, jobs: list[_Job], width: int, bins: int, leaves: bool) -> dict[tuple[int, int], tuple[np.ndarray, ...]]:
    """(model, node) -> (cells, counts, sums) over the training rows of its bag:
    counts and gradient signs per feature x bin, or with ``leaves`` counts and
    residual sums per residual cell. Node -1: number and absolute error of held rows."""
    by_fold: dict[int, list[_Job]] = {}
    for j in jobs:
        by_fold.setdefault(j.fold, []).append(j)

    def rows_of(found: dict) -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             *[pa.array([found[k][i].tobytes() for k in keys], pa.binary()) for i in range(3)]], ["model", "node", "cells", "n", "s"])

    def merge(found: dict, key: tuple[int, int], cells: np.ndarray, n: np.ndarray, s: np.ndarray) -> None:
        if key in found:
            cells = np.r_[found[key][0], cells]
            n, s = np.r_[found[key][1], n], np.r_[found[key][2], s]
        cells, which = np.unique(cells, return_inverse=True)
        found[key] = cells, np.bincount(which, n, len(cells)), np.bincount(which, s, len(cells))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for fold, keys, x, y, held, scores in _opened(batches, width):
            for j in by_fold.get(fold, ()):
                residual = y - scores[j.place]
                if held.any() and not leaves and j.nodes == [0]:
                    merge(found, (j.model, -1), np.zeros(1, np.int64), np.array([held.sum()], float), np.array([np.abs(residual[held]).sum()]))
                node = walk(j.tree, x)
                wanted = np.full(len(j.tree[0]), -1)
                wanted[j.nodes] = np.arange(len(j.nodes))
                slot = wanted[node]
                keep = np.flatnonzero((slot >= 0) & ~held & _bag(keys, j.params, j.turn))
                if not len(keep):
                    continue
                if leaves:
                    cell, value = (_cells(residual[keep]) + (1 << 20))[:, None], residual[keep]
                    span = 1 << 21
                else:
                    cell, value = j.features * bins + x[keep][:, j.features], -np.sign(residual[keep])
                    span = width * bins
                cells, which = np.unique((slot[keep][:, None] * np.int64(span) + cell).ravel(), return_inverse=True)
                n = np.bincount(which, minlength=len(cells)).astype(float)
                s = np.bincount(which, np.repeat(value, cell.shape[1]), len(cells))
                for k, node_id in enumerate(j.nodes):
                    a, b = np.searchsorted(cells, [k * span, (k + 1) * span])
                    if b > a:
                        merge(found, (j.model, node_id), cells[a:b] - k * span, n[a:b], s[a:b])
        if found:
            yield rows_of(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for model, node, *payload in zip(*(c.to_pylist() for c in batch.columns)):
                merge(found, (model, node), np.frombuffer(payload[0], np.int64), *(np.frombuffer(v, np.float64) for v in payload[1:]))
        if found:
            yield rows_of(found)

    out = rows.mapInArrow(count, SUMS).repartition("model", "node").mapInArrow(add, SUMS).collect()
    return {(r["model"], r["node"]): (np.frombuffer(r["cells"], np.int64), np.frombuffer(r["n"]), np.frombuffer(r["s"])) for r in out}


def best_split(cells: np.ndarray, n: np.ndarray, g: np.ndarray, width: int, bins: int, p: Params) -> tuple[float, int, int]:
    """(gain, feature, bin) of a node from its sums; gain 0 if no split is allowed."""
    count, grad = np.zeros(width * bins), np.zeros(width * bins)
    count[cells], grad[cells] = n, g
    count, grad = count.reshape(width, bins), grad.reshape(width, bins)

    def part(gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(gradient) - p.l1, 0) ** 2 / np.maximum(rows + p.l2, 1e-12)

    left_n, left_g = count.cumsum(axis=1), grad.cumsum(axis=1)
    all_n, all_g = left_n[:, -1:], left_g[:, -1:]
    gain = part(left_g, left_n) + part(all_g - left_g, all_n - left_n) - part(all_g, all_n)
    gain[(left_n < p.min_leaf) | (all_n - left_n < p.min_leaf)] = 0.0
    at = int(np.argmax(gain))
    best = float(gain.ravel()[at])
    return (best, at // bins, at % bins) if best > 1e-9 else (0.0, 0, 0)


def leaf_value(residual: np.ndarray, n: np.ndarray, l1: float, l2: float) -> float:
    """The v that minimises sum n |residual - v| + l1 |v| + l2 v^2 / 2 (the least of them)."""
    at, weight = np.r_[residual, 0.0], np.r_[n, l1]
    order = np.argsort(at, kind="stable")
    at, weight = at[order], weight[order]
    upto = weight.cumsum()
    k = int(np.argmax(2 * upto - upto[-1] + l2 * at >= 0))          # first point with a slope >= 0 after it
    before = 2 * (upto[k] - weight[k]) - upto[-1]
    return float(at[k]) if before + l2 * at[k] <= 0 or l2 == 0 else float(-before / l2)


def _scored(rows: DataFrame, updates: list[tuple[int, int, tuple[np.ndarray, ...], float]], width: int) -> DataFrame:
    """Scores with the trees of a round added: (fold, place, tree, rate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fresh = []
            for fold, _, x, _, _, scores in _opened([batch], width):
                scores = scores.copy()
                for f, place, tree, rate in updates:
                    if f == fold:
                        scores[place] += rate * tree[4][walk(tree, x)]
                fresh.append(scores.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fresh, pa.binary())], batch.schema.names)

    return rows.mapInArrow(run, BLOCK)


def _started(rows: DataFrame, starts: dict[int, float], models: dict[int, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.full(models.get(f, 0) * (len(y) // 8), starts.get(f, 0.0)).tobytes()
                      for f, y in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.binary())], batch.schema.names)

    return rows.mapInArrow(run, BLOCK)


def fit_many(blocks: Blocks, models: Sequence[tuple[int, Params]]) -> list[Boosted]:
    """Fit one model per (fold, parameters), all in lockstep. A model stops at its
    number of rounds, when ``patience`` rounds bring its fold's held rows nothing, or
    when no split gains; it keeps the trees up to its best round."""
    for _, p in models:
        p.check()
    if missing := {f for f, _ in models} - set(blocks.starts):
        raise ValueError(f"no training rows in fold {sorted(missing)}")
    width, bins = len(blocks.edges), 1 + max((len(e) for e in blocks.edges), default=1)
    place, per_fold = [], {}
    for f, _ in models:
        place.append(per_fold.get(f, 0))
        per_fold[f] = place[-1] + 1
    grown: list[list[Tree]] = [[] for _ in models]
    losses: list[list[float]] = [[] for _ in models]
    running = set(range(len(models)))
    needed = blocks.rows.where(F.col("fold").isin(sorted(per_fold)))
    now = _started(needed, blocks.starts, per_fold).persist()
    before = None
    turn = 0

    def job(m: int, tree: Tree, nodes: list[int], features: np.ndarray) -> _Job:
        f, p = models[m]
        return _Job(m, f, place[m], tree.arrays(), nodes, features, p, turn // p.bagging_every)

    def settle(m: int, sums: dict) -> None:
        """The held rows' loss after the rounds so far, and whether to go on."""
        if (m, -1) in sums and grown[m]:
            _, n, s = sums[(m, -1)]
            losses[m].append(float(s[0] / n[0]))
            if len(losses[m]) - 1 - int(np.argmin(losses[m])) >= models[m][1].patience:
                running.discard(m)
        if len(grown[m]) >= models[m][1].rounds:
            running.discard(m)

    while running:
        trees = {m: Tree() for m in running}
        chosen = {}
        for m in running:
            p = models[m][1]
            k = max(1, round(p.feature_fraction * width))
            chosen[m] = np.sort(np.random.default_rng([p.seed, turn, 1]).choice(width, k, replace=False))
        frontier = {m: [0] for m in running}
        level = 0
        while frontier and level < DEEPEST:
            sums = _sums(now, [job(m, trees[m], nodes, chosen[m]) for m, nodes in frontier.items()], width, bins, False)
            if level == 0:
                for m in list(running):
                    settle(m, sums)
                frontier = {m: n for m, n in frontier.items() if m in running}
                if before is not None:
                    before.unpersist()
                    before = None
            following = {}
            for m, nodes in frontier.items():
                p, tree = models[m][1], trees[m]
                able = sorted(((*best_split(*sums[(m, k)], width, bins, p), k) for k in nodes if (m, k) in sums), key=lambda c: (-c[0], c[3]))
                room = p.leaves - sum(f < 0 for f in tree.feature)
                fresh = [tree.split(k, f, b, gain) for gain, f, b, k in able[:room] if gain > 0]
                if fresh and (p.depth < 0 or level + 1 < p.depth) and len(fresh) < room:
                    following[m] = [k for pair in fresh for k in pair]
            frontier = following
            level += 1
        for m in list(running):
            if len(trees[m].feature) == 1:                           # nothing left to gain
                running.discard(m)
        if not running:
            break
        leaves = {m: [k for k, f in enumerate(trees[m].feature) if f < 0] for m in running}
        sums = _sums(now, [job(m, trees[m], leaves[m], chosen[m]) for m in running], width, bins, True)
        for (m, k), (_, n, s) in sums.items():
            trees[m].value[k] = leaf_value(s / n, n, models[m][1].l1, models[m][1].l2)
        for m in running:
            grown[m].append(trees[m])
        before = now
        now = _scored(before, [(models[m][0], place[m], trees[m].arrays(), models[m][1].rate) for m in sorted(running)], width)
        turn += 1
        now = store(now) if turn % STORE_EVERY == 0 else now.persist()
    for df in (before, now):
        if df is not None:
            df.unpersist()
    out = []
    for m, (f, p) in enumerate(models):
        keep = int(np.argmin(losses[m])) + 1 if losses[m] else len(grown[m])
        out.append(Boosted(p, blocks.edges, blocks.starts[f], grown[m][:keep], losses[m], len(grown[m])))
    return out
