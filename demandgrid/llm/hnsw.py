"""Embedding near-duplicates with navigable small-world graphs per shard.

Equal vectors are one point with a weight. Points are dealt at random over
shards of bounded size; each shard builds a hierarchical graph in one task,
audits it by comparing searches with brute force over a sample of its points,
and widens the search beam until the audit passes. Every point queries every
shard, in blocks; a query whose whole beam lies above the threshold repeats with
a beam twice as wide, so that dense groups come out whole. Found pairs are
verified in double precision; a task emits each point's number of links and a
spanning forest of its pairs (never the pairs), and forests are united into
components.

Graph steps run for a whole block of queries side by side in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import connected_components, cut


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    degree: int = 12            # links of a point on upper layers (twice that on the lowest)
    build_beam: int = 32
    beam: int = 24              # of queries, before audits widen it
    block: int = 256            # points searched side by side
    recall: float = 0.99        # that a shard's audit asks for
    audit: int = 256            # points of a shard that are audited
    shards: int = 8             # at least
    shard_points: int = 65_536  # at most, on average
    copies: int = 4             # tasks that share the queries of a shard


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


@dataclass
class Graph:
    vectors: np.ndarray         # as given, double
    ids: np.ndarray
    weights: np.ndarray
    layers: list[np.ndarray]    # neighbours on each layer, -1 where fewer
    entry: int
    beam: int

    def __post_init__(self) -> None:
        self.unit = _unit(self.vectors)
        self.norms = np.linalg.norm(self.vectors, axis=1)

    def dump(self) -> bytes:
        out = BytesIO()
        np.savez(out, vectors=self.vectors, ids=self.ids, weights=self.weights, entry=self.entry, beam=self.beam,
                 **{f"layer{k}": x for k, x in enumerate(self.layers)})
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Graph:
        z = np.load(BytesIO(raw))
        layers = [z[f"layer{k}"] for k in range(sum(n.startswith("layer") for n in z.files))]
        return Graph(z["vectors"], z["ids"], z["weights"], layers, int(z["entry"]), int(z["beam"]))


def _beam(unit: np.ndarray, near: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one layer for all queries: (points, similarities),
    best first, -1 where fewer were reached."""
    n, b = len(unit), len(queries)
    ids = np.full((b, width), -1, np.int64)
    sims = np.full((b, width), -2.0, np.float32)
    fresh = np.zeros((b, width), bool)
    seen = np.zeros((b, n), bool)
    rows = np.arange(b)
    ids[:, 0], sims[:, 0], fresh[:, 0] = entry, np.einsum("bd,bd->b", queries, unit[entry]), True
    seen[rows, entry] = True
    live = rows
    step = 1 if width == 1 else 3                       # candidates opened at once
    while len(live):
        open_sims = np.where(fresh[live], sims[live], -3.0)
        pick = np.argpartition(-open_sims, step - 1, axis=1)[:, :step] if step < width else np.argsort(-open_sims, axis=1)[:, :step]
        some = np.take_along_axis(open_sims, pick, axis=1) > -3.0
        fresh[live[:, None], pick] = False
        around = near[np.where(some, ids[live[:, None], pick], 0)]
        around = np.where(some[:, :, None], around, -1).reshape(len(live), -1)
        around = np.where(around >= 0, around, n)
        around.sort(axis=1)
        new = (around < n) & np.r_["1", np.ones((len(live), 1), bool), around[:, 1:] != around[:, :-1]]
        around[~new] = 0
        new &= ~seen[live[:, None], around]
        r, c = np.nonzero(new)
        point = around[r, c]
        seen[live[r], point] = True
        found = np.full(around.shape, -2.0, np.float32)
        found[r, c] = np.einsum("kd,kd->k", queries[live[r]], unit[point])
        # closer than the beam's last only
        better = found > sims[live].min(axis=1)[:, None]
        found[~better], around[~better] = -2.0, -1
        all_sims = np.concatenate([sims[live], found], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[live] = np.take_along_axis(np.concatenate([ids[live], around], axis=1), keep, axis=1)
        sims[live] = np.take_along_axis(all_sims, keep, axis=1)
        fresh[live] = np.take_along_axis(np.concatenate([fresh[live], better], axis=1), keep, axis=1)
        live = live[fresh[live].any(axis=1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _spread(unit: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (best first) such that none is
    closer to one taken before than to the row's own point; free places are
    filled with the best of the rest."""
    b, c = ids.shape
    out = np.full((b, most), -1, np.int64)
    x = unit[np.maximum(ids, 0)]
    between = np.einsum("bid,bjd->bij", x, x)
    taken, count = np.zeros((b, c), bool), np.zeros(b, np.int64)
    for k in range(c):
        closest = np.where(taken, between[:, k], -2.0).max(axis=1)
        ok = (ids[:, k] >= 0) & (closest < sims[:, k]) & (count < most)
        taken[:, k] = ok
        count += ok
    rank = np.where(taken, 0, np.where(ids >= 0, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :most]
    picked = np.take_along_axis(np.where(ids >= 0, ids, -1), order, axis=1)
    out[:, :picked.shape[1]] = picked
    return out


def _connect(unit: np.ndarray, near: np.ndarray, points: np.ndarray, chosen: np.ndarray) -> None:
    """Set the points' links and add the reverse ones, thinning full lists."""
    cap = near.shape[1]
    near[points, :chosen.shape[1]] = chosen
    source = np.repeat(points, chosen.shape[1])
    target = chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
    full_points, full_lists = [], []
    for a, z in zip(heads.tolist(), np.r_[heads[1:], len(target)].tolist()):
        t, new = target[a], source[a:z]
        own = near[t]
        own = own[own >= 0]
        new = new[~np.isin(new, own)]
        both = np.concatenate([own, new])
        if len(both) <= cap:
            near[t, :len(both)] = both
        else:
            full_points.append(t)
            full_lists.append(both)
    for k in range(0, len(full_points), 128):
        part, lists = np.array(full_points[k:k + 128]), full_lists[k:k + 128]
        wide = max(map(len, lists))
        ids = np.array([np.pad(x, (0, wide - len(x)), constant_values=-1) for x in lists])
        sims = np.where(ids >= 0, np.einsum("bd,bcd->bc", unit[part], unit[np.maximum(ids, 0)]), -2.0)
        order = np.argsort(-sims, axis=1, kind="stable")
        near[part] = _spread(unit, np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1), cap)


def build(vectors: np.ndarray, ids: np.ndarray, weights: np.ndarray, s: Settings) -> Graph:
    """Graph of one shard, points added in blocks that grow with it; the points
    of a block are candidates for each other too. The beam is then widened
    until searches for a sample of points find what brute force finds."""
    n = len(ids)
    unit = _unit(vectors)
    draw = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64)
    level = np.minimum((-np.log((draw + 1) / 2 ** 53) / log(s.degree)).astype(np.int64), 8)
    layers = [np.full((n, 2 * s.degree if k == 0 else s.degree), -1, np.int64) for k in range(int(level.max()) + 1)]
    entry, top, done = 0, int(level[0]), 1
    while done < n:
        points = np.arange(done, min(n, done + max(1, min(s.block, done // 2))))
        q = unit[points]
        start = np.full(len(points), entry, np.int64)
        inner = q @ q.T
        np.fill_diagonal(inner, -2.0)
        for k in range(max(top, int(level[points].max())), -1, -1):
            here = level[points] >= k
            if k <= top:
                down = np.flatnonzero(~here)
                if len(down):
                    start[down] = _beam(unit, layers[k], q[down], start[down], 1)[0][:, 0]
            own = np.flatnonzero(here)
            if not len(own):
                continue
            if k <= top:
                found, sims = _beam(unit, layers[k], q[own], start[own], s.build_beam)
                start[own] = found[:, 0]
            else:
                found, sims = np.full((len(own), 1), -1, np.int64), np.full((len(own), 1), -2.0, np.float32)
            if len(own) > 1:
                most = min(s.degree, len(own) - 1)
                peers = np.argsort(-inner[np.ix_(own, own)], axis=1)[:, :most]
                found = np.concatenate([found, points[own][peers]], axis=1)
                sims = np.concatenate([sims, np.take_along_axis(inner[np.ix_(own, own)], peers, axis=1)], axis=1)
                order = np.argsort(-sims, axis=1, kind="stable")
                found, sims = np.take_along_axis(found, order, axis=1), np.take_along_axis(sims, order, axis=1)
            _connect(unit, layers[k], points[own], _spread(unit, found, sims, s.degree))
        high = int(level[points].max())
        if high > top:
            entry, top = int(points[int(level[points].argmax())]), high
        done = int(points[-1]) + 1
    graph = Graph(vectors, ids, weights, layers, entry, min(s.beam, n))
    sample = np.unique(np.linspace(0, n - 1, min(n, s.audit)).astype(np.int64))
    truth = {(int(sample[r]), int(c)) for r, c in zip(*np.nonzero(unit[sample] @ unit.T >= s.threshold))}
    while graph.beam < n:
        r, c = within(graph, vectors[sample], s)
        if len(truth & set(zip(sample[r].tolist(), c.tolist()))) >= s.recall * len(truth):
            break
        graph.beam = min(n, 2 * graph.beam)
    return graph


def within(graph: Graph, vectors: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of all pairs found with cosine at the threshold or more,
    verified in double precision."""
    rows, cols = [], []
    unit, norms = _unit(vectors), np.linalg.norm(vectors, axis=1)
    for at in range(0, len(vectors), s.block):
        left = np.arange(at, min(at + s.block, len(vectors)))
        width = graph.beam
        entry = np.full(len(left), graph.entry, np.int64)
        for k in range(len(graph.layers) - 1, 0, -1):
            entry = _beam(graph.unit, graph.layers[k], unit[left], entry, 1)[0][:, 0]
        while len(left):
            found, sims = _beam(graph.unit, graph.layers[0], unit[left], entry, width)
            wider = (sims[:, -1] >= s.threshold - 1e-4) & (width < len(graph.ids))      # the beam is full of hits
            r, c = np.nonzero((sims >= s.threshold - 1e-4) & ~wider[:, None])
            query, point = left[r], found[r, c]
            exact = np.einsum("kd,kd->k", vectors[query], graph.vectors[point]) / (norms[query] * graph.norms[point])
            rows.append(query[exact >= s.threshold])
            cols.append(point[exact >= s.threshold])
            left, entry, width = left[wider], entry[wider], min(2 * width, len(graph.ids))
    return np.concatenate([*rows, np.zeros(0, np.int64)]), np.concatenate([*cols, np.zeros(0, np.int64)])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest of the component, member) with the components of a-b."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[:len(a)], code[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[label[own]], nodes[own]


def _points(rows: DataFrame) -> DataFrame:
    """Distinct usable vectors: their smallest id, weight and dimension."""
    good = rows.where("v IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')) "
                      "AND exists(v, x -> x <> 0)")
    return good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")).withColumn("dim", F.size("v"))


GRAPH = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("copy", pa.int32()), ("kind", pa.int32()),
                   ("ids", pa.list_(pa.int64())), ("payload", pa.binary())])
SCHEMA = "dim int, shard int, copy int, kind int, ids array<long>, payload binary"


def _shard_rows(batches: Iterator[pa.RecordBatch], key) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Columns of each key's rows, from a stream sorted by the key columns."""
    held: dict[str, list] = {}
    last = None
    for batch in batches:
        columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
        for k in range(batch.num_rows):
            now = tuple(columns[n][k] for n in key)
            if last is not None and now != last:
                yield last, held
                held = {}
            last = now
            for n, c in columns.items():
                held.setdefault(n, []).append(c[k])
    if last is not None:
        yield last, held


def _graphs(points: DataFrame, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, shard), own in _shard_rows(batches, ("dim", "shard")):
            graph = build(np.array(own["v"], np.float64), np.array(own["id"], np.int64), np.array(own["weight"], np.int64), s)
            yield pa.RecordBatch.from_pylist([{"dim": dim, "shard": shard, "copy": 0, "kind": 0, "ids": [], "payload": graph.dump()}], schema=GRAPH)

    dealt = points.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "id")
    return dealt.select("dim", "shard", "id", "weight", "v").mapInArrow(run, SCHEMA)


def _queries(points: DataFrame) -> DataFrame:
    """Points packed in blocks, as rows (dim, ids, payload)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(0).to_pylist(), np.int64)
            ids, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(dims == dim)
                for k in range(0, len(which), 1024):
                    part = which[k:k + 1024]
                    yield pa.RecordBatch.from_pylist([{
                        "dim": dim, "shard": 0, "copy": 0, "kind": 1, "ids": [ids[i] for i in part],
                        "payload": np.array([vectors[i] for i in part], np.float64).tobytes()}], schema=GRAPH)

    return points.select("dim", "id", "v").mapInArrow(run, SCHEMA)


def _search(dealt: DataFrame, s: Settings) -> DataFrame:
    """Per (shard, copy): its graph first, then blocks of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, graph = None, None
        for batch in batches:
            dims, shards, copies, kinds, ids, raw = (c.to_pylist() for c in batch.columns)
            for k in range(batch.num_rows):
                if kinds[k] == 0:
                    key, graph = (dims[k], shards[k], copies[k]), Graph.load(raw[k])
                    continue
                if key != (dims[k], shards[k], copies[k]):
                    continue                                # a shard without points
                own = np.array(ids[k], np.int64)
                query, point = within(graph, np.frombuffer(raw[k], np.float64).reshape(len(own), -1), s)
                other = own[query] != graph.ids[point]
                query, point = query[other], point[other]
                if not len(query):
                    continue
                n = np.bincount(query, graph.weights[point], len(own)).astype(np.int64)
                hit = n > 0
                low, high = _forest(own[query], graph.ids[point])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[own[hit], low]), pa.array(np.r_[n[hit], np.zeros(len(low), np.int64)]),
                     pa.array(np.r_[own[hit], high])], ["id", "n", "other"])

    return dealt.mapInArrow(run, "id long, n long, other long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest id reachable, itself included) and
    ``kept`` (the row with that id).

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing; vectors of different lengths do not link; equal vectors
    link with each other; a null id cannot be named, so its row has the
    component of its copies; other columns are ignored; an empty table gives no
    rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    points = cut(_points(rows))
    named = points.where("id IS NOT NULL")
    n = named.count()
    shards = max(s.shards, -(-n // s.shard_points))
    named = named.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    graphs = cut(_graphs(named, s))
    each_copy = F.explode(F.sequence(F.lit(0), F.lit(s.copies - 1)))
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    block_copy = F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(s.copies)).cast("int")
    columns = ["dim", "shard", "copy", "kind", "ids", "payload"]
    asked = _queries(named).withColumn("shard", each_shard).withColumn("copy", block_copy)
    dealt = (graphs.withColumn("copy", each_copy).select(*columns).unionByName(asked.select(*columns))
             .repartition("dim", "shard", "copy").sortWithinPartitions("dim", "shard", "copy", "kind"))
    found = cut(_search(dealt, s))
    counts = found.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("n = 0"), "id", "other")
    state = (points.select("v", "id", "weight").join(counts, "id", "left").join(comps, F.col("id") == F.col("node"), "left")
             .select("v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    return (rows.join(state, "v", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
