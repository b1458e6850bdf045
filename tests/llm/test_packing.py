import random
from collections import Counter, defaultdict

import pytest

from demandgrid.llm import packing as P


def best_fit_brute(sizes, sources, clusters, capacity, per_source):
    """Looks at every bin for each piece."""
    bins, place = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = [(b["free"], n) for n, b in enumerate(bins) if b["free"] >= sizes[k] and b["free"] > 0
               and (clusters[k] < 0 or clusters[k] not in b["clusters"])
               and (sources[k] < 0 or b["sources"][sources[k]] < per_source)]
        if fit:
            n = min(fit)[1]
        else:
            bins.append({"free": capacity, "clusters": set(), "sources": Counter()})
            n = len(bins) - 1
        bins[n]["free"] -= sizes[k]
        bins[n]["clusters"].add(clusters[k])
        bins[n]["sources"][sources[k]] += 1
        place[k] = n
    return place


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_a_search_of_all_bins(seed):
    rng = random.Random(seed)
    n = 300
    sizes = [rng.randint(1, 100) for _ in range(n)]
    sources = [rng.choice([-1, 0, 0, 1, 2]) for _ in range(n)]
    clusters = [rng.randint(-1, 60) for _ in range(n)]
    assert P.best_fit(sizes, sources, clusters, 100, 2) == best_fit_brute(sizes, sources, clusters, 100, 2)


def test_everything_is_packed_once_within_the_rules(spark):
    rng = random.Random(0)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 5 else None, f"c{i // 4}" if i % 2 else None, rng.choice([0, None, 3, 50, 120, 250, -4]))
            for i in range(600)] + [(None, None, None, 30), (7, "hot", "c1", 40), (7, "hot", "c1", 40)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, source string, copies string, length long, piece string, bin string")
    out = P.pack(df, "length", "copies", s=P.Settings(capacity=100, per_source=2, shard_pieces=120)).collect()
    assert sum(r.n_units for r in out) == sum(r[3] for r in rows if r[3] and r[3] > 0)
    used, sources, clusters = Counter(), defaultdict(Counter), defaultdict(Counter)
    of = {r[0]: r for r in rows}
    for r in out:
        used[r.shard, r.bin] += r.n_units
        sources[r.shard, r.bin][of[r.doc_id][1]] += 1
        clusters[r.shard, r.bin][of[r.doc_id][2]] += 1
    assert max(used.values()) <= 100
    assert all(n <= 2 for c in sources.values() for s, n in c.items() if s is not None)
    assert all(n <= 1 for c in clusters.values() for s, n in c.items() if s is not None)
    spans = sorted((r.shard, r.bin, r.bin_start, r.n_units) for r in out)
    assert all(a[2] + a[3] <= b[2] for a, b in zip(spans, spans[1:]) if a[:2] == b[:2])


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, source string, length long"), "length").count() == 0
