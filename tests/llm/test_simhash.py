import random

import numpy as np
import pytest
import xxhash

from demandgrid.llm import simhash as S
from demandgrid.llm.common import connected_components
from tests.llm.helpers import components, corpus, frame


def brute_fingerprint(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_equal_all_pairs(spark):
    rows = [r for r in corpus(spark) if len(r[1] or "") < 50_000 or r[0] is None]
    out = S.near_duplicates(frame(spark, rows)).collect()
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows if r[0] is not None}
    want = components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert len(out) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out if r.doc_id is not None} == {
        (i, f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("distance,bits", [(4, 8), (4, 13), (3, 9), (2, 10), (5, 8)])
def test_links_connect_all_pairs_in_reach(spark, distance, bits):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps):                                  # chains of small steps around each
        for _ in range(8):
            for b in rng.sample(range(64), rng.randint(1, distance + 1)):
                f ^= 1 << b
            fps.add(f)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = {r.node: r.component for r in connected_components(S.links(df, distance, bits), "a", "b").collect()}
    want = components([s[0] for s in signed], lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    assert {s[0]: got.get(s[0], s[0]) for s in signed} == want


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_paths_stars_and_repeats(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
