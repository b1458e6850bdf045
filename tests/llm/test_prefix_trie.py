import hashlib
import random
import zlib

import pytest

from demandgrid.llm import prefix_trie as P
from tests.llm.helpers import prose, vocabulary

SCHEMA = "conv_id long, turn long, role string, text string, key string, seq string, n string, low string, held string"


def told(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def brute_turns(rows):
    out = {}
    for c, t, r, x in rows:
        if c is not None:
            out.setdefault(c, []).append((t, r or "", x or ""))
    name = lambda v: hashlib.md5(f"{len(v[1])}:{v[1]}{v[2]}".encode()).hexdigest()
    return {c: [v[1:] for v in sorted(vs, key=lambda v: (v[0] is not None, v[0] or 0, name(v)))] for c, vs in out.items()}


def brute_rebuilt(convs, family=5, lent=9):
    h = {c: zlib.crc32(str(c).encode()) % lent for c in convs}
    return {c: tuple(convs.get(c - c % family, [])[:h[c]] + ts[h[c]:]) for c, ts in convs.items()}


def brute_trie(convs):
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    under = {k: [0, 0] for k in nodes}
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            under[k[:d]][0] += k not in kids
            under[k[:d]][1] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    ends = lambda k: ",".join(map(str, sorted(c for c in nodes[k] if len(convs[c]) == len(k))))
    return {(min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), *under[k],
             hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in nodes.items()}


def talk(n=150, seed=4):
    rng, words = random.Random(seed), vocabulary()
    starts = [prose(rng, words, 6) for _ in range(4)]
    rows = []
    for c in range(n):
        ts = [(t, rng.choice(["user", "assistant"]), rng.choice(starts) if t < 3 else prose(rng, words, 4)) for t in range(rng.randint(1, 9))]
        if c % 11 == 3:
            ts = [(t, "user", "the same") for t in range(5 + c % 3)]
        if c % 17 == 2:
            ts += [(None, None, None), (2, "user", None), (2, None, "é tie"), (2, None, "é tie")]
        if c % 5 or c % 3:                                   # some lenders are absent
            rows += [(c, *t) for t in ts]
    rows += [(2000, t, "user", f"snapshot {t}") for t in range(60)]
    for k in range(60):                                      # a conversation logged after every turn
        rows += [(2001 + 5 * k, t, "user", f"snapshot {t}") for t in range(k + 1)]
    return [*rows, (None, 0, "user", "of no conversation"), (-7, 0, "user", "negative"), (10**12 + 3, 0, "user", "far")]


def got(df):
    return [tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


@pytest.mark.parametrize("container,stride", [(1 << 16, 4), (40, 4), (40, 1), (1, 2)])
def test_nodes_equal_brute_force(spark, container, stride):
    rows = talk()
    seqs = P.sequences(told(spark, rows))
    out = got(P.trie(seqs, P.Settings(container, stride)))
    assert len(out) == len(set(out)) and set(out) == brute_trie({c: tuple(t) for c, t in brute_turns(rows).items()})


def test_rebuilt_conversations(spark):
    rows = talk()
    want = brute_rebuilt(brute_turns(rows))
    assert any(not t for t in want.values())
    out = got(P.trie(P.rebuilt(P.sequences(told(spark, rows))), P.Settings(50)))
    assert len(out) == len(set(out)) and set(out) == brute_trie(want)


def test_empty_and_turnless(spark):
    assert P.trie(P.rebuilt(P.sequences(told(spark, [])))).count() == 0
    alone = spark.createDataFrame([(3, []), (4, [])], "id long, turns array<struct<turn: string, bytes: long>>")
    assert got(P.trie(alone, P.Settings(0))) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,4").hexdigest())]


def test_many_ids_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_IDS", 7)
    rows = spark.range(500).selectExpr("CASE WHEN id < 400 THEN 'hot' ELSE 'k' || id END AS key", "id * 3 - 50 AS id")
    out = {r.key: (r.n, r.low, r.sha) for r in P.id_digests(rows).collect()}
    assert len(out) == 101
    assert out["hot"] == (400, -50, hashlib.sha256(",".join(str(3 * i - 50) for i in range(400)).encode()).hexdigest())
