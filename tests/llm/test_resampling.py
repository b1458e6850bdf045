import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from demandgrid.llm import resampling as R
from demandgrid.llm.sql_crc import TABLE, crc32
from tests.llm.helpers import corpus, frame, prose, vocabulary

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text, longest=2):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(ws), [" ".join(ws[i:i + k]) for k in range(1, longest + 1) for i in range(len(ws) - k + 1)]


def brute(rows, target, s):
    docs = [(r[0], *brute_features(r[1], s.longest)) for r in rows]
    at = lambda f: zlib.crc32(f.encode()) % s.buckets
    have = Counter(at(f) for _, _, fs in docs for f in fs)
    want = Counter(at(f) for t in target for f in brute_features(t, s.longest)[1])
    n, m = sum(have.values()), sum(want.values())
    gain = [math.floor(1000 * math.log((want[b] + 1) * (n + s.buckets) / ((have[b] + 1) * (m + s.buckets)))) for b in range(s.buckets)]
    out = []
    for i, words, fs in docs:
        weight = sum(gain[at(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= s.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    take = s.share * len(able) // 100
    for k, r in enumerate(able):
        r.append(k + 1 if k < take else None)
    return [tuple(r) if len(r) == 6 else (*r, None) for r in out]


@pytest.mark.parametrize("s", [R.Settings(), R.Settings(longest=3, buckets=97, share=60, min_words=3, seed=1)])
def test_rows_equal_brute_force(spark, s):
    rng, words = random.Random(5), vocabulary()
    rows = [r for r in corpus(spark, 40)] + [(3000 + k, "Straße 12 x9-y " * (k % 30)) for k in range(60)]
    target = [prose(rng, words, 80), None, "", "the Target TEXT 7" * 9]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(target)], "item_id long, text string, bucket string")
    out = R.resample(frame(spark, rows), bench, s=s).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in out), key=repr)
    assert got == sorted(brute(rows, target, s), key=repr)


def test_crcs_of_all_lengths():
    rng = random.Random(0)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 3, 7, 7, 40, R.WIDEST, R.WIDEST + 5]))) for _ in range(200)]
    size = np.array([len(p) for p in parts])
    got = R.crc_matrices(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [zlib.crc32(p) for p in parts]


def test_sql_crc():
    words = ["a", "é x", "", "wordß 12"]
    got = duckdb.sql(f"SELECT {crc32('w')} FROM (SELECT unnest({words!r}) AS w), ({TABLE})").fetchall()
    assert [g[0] for g in got] == [zlib.crc32(w.encode()) for w in words]


def test_one_score_for_many_rows_and_empty_tables(spark):
    """Rows that repeat an id and a text tie; each still has a rank of its own."""
    rows = [(7, "one two three " * 10)] * 200 + [(8, "four five six " * 10)] * 3
    bench = spark.createDataFrame([(0, "one two")], "item_id long, text string")
    out = R.resample(frame(spark, rows), bench, s=R.Settings(share=50)).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 102))
    assert R.resample(frame(spark, []), bench).count() == 0
    assert all(r["rank"] is None for r in R.resample(frame(spark, [(1, None), (None, "few words")]), bench.limit(0)).collect())
