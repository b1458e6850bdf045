import math
import zlib
from collections import Counter

import pytest

from demandgrid.llm import ngram_lm as L
from tests.llm.helpers import corpus, frame


def brute(rows, s):
    """Interpolated n-grams by plain recursion over counts."""
    def tokens(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return ["begin", *low.encode().split(), "end"]

    learn = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 != 1 for r in rows]
    grams = Counter()
    for r, ok in zip(rows, learn):
        if ok:
            seq = tokens(r[1])
            grams.update(tuple(seq[i - k:i]) for i in range(1, len(seq) + 1) for k in range(1, min(i, s.order) + 1))
    one = {g[0]: c for g, c in grams.items() if len(g) == 1 and g[0] != "begin"}
    n, v = sum(one.values()), len(one)

    def p(context, w):
        if not context:
            return (one.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))
        c = grams[context]
        left = s.discount * c ** (s.growth - 1) if c else 1.0
        return (1 - left) * grams[*context, w] / max(c, 1) + left * p(context[1:], w)

    out = []
    for r in rows:
        seq = tokens(r[1])
        pairs = [(tuple(seq[max(0, i - s.order + 1):i]), seq[i]) for i in range(1, len(seq))]
        out.append((r[0], len(pairs), sum(w in one for _, w in pairs), n,
                    sum(math.log10(p((), w)) for _, w in pairs), sum(math.log10(p(h, w)) for h, w in pairs)))
    return out


def same(got, want):
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(g[4:] == pytest.approx(w[4:], abs=1e-6) for g, w in zip(got, want))


@pytest.mark.parametrize("order,block,part,lane", [(2, 4000, 3000, 512), (2, 1 << 24, 1 << 23, 7), (3, 4000, 3000, 5), (4, 1 << 24, 1 << 23, 512),
                                                   (4, 9000, 5000, 2)])
def test_scores_equal_brute_force(spark, monkeypatch, order, block, part, lane):
    monkeypatch.setattr(L, "LANE", lane)
    rows = corpus(spark)
    s = L.Settings(order=order, block_bytes=block, part_bytes=part)
    same(L.score(frame(spark, rows), s=s).collect(), brute(rows, s))


def test_row_order_may_change_between_evaluations(spark):
    """As a shuffled input's can after a lost executor: every evaluation of the
    input deals its rows anew."""
    import pyarrow as pa

    def deal(batches):
        import secrets
        rows = [r for b in batches for r in b.to_pylist()]
        secrets.SystemRandom().shuffle(rows)
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    rows = corpus(spark)
    docs = frame(spark, rows).select("doc_id", "text").repartition(3).mapInArrow(deal, "doc_id long, text string")
    s = L.Settings(block_bytes=4000, part_bytes=3000)
    same(L.score(docs, s=s).collect(), brute(rows, s))


@pytest.mark.parametrize("order", [2, 3])
def test_every_state_is_a_distribution(order):
    """What a state's arcs give, and its failure arc to all other words, sums to
    one over the vocabulary and one unknown word; and a walk ends in the longest
    state that its last tokens make."""
    import numpy as np
    s = L.Settings(order=order)
    tokens = np.array([5, 6, 5, 7, 9, 5, 6, 6, 7, 9], np.uint64)        # two texts that end with 9
    first, size = np.array([0, 5]), np.array([5, 5])
    grams = L._grams(tokens, first, order)
    counts = [np.bincount(g[2][g[2] >= 0], minlength=len(g[0])).astype(float) for g in grams]
    a = L.Automaton.build(grams, counts, first, 2, len(tokens), len(counts[0]), s)
    unknown = 0.5 / (len(tokens) + 0.5 * (len(counts[0]) + 1))          # the root's share for a word never seen
    assert (10 ** a.root).sum() + unknown == pytest.approx(1.0)
    for state in range(1, len(a.failure)):
        if state in (2 + 3, ):                                          # the end has no successor
            continue
        if state >= 2 + len(counts[0]) and not (a.keys // a.words == state).any():
            continue                                                    # a run that ends a text
        after, gained = a.step(np.full(a.words, state), np.arange(a.words))
        back, mass = a.back[state], a.failure[state]
        while back:
            mass, back = mass + a.failure[back], a.back[back]
        assert (10 ** gained).sum() + 10 ** mass * unknown == pytest.approx(1.0)


def test_empty_table(spark):
    assert L.score(frame(spark, [])).count() == 0
