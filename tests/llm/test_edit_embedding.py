import hashlib
import random

import numpy as np
import pytest

from demandgrid.llm import edit_embedding as E
from tests.llm.helpers import components, corpus, frame, prose, vocabulary


def slow_walk(text):
    """The walk step by step: where it stands at each step."""
    move = E.place_keys(E.PERIOD)
    kinds = ((np.array([ord(c) for c in text], np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(26)).tolist()
    at, out = 0, []
    while at < len(text):
        out.append(at)
        at += int(move[(len(out) - 1) % E.PERIOD]) >> kinds[at] & 1
    return out


def slow_digits(text, s):
    stands = slow_walk(text)
    steps, salts, keys = E.sample_steps(s.samples, s.seed), E.place_keys(s.samples), E.place_keys(s.width + 8)[8:]
    mask, out = (1 << 64) - 1, []
    for k in range(s.samples if text else 0):
        at = stands[max(int(x) for x in steps[k] if x <= len(stands)) - 1]
        seen = sum((ord(c) + 1) * int(keys[o]) for o, c in enumerate(text[at:at + s.width])) & mask
        seen = (seen ^ seen >> 32) * (int(salts[k]) | 1) & mask
        out.append(((seen ^ seen >> 29) * 0xBF58476D1CE4E5B9 & mask) >> 60)
    return out or [0] * s.samples


@pytest.mark.parametrize("few", [1, 4, 1000])
def test_digits_equal_the_walk_step_by_step(monkeypatch, few):
    monkeypatch.setattr(E, "FEW", few)
    rng = random.Random(few)
    s = E.Settings(samples=40)
    texts = ["", "a", "ab", "é\U0001F600" * 50, "x" * 3000, *["".join(rng.choice("abc deßñ\n") for _ in range(rng.randint(0, 400))) for _ in range(30)]]
    got = E.digits(texts, s)
    assert [g.tolist() for g in got] == [slow_digits(t, s) for t in texts]
    assert E.digits([], s).shape == (0, 40)


def test_a_walk_longer_than_the_period():
    s = E.Settings(samples=30)
    text = prose(random.Random(1), vocabulary(), 12_000)
    assert len(slow_walk(text)) > E.PERIOD
    assert E.digits([text, "b"], s)[0].tolist() == slow_digits(text, s)


def test_sampled_steps_are_uniform():
    steps = E.sample_steps(20_000, 3)
    for n in (1, 10, 1000):
        last = np.array([row[np.searchsorted(row, n, side="right") - 1] for row in steps])
        assert last.max() <= n and abs(last.mean() - (n + 1) / 2) < 0.02 * n
    assert (steps[:, -1] > 1 << 50).all()


def test_likeness_falls_with_edits():
    rng, words = random.Random(2), vocabulary()
    base = [prose(rng, words, 400) for _ in range(20)]

    def edit(t, k):
        t = list(t)
        for _ in range(k):
            at = rng.randrange(len(t))
            t[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        return "".join(t)

    s = E.Settings()
    own = E.digits(base, s)
    means = [E.likeness(own, E.digits([edit(t, k) for t in base], s)).mean() for k in (0, 2, 10, 60)]
    other = E.likeness(own, E.digits(base[1:] + base[:1], s)).mean()
    assert means[0] == 1 and means[1] > 0.9 and means == sorted(means, reverse=True) and other < 0.05
    thirds = E.likeness(own, E.digits([E.edited(t, n) for t, n in zip(base, base[1:] + base[:1])], s))
    assert abs(thirds.mean() - 2 / 3) < 0.05


def test_successors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_CHARS", 4000)
    rows = [r for r in corpus(spark, 40) if r[0] is None or r[0] != 903] + [(903, "one"), (5000, "short"), (5001, "x" * 100)]
    s = E.Settings(samples=64)
    out = E.with_successor(frame(spark, rows).repartition(3), s=s).collect()
    ranked = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, r in enumerate(ranked):
        text, following = r[1] or "", ranked[(k + 1) % len(ranked)][1] or ""
        changed = text[:len(text) - len(text) // 3] + following[:len(text) // 3]
        a, b, c = E.digits([text, changed, following], s)
        want.append((r[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), E.as_text(a), E.as_text(b),
                     float(E.likeness(a, b)), float(E.likeness(a, c))))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    known = E.fingerprints(frame(spark, rows), s=s).collect()
    assert sorted(((r.id, r.n_chars, r.fingerprint) for r in known), key=repr) == sorted(((w[0], w[1], w[3]) for w in want), key=repr)


def test_one_and_no_documents(spark):
    out = E.with_successor(frame(spark, [(4, "alone and itself the next")])).collect()
    assert len(out) == 1 and out[0].near_next == 1.0
    assert out[0].edited_sha256 == hashlib.sha256(E.edited(*["alone and itself the next"] * 2).encode()).hexdigest()
    assert E.with_successor(frame(spark, [])).count() == 0
    assert E.near_duplicates(E.fingerprints(frame(spark, []))).count() == 0


@pytest.mark.parametrize("block", [2048, 8])
def test_near_duplicates_equal_all_pairs(spark, block):
    rng, words = random.Random(6), vocabulary()
    texts = [prose(rng, words, 150) for _ in range(25)]
    for base in texts[:3]:                                   # chains of near copies, exact copies
        near = base.split(" ")
        for _ in range(15):
            near = list(near)
            near[rng.randrange(len(near))] = "changed"
            texts += [" ".join(near)] * rng.randint(1, 2)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7000, None), (7001, "")]
    s = E.Settings(bands=128, band_digits=2, block=block)    # bands that miss nothing here
    out = E.near_duplicates(E.fingerprints(frame(spark, rows), s=s), s).collect()
    named = [(i, t or "") for i, t in rows if i is not None]
    fps = dict(zip([i for i, _ in named], E.digits([t for _, t in named], s)))
    want = components(sorted(fps), lambda a, b: E.likeness(fps[a], fps[b]) >= s.threshold)
    assert {r.id: r.component_id for r in out if r.id is not None} == want
    assert len(out) == len(rows) and [r.component_id for r in out if r.id is None] == [None]


def test_recall_of_the_bands(spark):
    """At the registered settings, links at the threshold are found."""
    rng, words = random.Random(8), vocabulary()
    s = E.Settings()
    texts = []
    for _ in range(60):
        base = prose(rng, words, 120).split(" ")
        near = list(base)
        for _ in range(rng.randint(1, 9)):
            near[rng.randrange(len(near))] = "changed"
        texts += [" ".join(base), " ".join(near)]
    fps = E.digits(texts, s)
    linked = [k for k in range(60) if E.likeness(fps[2 * k], fps[2 * k + 1]) >= s.threshold]
    out = {r.id: r.component_id for r in E.near_duplicates(E.fingerprints(frame(spark, list(enumerate(texts))))).collect()}
    assert len(linked) > 15 and sum(out[2 * k + 1] == 2 * k for k in linked) >= 0.97 * len(linked)
