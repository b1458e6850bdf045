import random
import zlib

import numpy as np

from demandgrid.llm import classifier as C
from demandgrid.llm.subwords import Block, char_ngrams, span_sums, words
from tests.llm.helpers import AWKWARD, frame, prose, vocabulary


def data(spark, n=240):
    rng, vocab = random.Random(2), vocabulary()
    rows, labels = [], []
    for i in range(n):
        t, good = prose(rng, vocab, rng.randint(20, 150)), i % 4 > 0
        rows.append((i, t if good else " ".join(w + rng.choice(["***", "$$$"]) for w in t.split())))
        labels.append((i, int(good), "x"))
    labels += [(0, 0, "y"), (None, 1, "z"), (5, None, "z"), (9999, 1, "z")]
    return frame(spark, rows + AWKWARD), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_held_out_accuracy_and_rows(spark):
    docs, labels = data(spark)
    out = C.classify(docs, labels, C.Settings(max_train=150, bits=14)).collect()
    assert len(out) == 240 + len(AWKWARD)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_without_labels_and_rows(spark):
    docs, labels = data(spark, 8)
    out = C.classify(docs, labels.limit(0)).collect()
    assert {round(r.score, 1) for r in out} == {0.5}
    assert C.classify(frame(spark, []), labels).count() == 0


def test_scoring_in_blocks_equals_the_average_of_vectors(spark):
    s = C.Settings(bits=12)
    rng = np.random.default_rng(0)
    model = C.Model(s, rng.normal(size=1 << 12), 0.1)
    texts = [None, b"", b"a bc  def\n\tghij", b"xx " * 400, "ñandú über".encode()]
    whole = model.scores(texts)
    assert np.allclose(whole, [model.scores([t])[0] for t in texts])
    z = []
    for i, ok, _, _ in C._features(Block.of([texts[2]]), s):
        z += list(model.weight[i[ok[:len(i)]]])
    assert np.isclose(whole[2], 1 / (1 + np.exp(-(np.mean(z) + 0.1))))


def test_blocks_keep_texts_apart():
    block = Block.of([b"ab cd", None, b"ab"])
    w = words(block)
    assert (w.last - w.first).tolist() == [2, 0, 1] and w.codes[0] == w.codes[2] != w.codes[1]
    ids, ok = char_ngrams(block, 3, 10)
    n = span_sums(ok.astype(int), block.starts, block.ends)
    assert n.tolist() == [4, 0, 2]                      # _ab ab_ _cd cd_, none, _ab ab_
