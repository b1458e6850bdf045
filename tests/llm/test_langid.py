import random
import zlib

import numpy as np

from demandgrid.llm import langid as L
from tests.llm.helpers import AWKWARD, frame

PARTS = {"aa": ["ka", "lo", "mi", "pu"], "bb": ["sch", "ung", "eit", "ver"], "cc": ["ção", "lhe", "nha", "que"]}


def test_held_out_languages(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        lang = ["aa", "bb", "cc"][i % 3]
        text = " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 80)))
        rows.append((i, text.upper() if i % 10 == 0 else text, None if i % 17 == 0 else lang))
    out = L.identify(frame(spark, rows + AWKWARD), L.Settings(per_language=40, clusters=2)).collect()
    assert len(out) == len(rows) + len(AWKWARD)
    mine = [r for r in out if r.doc_id is not None and r.doc_id < 240]
    assert np.mean([r.lang_pred == ["aa", "bb", "cc"][r.doc_id % 3] for r in mine if r.held_out]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in mine)
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert und == {900, 901, 902, 907} and all(0 <= r.score <= 1 for r in out)


def test_nothing_to_learn_from(spark):
    out = L.identify(frame(spark, [(1, "abc"), (2, None)])).collect()
    assert {r.lang_pred for r in out} == {"und"}
    assert L.identify(frame(spark, [])).count() == 0


def test_vectors_are_of_length_one_and_counts_whole():
    s = L.Settings(bits=8)
    n = L.counts([b"abc abc", None, "é".encode() * 100], s)
    x = L.weighted(n, np.ones(256, np.float32))
    assert np.allclose(np.linalg.norm(x, axis=1), [1, 0, 1], atol=1e-5) and n[1].sum() == 0
    assert (L.counts([b"abc abc"], s) == n[:1]).all()
