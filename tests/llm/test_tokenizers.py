import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandgrid.llm import bpe, pretokenize, token_count
from demandgrid.llm.bytebpe import ByteBPE
from tests.llm.helpers import corpus, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
CHARS = " \t\n\r\x0b\x0c  'stmdrvlelabcXYZ019!?.,#éß中٣ẞ\U0001F600\x00\x1c\x85​ '  '"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return ByteBPE.load(PATH)


def texts(n=1500, seed=2):
    rng = random.Random(seed)
    out = ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*out, "<|endoftext|>", "a<|endoftext|>b", "", "x" * 3000, " " * 2000 + "a", "'" * 50, "<|endoftext|><|endoftext|> hi",
            "ab" * 2000, "don't we've they'll I'm 's 're", "----" * 100]


def test_words_equal_the_library_in_all_chunkings(library, monkeypatch):
    for size in (256, 7, 1):
        monkeypatch.setattr(pretokenize, "CHUNK", size)
        for t in texts(150, size):
            raw = pretokenize.words([t.encode()])
            got = [raw.data.tobytes()[a:b] for a, b in zip(raw.start, raw.end)]
            assert b"".join(got) == t.encode()
            want = [len(w) for w, _ in library.pre_tokenizer.pre_tokenize_str(t)]      # one letter a byte
            assert [len(g) for g in got] == want


def test_state_maps_compose():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 10, (37, 10)).astype(np.uint8)
    want, now = [], np.arange(10)
    for m in maps:
        now = m[now]
        want.append(now)
    assert (pretokenize.compose_scan(maps) == np.array(want)).all()


def test_counts_equal_the_library(library):
    ts = texts()
    got = token_count.Transducer(ByteBPE.load(PATH)).text_counts([t.encode() for t in ts])
    assert got.tolist() == [len(e.ids) for e in library.encode_batch(ts, add_special_tokens=False)]


def twins(n, a="a", b="b"):
    """The Thue-Morse word of n letters and its complement."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_one_letter_pattern_stay_apart(spark, library, n):
    pair = twins(n)
    got = token_count.Transducer(ByteBPE.load(PATH)).text_counts([t.encode() for t in pair])
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in pair]
    out = bpe.digests(frame(spark, list(enumerate(pair))).coalesce(1), PATH, lexicon=50).collect()
    assert {(r.doc_id, r.decoded_sha256) for r in out} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(pair)}


def test_words_of_equal_hash_are_compared(monkeypatch):
    """Whatever the hash, words are told apart by their bytes."""
    block = pretokenize.words([b"alpha beta alpha gamma beta delta"])
    raw = block.data.tobytes()
    want = [raw[s:e] for s, e in zip(block.start, block.end)]
    block.code[:] = 7
    found, which = pretokenize.distinct_words(block)
    assert [found[k] for k in which] == want and len(set(found)) == len(found)


def test_counts_after_the_states_were_dropped(library):
    small = token_count.Transducer(ByteBPE.load(PATH), most_states=50)
    for k in range(3):
        ts = texts(60, k)
        assert small.text_counts([t.encode() for t in ts]).tolist() == [len(e.ids) for e in library.encode_batch(ts, add_special_tokens=False)]


def test_count_rows(spark, library):
    rows = corpus(spark, 20)
    out = token_count.token_counts(frame(spark, rows), PATH).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in out)
    assert token_count.token_counts(frame(spark, []), PATH).count() == 0


def test_merging_side_by_side(vocabulary):
    rng = random.Random(1)
    found = [bytes(rng.choice(b"ab '\xc3\xa9xyzthe") for _ in range(rng.randint(1, 70))) for _ in range(2000)]
    assert vocabulary.merge_many(found) == [vocabulary.merge(w) for w in found]


def test_lexicon_numbers_its_words_only():
    rng = random.Random(3)
    entries = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))): [rng.randrange(9) for _ in range(rng.randint(1, 3))] for _ in range(400)}
    lex = bpe.Lexicon.compile(entries)
    probe = [*entries, b"", b"abcabcabcabc", b"zz", *[w + b"q" for w in entries]]
    for w, n in zip(probe, lex.numbers(probe)):
        assert (list(lex.ids[lex.offset[n]:lex.offset[n + 1]]) == entries[w]) if w in entries else n == -1
    suffixes = {w[k:] for w in entries for k in range(len(w) + 1)}
    assert len(lex.final) <= len(suffixes)                     # equal continuations are one state


@pytest.mark.parametrize("lexicon", [50, 5000])
def test_digests_equal_the_library(spark, library, lexicon):
    rows = [*corpus(spark, 20), *enumerate(texts(200), 5000)]
    out = bpe.digests(frame(spark, rows), PATH, lexicon=lexicon).collect()
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(r[0]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == sorted(want)


def test_round_trip_and_empty_table(spark):
    rows = corpus(spark, 10)
    enc = bpe.encode(frame(spark, rows), PATH, lexicon=100)
    back = bpe.decode(enc, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert bpe.digests(frame(spark, []), PATH).count() == 0
