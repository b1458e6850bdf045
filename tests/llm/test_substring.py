import random

import pytest

from demandgrid.llm import substring as S
from tests.llm.helpers import components, corpus, frame, prose, vocabulary


def shingles(line, k=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in line).encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def test_planted_passages_and_near_paragraphs(spark):
    rng, words = random.Random(5), vocabulary(3000)
    rows = [(i, prose(rng, words, 120, 60)) for i in range(30)]
    clean = {i for i, _ in rows}
    passage = " ".join(rng.choice(words) for _ in range(56))
    for k in range(4):                                    # inside longer paragraphs that differ around it
        rows.append((100 + k, prose(rng, words, 30, 60) + " " + passage.upper() * (k == 3) + passage * (k < 3) + " " + prose(rng, words, 30, 60)))
    near = [rng.choice(words) for _ in range(80)]
    for k in range(4):                                    # one word apart from a common paragraph
        own = list(near)
        own[20 * k] = "other"
        rows.append((200 + k, prose(rng, words, 40) + "\n" + " ".join(own)))
    out = S.repeated(frame(spark, rows)).collect()
    found = {r.doc_id for r in out}
    ascii_only = passage.isascii()
    assert {100, 101, 102, 200, 201, 202, 203} <= found and (103 in found or not ascii_only)
    assert not found & clean
    kept = {r.doc_id for r in out if not r.removed}
    assert 100 in kept and 200 in kept and all(r.first_doc_id <= r.doc_id for r in out)
    texts = {r.doc_id: r.text for r in S.without_repeats(frame(spark, rows)).collect()}
    assert all(texts[i] == t for i, t in rows if i in clean | {100, 200})
    assert sum(len(texts[i].split()) for i in (101, 102)) <= 2 * (116 - 20)


def test_paragraph_components_equal_all_pairs(spark):
    rng, words = random.Random(9), vocabulary(500)
    lines, rows = [], []
    for c in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        for k in range(rng.randint(1, 30)):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            lines.append(" ".join(own))
    rows = [(i, x) for i, x in enumerate(lines)]
    s = S.Settings(recall=0.999999)
    got = {r.doc_id: r.component_id for r in S.repeated(frame(spark, rows), s).where("kind = 'paragraph'").collect()}
    sets = [shingles(x) for x in lines]
    want = components(list(range(len(lines))), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(i)
    mine = {}
    for i, c in got.items():
        mine.setdefault(c, set()).add(i)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in mine.values()}


def test_awkward_rows(spark):
    rows = corpus(spark)
    out = S.without_repeats(frame(spark, rows))
    assert out.columns == frame(spark, []).columns and out.count() == len(rows)
    assert S.repeated(frame(spark, [])).count() == 0
    assert S.without_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("text,spans,want", [
    (b"a b c d", [(1, 2)], b"a  d"), (b"a b\nc d\ne", [(2, 2)], b"a b\ne"), (b"a b", [(0, 2)], b""),
    (b"a b", [(5, 2)], b"a b"), (b"a b c", [(2, 9)], b"a b "), (b"", [(0, 1)], b"")])
def test_cut_words(text, spans, want):
    assert S.cut_words(text, spans) == want


def test_passage_across_line_ends_and_short_lines(spark):
    rng, words = random.Random(21), vocabulary(3000)
    passage = [rng.choice(words) for _ in range(54)]
    wrapped = ["\n".join(" ".join(passage[k:k + n]) for k in range(0, 54, n)) for n in (54, 27, 7, 3)]
    rows = [(k, prose(rng, words, 40, 60) + " " + x + " " + prose(rng, words, 40, 60)) for k, x in enumerate(wrapped)]
    nine = " ".join(rng.choice(words) for _ in range(9))
    rows += [(10 + k, prose(rng, words, 30) + "\n" + line) for k, line in enumerate((nine, nine, "Too short", "too  short"))]
    out = S.repeated(frame(spark, rows)).collect()
    assert {r.doc_id for r in out if r.kind == "passage"} == {0, 1, 2, 3}
    assert {(r.doc_id, r.n_words, r.removed) for r in out if r.kind == "paragraph" and r.doc_id >= 10} == {
        (10, 9, False), (11, 9, True), (12, 2, False), (13, 2, True)}


def test_passages_as_long_as_they_go(spark):
    rng, words = random.Random(33), vocabulary(3000)
    # of 50 words and more, wherever they stand; earlier documents hold pieces of longer ones
    rows = [(k, prose(rng, words, 200, 33)) for k in range(12)]
    for k in range(12, 60):
        parts = [prose(rng, words, rng.randint(0, 60), 33)]
        for _ in range(rng.randint(1, 3)):
            other, n = rng.choice(rows)[1].split(), rng.randint(22, 130)
            at = rng.randrange(max(1, len(other) - n))
            parts += [" ".join(other[at:at + n]), prose(rng, words, rng.randint(0, 40), 7)]
        rows.append((k, " ".join(parts)))
    rows.append(rows[20])                                  # a row again
    texts = {i: [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t).encode().split()] for i, t in rows}
    out = S.repeated(frame(spark, rows)).where("kind = 'passage'").collect()
    cut = {i: set() for i in texts}
    kept = {r.component_id: r for r in out if not r.removed}
    for r in out:
        first = kept[r.component_id]
        assert first.doc_id == r.first_doc_id and first.n_words == r.n_words
        assert texts[r.doc_id][r.start_word:r.start_word + r.n_words] == texts[first.doc_id][first.start_word:first.start_word + r.n_words]
        if r.removed:
            assert r.first_doc_id < r.doc_id
            cut[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))

    def repeats(n):
        found = {i: set() for i in texts}
        seen = {}
        for i in sorted(texts):
            for k in range(len(texts[i]) - n + 1):
                if seen.setdefault(tuple(texts[i][k:k + n]), i) < i:
                    found[i] |= set(range(k, k + n))
        return found

    want, most = repeats(50), repeats(20)
    assert all(want[i] <= cut[i] <= most[i] for i in texts) and sum(map(len, want.values())) > 2000


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(k, "the same line of some words here", "x", "y") for k in range(3)], "doc_id long, text string, __id string, __spans string")
    out = S.without_repeats(docs)
    assert out.columns == docs.columns and {(r.doc_id, r.text, r["__id"]) for r in out.collect()} == {
        (0, "the same line of some words here", "x"), (1, "", "x"), (2, "", "x")}


def test_shared_windows_in_small_batches(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 9), rng.randint(0, 50), rng.choice([7] * 30 + list(range(40)))) for _ in range(600)]
    groups = {}
    for i, at, c in rows:
        groups.setdefault(c, []).append((i, at))
    want = sorted((i, at, *min(g)) for g in groups.values() if len({i for i, _ in g}) > 1 for i, at in g)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for n in ("1", "7", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        try:
            got = S._shared_windows(spark.createDataFrame(rows, "id long, start long, content long")).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert sorted(map(tuple, got)) == want


def test_matched_members_of_large_buckets_are_compared_too(spark):
    rng, words = random.Random(41), vocabulary(3000)
    line, lines = [rng.choice(words) for _ in range(100)], []
    for _ in range(80):                                   # only near neighbours are similar enough
        line[rng.randrange(len(line))] = rng.choice(words)
        lines.append(" ".join(line))
    s = S.Settings(rows=1, centres=1)
    got = S.repeated(frame(spark, list(enumerate(lines))), s).where("kind = 'paragraph'").collect()
    sets = [shingles(x) for x in lines]
    want = components(list(range(len(lines))), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(i, c) for i, c in want.items() if sum(c == x for x in want.values()) > 1}
