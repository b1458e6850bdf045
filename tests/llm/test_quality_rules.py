import duckdb
import pytest

from demandgrid.llm import quality_rules as Q
from tests.llm.helpers import corpus, frame


def brute(text):
    words = [w for w in _split(text or "")]
    seen = {}
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k:k + 8]), []).append(k)
    inside = {i for at in seen.values() if len(at) > 1 for k in at for i in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if _split(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


def _split(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_statistics_equal_brute_force(spark):
    rows = corpus(spark) + [(800, "a b c d e f g h " * 5 + "z"), (801, "l one\nl one\n\n \nl two\nl one"), (802, "k " * 40)]
    df = frame(spark, rows)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                  r.base_failed) for r in Q.quality(df, iterations=2).collect())
    want = []
    for r in rows:
        b = brute(r[1])
        want.append(((r[0] is None, r[0] or 0), *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert got == sorted(want)


def test_junk_goes_and_clean_stays(spark):
    clean = [(i, t) for i, t, *_ in corpus(spark, 80, copies=False)[:80] if len(t.split()) >= 20]
    shout = [(1000 + i, " ".join(w.upper() + "!!" for w in t.split())) for i, t in clean[:12]]
    marks = [(2000 + i, " ".join(w + "***" for w in t.split())) for i, t in clean[:12]]
    out = {r.doc_id: r for r in Q.quality(frame(spark, clean + shout + marks)).collect()}
    assert all(out[i].kept for i, _ in clean)
    assert not any(out[i].kept for i, _ in shout + marks)


def test_empty_table_and_no_votes(spark):
    assert Q.quality(frame(spark, [])).count() == 0
    stats = Q.features(frame(spark, [(1, None)]))
    assert Q.fit(stats) == Q.Model.start(len(Q.RULES))


def test_sql_gives_the_same_rows(spark):
    rows = corpus(spark, 40)
    got = {(r.doc_id, r.n_words, r.n_repeat_words, r.kept, r.posterior) for r in Q.quality(frame(spark, rows), iterations=4).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    cur = con.execute(Q.oracle_sql(iterations=4))
    names = [c[0] for c in cur.description]
    want = {tuple(dict(zip(names, r))[k] for k in ("doc_id", "n_words", "n_repeat_words", "kept", "posterior")) for r in cur.fetchall()}
    assert {x[:4] for x in got} == {x[:4] for x in want}
    a, b = ({(x[0] or -1, x[1]): x[4] for x in s} for s in (got, want))
    assert all(a[k] == pytest.approx(b[k], abs=2e-6) for k in a)
