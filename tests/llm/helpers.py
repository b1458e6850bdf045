"""Small inputs with the awkward cases, and brute-force versions."""

import random

EXTRA = ("id string, fp string, stats string, part string, block string, content string, word string, size string, "
         "start string, `key` string, v string, n string, learn string")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def frame(spark, rows):
    """(doc_id, text[, lang, source]) rows with clashing extra columns."""
    full = [(*(list(r) + [None] * 4)[:4], None, *["x"] * 13) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def vocabulary(n=400, seed=3):
    rng = random.Random(seed)
    parts = ["an", "er", "th", "io", "que", "ße", "ñ", "ou", "li", "st", "re", "ed", "wh"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng, words, n, per_line=40):
    out = [rng.choice(words) for _ in range(n)]
    return "\n".join(" ".join(out[k:k + per_line]) for k in range(0, n, per_line))


AWKWARD = [
    (900, None), (901, ""), (902, " \t\n \x0b"), (903, "one"), (903, "one"), (904, "a\x1cb c   d"),
    (905, "ÉÀ " * 30), (906, "x" * 5000), (None, "a row without an id " * 5), (907, "!!! ### $$$ |"),
]


def corpus(spark, n=60, seed=1, copies=True):
    rng, words = random.Random(seed), vocabulary()
    rows = []
    for i in range(n):
        rows.append((i, prose(rng, words, rng.randint(5, 300)), rng.choice(["aa", "bb"]), f"s{i % 3}"))
    if copies:
        base = prose(rng, words, 200)
        rows += [(n + k, base) for k in range(6)]
        near = base.split(" ")
        for k in range(6):
            near = list(near)
            near[rng.randrange(len(near))] = "changed"
            rows.append((n + 10 + k, " ".join(near)))
    long = prose(rng, words, 20_000)
    rows.append((n + 50, long))
    return [*rows, *AWKWARD]


def components(ids, linked):
    """Smallest id reachable per id."""
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
