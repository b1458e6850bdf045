"""Quality by weak supervision: rules vote or abstain, expectation
maximisation estimates how often each rule is right in each class, and the
posterior probability of "good" decides. DataFrame functions only.

Each rule reads one statistic of the text and votes good (1), bad (0) or
abstains (null). Rules that look for a defect vote bad or abstain: not having
one defect says little about the others. The latent class is binary; given the
class, rule ``j`` casts vote ``v`` at a rate of its own, rules being
independent, and abstaining is no evidence. A rule's accuracy (share of its
votes that agree with the class) follows from the rates. Each kind of defect
is seen by two rules or more, as agreement is what identifies the rates. Only
the counts of the vote patterns (at most 3 ** rules rows, whatever the corpus)
enter the fit, so each iteration is one small aggregate and texts are read
once for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(codes: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more."""
    windows = F.when(F.size(codes) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(codes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(codes, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def positions(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda x, k: (F.get(pairs, k - 1)["h"] == x["h"]) | (F.get(pairs, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(let(pairs, positions), covered))

    return let(windows, count)


def word_count(text_col: str) -> Column:
    """Words of a whole text (null: none)."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACE), "")).cast("long")


def statistics(text_col: str) -> Column:
    """Struct of text statistics: n_words, word_chars, n_symbols, n_lines (lines
    with a word), n_dup_lines, n_repeat_words, n_distinct, n_upper (words in
    capitals), n_same (words equal to the one before), n_marked (words with a
    symbol), n_shouts (``!!``), all long. A null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    symbols = sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in SYMBOLS), F.lit(0))
    shouts = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("!!")))) / 2

    def of(w: Column, lines: Column) -> Column:
        upper = F.filter(w, lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 1))
        same = F.filter(w, lambda x, i: x == F.get(w, i - 1))
        marked = F.when(symbols > 0, F.size(F.filter(w, lambda x: x.rlike("[" + SYMBOLS + "]")))).otherwise(0)
        values = {"n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")), "n_symbols": symbols,
                  "n_lines": F.size(lines), "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                  "n_repeat_words": let(F.transform(w, lambda x: F.xxhash64(x)), _repeat_words),
                  "n_distinct": F.size(F.array_distinct(w)), "n_upper": F.size(upper), "n_same": F.size(same),
                  "n_marked": marked, "n_shouts": shouts}
        return F.struct(*[v.cast("long").alias(n) for n, v in values.items()])

    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words, lambda w: let(lines, lambda x: of(w, x)))


def features(docs: DataFrame, text_col: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with the :func:`statistics` of its texts as the column ``name``."""
    return docs.withColumn(name, statistics(text_col))


@dataclass(frozen=True)
class Rule:
    """Bad when ``100 * numerator >= bad * denominator``; good when it is below
    ``good * denominator`` (never, where ``good`` is None); abstains otherwise
    and when the text has fewer than ``least`` words. ``flip`` turns the
    comparisons round (small is bad)."""
    name: str
    numerator: str
    denominator: str
    bad: int
    good: int | None = None
    least: int = 1
    flip: bool = False

    def sql(self, prefix: str = "") -> str:
        n, d = f"100 * {prefix}{self.numerator}", f"{prefix}{self.denominator}"
        is_bad, is_good = ("<", ">=") if self.flip else (">=", "<")
        good = "" if self.good is None else f" WHEN {n} {is_good} {self.good} * {d} THEN 1"
        return f"CASE WHEN {prefix}n_words < {self.least} THEN NULL WHEN {n} {is_bad} {self.bad} * {d} THEN 0{good} END"

    def vote(self, s: Column) -> Column:
        """The same vote from a struct of statistics."""
        n, d = 100 * s[self.numerator], s[self.denominator]
        is_bad = n < self.bad * d if self.flip else n >= self.bad * d
        out = F.when(s["n_words"] < self.least, F.lit(None).cast("int")).when(is_bad, 0)
        if self.good is not None:
            out = out.when(n >= self.good * d if self.flip else n < self.good * d, 1)
        return out


RULES = (
    Rule("symbol_characters", "n_symbols", "word_chars", bad=2),
    Rule("symbol_words", "n_marked", "n_words", bad=5),
    Rule("capitals", "n_upper", "n_words", bad=30, least=5),
    Rule("shouting", "n_shouts", "n_words", bad=5),
    Rule("same_word", "n_same", "n_words", bad=20, least=5),
    Rule("repeated_windows", "n_repeat_words", "n_words", bad=30, least=WINDOW),
    Rule("repeated_lines", "n_dup_lines", "n_lines", bad=50),
    Rule("distinct_words", "n_distinct", "n_words", bad=20, good=45, least=5, flip=True),
    Rule("word_length", "word_chars", "n_words", bad=1000, good=650),
)


@dataclass(frozen=True)
class Model:
    """Prior of good (the class balance, given), and per rule the rates of (good vote, bad vote) on good
    and on bad texts."""
    prior: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]

    @staticmethod
    def start(n: int) -> Model:
        return Model(START[0], (START[1],) * n, (START[2],) * n)

    def posterior(self, votes: list[Column]) -> Column:
        logit = F.lit(log(self.prior / (1 - self.prior)))
        for v, g, b in zip(votes, self.on_good, self.on_bad):
            logit = logit + F.when(v == 1, log(g[0] / b[0])).when(v == 0, log(g[1] / b[1])).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))

    def accuracies(self) -> list[float]:
        """Share of each rule's votes that agree with the class."""
        p = self.prior
        return [(p * g[0] + (1 - p) * b[1]) / (p * sum(g) + (1 - p) * sum(b)) for g, b in zip(self.on_good, self.on_bad)]


# Where the fit begins: prior, rates of (good, bad) votes on good and on bad texts.
START = (0.8, (0.6, 0.02), (0.4, 0.3))


def votes(rules: tuple[Rule, ...] = RULES, struct: str = "stats") -> list[Column]:
    return [r.vote(F.col(struct)) for r in rules]


def fit(stats: DataFrame, rules: tuple[Rule, ...] = RULES, iterations: int = 20, smoothing: float = 1.0,
        struct: str = "stats") -> Model:
    """Rule rates by expectation maximisation over the
    counts of all rows' vote patterns. A row on which no rule votes says
    nothing and is left out; the class balance is a given parameter, as votes
    that abstain on clean texts cannot tell it; without any votes the starting model is returned."""
    names = [f"v{j}" for j in range(len(rules))]
    # stored, so that the plans of the iterations are of a few rows
    patterns = cut(stats.select(*[v.alias(n) for v, n in zip(votes(rules, struct), names)])
                   .groupBy(*names).agg(F.count("*").alias("n"))
                   .where(F.coalesce(*names).isNotNull()).coalesce(1))
    model = Model.start(len(rules))
    for _ in range(iterations):
        p = model.posterior([F.col(x) for x in names])
        # weight on good and on bad texts per rule and vote (rule -1: of all rows)
        cast = F.array(F.struct(F.lit(-1).alias("j"), F.lit(1).alias("v")),
                       *[F.struct(F.lit(j).alias("j"), F.col(x).alias("v")) for j, x in enumerate(names)])
        rows = (patterns.select("n", p.alias("p"), F.explode(cast).alias("c")).where("c.v IS NOT NULL")
                .groupBy("c.j", "c.v").agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).collect())
        weight = {(r[0], r[1]): (r[2], r[3]) for r in rows}
        if not weight:
            break
        total = weight[-1, 1]
        rate = lambda c, j: tuple((weight.get((j, v), (0.0, 0.0))[c] + smoothing) / (total[c] + 3 * smoothing) for v in (1, 0))
        model = Model(model.prior, tuple(rate(0, j) for j in range(len(rules))), tuple(rate(1, j) for j in range(len(rules))))
    return model


def judge(stats: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5,
          min_words: int = 20, max_repeat: int = 30, struct: str = "stats") -> DataFrame:
    """``stats`` with ``posterior`` (of being good), ``base_failed`` (too few
    words or too many in repeated windows) and ``kept``."""
    s = F.col(struct)
    failed = (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat * s["n_words"])
    return (stats.withColumn("posterior", model.posterior(votes(rules, struct)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))


def keep(text_col: str, model: Model, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, min_words: int = 20,
         max_repeat: int = 30) -> Column:
    """Whether a text is kept, as one expression over the text whose statistics
    are computed once (for filters, which Spark pushes below projections)."""
    def verdict(s: Column) -> Column:
        failed = (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat * s["n_words"])
        return ~failed & (model.posterior([r.vote(s) for r in rules]) >= threshold)

    return let(statistics(text_col), verdict)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", iterations: int = 20) -> DataFrame:
    """One row per row of ``docs``: id, the statistics, ``posterior``,
    ``base_failed``, ``kept``.

    A null or blank text has no words: all counts 0, base_failed. A null id and
    repeated rows stay as they are; other columns are ignored; an empty table
    gives no rows. Ties at the threshold are kept."""
    stats = cut(features(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
                .select("id", "stats"))
    out = judge(stats, fit(stats, iterations=iterations))
    return out.select(F.col("id").alias(id_col), "stats.n_words", "stats.word_chars", "stats.n_symbols",
                      "stats.n_dup_lines", "stats.n_repeat_words", "base_failed", "kept",
                      F.round("posterior", 6).alias("posterior"))


def oracle_sql(iterations: int = 20, smoothing: float = 1.0) -> str:
    """DuckDB SQL for the rows of :func:`quality` over ``documents``: statistics
    from words and lines unnested into rows, the fit as one CTE per iteration."""
    v = [f"v{j}" for j in range(len(RULES))]
    logit = lambda m: f"ln({m}.prior / (1 - {m}.prior))" + "".join(
        f" + CASE {x} WHEN 1 THEN ln({m}.good_{x}_1 / {m}.bad_{x}_1) WHEN 0 THEN ln({m}.good_{x}_0 / {m}.bad_{x}_0) ELSE 0 END"
        for x in v)
    ctes = [
        "docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents)",
        r"split AS MATERIALIZED (SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM docs)",
        "w AS MATERIALIZED (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split)",
        "per_word AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, count(DISTINCT w) AS n_distinct, "
        "count(*) FILTER (w = upper(w) AND w <> lower(w) AND length(w) > 1) AS n_upper, "
        "count(*) FILTER (regexp_matches(w, '[#*$%&|<>]')) AS n_marked FROM w GROUP BY rid)",
        "same AS (SELECT rid, count(*) FILTER (w = before) AS n_same FROM (SELECT rid, w, lag(w) OVER (PARTITION BY rid ORDER BY i) AS before FROM w) GROUP BY rid)",
        f"win AS MATERIALIZED (SELECT rid, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS x FROM "
        f"(SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM split WHERE len(ws) >= {WINDOW}))",
        "rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM (SELECT win.rid, win.i FROM win JOIN "
        "(SELECT rid, x FROM win GROUP BY rid, x HAVING count(*) > 1) t ON win.rid = t.rid AND win.x = t.x) "
        f"CROSS JOIN (SELECT unnest(range({WINDOW})) AS o) GROUP BY rid)",
        "ln AS (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM docs)",
        r"per_line AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM ln WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid)",
        "stats AS MATERIALIZED (SELECT rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, "
        "length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, "
        "coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, "
        "coalesce(n_distinct, 0) AS n_distinct, coalesce(n_upper, 0) AS n_upper, coalesce(n_same, 0) AS n_same, coalesce(n_marked, 0) AS n_marked, "
        "(length(text) - length(replace(text, '!!', ''))) // 2 AS n_shouts FROM docs LEFT JOIN per_word USING (rid) "
        "LEFT JOIN same USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN per_line USING (rid))",
        "voted AS MATERIALIZED (SELECT *, " + ", ".join(f"{r.sql()} AS {x}" for r, x in zip(RULES, v)) + " FROM stats)",
        f"pat AS MATERIALIZED (SELECT {', '.join(v)}, count(*)::DOUBLE AS n FROM voted WHERE coalesce({', '.join(v)}) IS NOT NULL GROUP BY ALL)",
        f"m0 AS MATERIALIZED (SELECT {START[0]}::DOUBLE AS prior, " + ", ".join(
            f"{START[1][1 - k]}::DOUBLE AS good_{x}_{k}, {START[2][1 - k]}::DOUBLE AS bad_{x}_{k}" for x in v for k in (1, 0)) + ")",
    ]
    total = {"good": "sum(n * p)", "bad": "sum(n * (1 - p))"}
    for k in range(1, iterations + 1):
        cols = ["min(prior) AS prior"]
        cols += [f"(coalesce({total[c]} FILTER ({x} = {u}), 0) + {smoothing}) / ({total[c]} + {3 * smoothing}) AS {c}_{x}_{u}"
                 for x in v for u in (1, 0) for c in ("good", "bad")]
        ctes.append(f"m{k} AS MATERIALIZED (SELECT {', '.join(cols)} FROM (SELECT pat.*, m.prior, 1 / (1 + exp(-({logit('m')}))) AS p FROM pat, m{k - 1} AS m))")
    return ("WITH " + ",\n".join(ctes) + ",\n" + f"judged AS (SELECT voted.*, 1 / (1 + exp(-({logit('m')}))) AS p, "
            f"n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM voted, m{iterations} AS m)\n"
            "SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
            "NOT base_failed AND p >= 0.5 AS kept, round(p, 6) AS posterior FROM judged")
