"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at a few numbers of a text and votes good, bad or nothing.
How far a rule can be trusted is not set by hand: expectation-maximisation
over all documents estimates, per rule and kind of vote, how large a share
of the good and of the bad documents gets it, and the share of good ones; a
document's posterior probability of being good then decides instead of all
rules having to pass.
The estimation needs only how often each pattern of votes occurs (one
grouped count; at most 3 to the power of the number of rules), so its
rounds fold over one small row.  DataFrame functions throughout.

Repeated 3-word windows are found inside the row: the windows' 64-bit
hashes are sorted with their positions and neighbours compared, so a text
of n words costs n log n and nothing leaves its row.

Defined results: null texts count as empty, have no words and fail the base;
repeated rows get equal rows; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import WORD, ready, stored

SYMBOLS, CAPITALS = "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rounds of EM; the weight of the starting values beside the counts, as a
#: share of all documents; the posterior from which a document is kept.
ROUNDS, WEIGHT, KEEP = 25, 0.3, 0.5
#: Where EM starts: most documents are good; a rule faults few good and some
#: of the bad documents, and praises most good and some bad ones.
PRIOR, START = 0.8, {"bad": (0.02, 0.3), "good": (0.8, 0.4)}

#: (name, votes bad if, votes good if), in SQL of Spark and of DuckDB alike.
RULES = [
    ("symbols", "10 * n_symbols > n_words", "FALSE"),
    ("repeats", "100 * n_repeat_words > 30 * n_words", "FALSE"),
    ("lines", "100 * n_dup_lines > 25 * n_lines", "FALSE"),
    ("bangs", "10 * n_bangs > 3 * n_words", "FALSE"),
    ("capitals", "10 * n_capitals > 3 * word_chars", "FALSE"),
    ("lengths", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "FALSE"),
    ("unstopped", "200 * n_stops < n_words", "FALSE"),
    ("prose", "FALSE", "n_symbols = 0 AND 20 * n_bangs < n_words AND 50 * n_stops >= n_words"),
]
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _less(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the numbers that base and rules look at."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), t.alias("t"))
    df = df.select("doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"),
                   F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    n = F.size("w")
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    df = df.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _less(F.col("t"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("t") - F.length(F.replace(F.col("t"), F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        (F.length("t") - F.length(F.replace(F.col("t"), F.lit("."), F.lit("")))).cast("long").alias("n_stops"),
        _less(F.col("t"), CAPITALS).alias("n_capitals"),
        F.when(n >= 3, F.sort_array(window)).alias("s"))
    twice = F.filter("s", lambda x, j: x["h"].eqNullSafe(F.get("s", j - 1)["h"])
                     | x["h"].eqNullSafe(F.get("s", j + 1)["h"]))
    inside = F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return df.withColumn("n_repeat_words", F.coalesce(F.size(inside), F.lit(0)).cast("long")).withColumn(
        "n_repeat_words", F.when(F.col("s").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_repeat_words"))
    ).drop("s")


def vote(bad: str, good: str) -> Column:
    """-1 bad, 1 good, 0 nothing."""
    return F.when(F.expr(bad), F.lit(-1)).when(F.expr(good), F.lit(1)).otherwise(F.lit(0))


def posterior(model: dict) -> Column:
    """Probability of being good, from the votes cast (no vote, no evidence)."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for name, shares in model["rules"].items():
        for v, kind in ((-1, "bad"), (1, "good")):
            good, bad = shares[kind]
            odds = odds + F.when(F.col(name) == v, math.log(good / bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def em_round(patterns: Column, state: Column, size: int) -> Column:
    """One round of EM: ``patterns`` is an array of (v, n), ``state`` an array
    of the prior and, per rule, the shares of good and of bad documents voted
    bad, then of those voted good."""
    rules = F.sequence(F.lit(0), F.lit(size - 1))

    def evidence(p):
        def one(s, j):
            at = 4 * j
            return s + F.when(F.get(p["v"], j) == -1, F.log(F.get(state, at + 1) / F.get(state, at + 2))).when(
                F.get(p["v"], j) == 1, F.log(F.get(state, at + 3) / F.get(state, at + 4))).otherwise(0.0)
        prior = F.get(state, F.lit(0))
        return p["n"] / (1 + F.exp(-F.aggregate(rules, F.log(prior / (1 - prior)), one)))

    weighed = F.transform(patterns, lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), evidence(p).alias("g")))

    def after(w):
        everything = _sum(F.transform(w, lambda p: p["n"]))
        good = _sum(F.transform(w, lambda p: p["g"]))

        def shares(totals):
            n, g = totals["n"], totals["g"]

            def rule(j):
                out = []
                for v, kind in ((-1, "bad"), (1, "good")):
                    here = F.filter(w, lambda p: F.get(p["v"], j) == v)  # noqa: B023
                    as_good = _sum(F.transform(here, lambda p: p["g"]))
                    as_bad = _sum(F.transform(here, lambda p: p["n"] - p["g"]))
                    out += [(as_good + WEIGHT * START[kind][0] * n) / (g + WEIGHT * n),
                            (as_bad + WEIGHT * START[kind][1] * n) / (n - g + WEIGHT * n)]
                return F.array(*out)
            return F.concat(F.array((g + WEIGHT * PRIOR * n) / ((1 + WEIGHT) * n)), F.flatten(F.transform(rules, rule)))
        return _let(F.struct(everything.alias("n"), good.alias("g")), shares)
    return _let(weighed, after)


def fit(votes: DataFrame, rounds: int = ROUNDS) -> dict:
    """EM over the counts of vote patterns: the share of good documents, and
    per rule and kind of vote the shares of good and of bad documents that get
    it; their ratio is how far the vote can be trusted.  The starting values
    stay in as pseudo-documents, which keeps the classes what they are named.
    All rounds fold over one row that holds the patterns (3 to the power of
    the number of rules at most)."""
    names = [name for name, *_ in RULES]
    first = [PRIOR, *[share for _ in names for kind in ("bad", "good") for share in START[kind]]]
    patterns = votes.groupBy(F.array(*names).alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    row = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.array(*[F.lit(x) for x in first]),
                        lambda s, _: em_round(F.col("p"), s, len(names)))
    got = row.select(F.when(F.size("p") > 0, state).alias("s")).first()["s"] or first
    return {"prior": got[0], "rules": {name: {"bad": got[4 * j + 1:4 * j + 3], "good": got[4 * j + 3:4 * j + 5]}
                                       for j, name in enumerate(names)}}


def weak_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, quality (the posterior) and the rules' votes."""
    ready(docs)
    rows = features(docs, id_col, text_col).withColumn("base_failed", F.expr(BASE_FAILED))
    rows = stored(rows.withColumns({name: vote(bad, good) for name, bad, good in RULES}), "rule_votes")
    model = fit(rows, rounds)
    return (rows.withColumn("quality", posterior(model))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "quality", *[name for name, *_ in RULES]))


def oracle(rounds: int = ROUNDS, keep: float = KEEP) -> str:
    """The same in DuckDB, EM written out round by round."""
    names = [name for name, *_ in RULES]
    odds = "ln(m.prior / (1 - m.prior))" + "".join(
        f" + CASE {x} WHEN -1 THEN ln(m.{x}_bad_g / m.{x}_bad_b) WHEN 1 THEN ln(m.{x}_good_g / m.{x}_good_b) ELSE 0 END"
        for x in names)
    p = f"(1 / (1 + exp(-({odds}))))"
    votes = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS {x}" for x, bad, good in RULES)
    shares = ", ".join(
        f"(sum(CASE WHEN {x} = {v} THEN n * {q} ELSE 0 END) + {WEIGHT * START[kind][k]} * sum(n)) / "
        f"(sum(n * {q}) + {WEIGHT} * sum(n)) "
        f"AS {x}_{kind}_{c}" for x in names for v, kind in ((-1, "bad"), (1, "good"))
        for k, (q, c) in enumerate((("p", "g"), ("(1 - p)", "b"))))
    steps = [f"m{k + 1} AS MATERIALIZED (SELECT (sum(n * p) + {WEIGHT * PRIOR} * sum(n)) / ({1 + WEIGHT} * sum(n)) AS prior, {shares} "
             f"FROM (SELECT c.*, {p} AS p FROM patterns c, m{k} m))" for k in range(rounds)]
    first = ", ".join(f"{START[kind][k]}::DOUBLE AS {x}_{kind}_{c}" for x in names for kind in START
                      for k, c in enumerate("gb"))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT row, i, list_extract(w, i) || ' ' || list_extract(w, i + 1) || ' ' || list_extract(w, i + 2) AS g
      FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
d AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, g) AS c FROM g) WHERE c > 1),
r AS (SELECT row, count(DISTINCT i + k) AS n FROM d, (VALUES (0), (1), (2)) v(k) GROUP BY row),
f AS (SELECT doc_id, row, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs, length(regexp_replace(t, '[^.]', '', 'g')) AS n_stops,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, coalesce(r.n, 0) AS n_repeat_words
      FROM w LEFT JOIN r USING (row)),
v AS MATERIALIZED (SELECT *, {BASE_FAILED} AS base_failed, {votes} FROM f),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, count(*) AS n FROM v GROUP BY ALL),
m0 AS MATERIALIZED (SELECT {PRIOR}::DOUBLE AS prior, {first}),
{', '.join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {p} >= {keep} AS kept
FROM v, m{rounds} m
"""
