"""Mixing sources to target weights by the cube method.

Each source has a target number of words; its rate (target over words) is
split into whole repeats of every document and a fraction, the inclusion
probability of one more.  Which documents get that one more is a balanced
sample: within blocks of a source, three documents at a time, the
probabilities move along the null space of the balancing constraints
(documents and words), so that their sums stay as they are while one
probability after another lands on 0 or 1.  A few documents of each block, of
all its sizes, do not take part, and at most two others are still open at its
end; the open ones of all blocks form new blocks, until a source has one block.
There the landing decides the few that are left: of all choices the one whose
words come nearest to their expectation, then whose number does (the number's
constraint is dropped first).  Blocks hold a bounded number of documents
whatever a source's size: documents are dealt by their hash and, where several
rows have one hash, by an ordinal among them.  Every random choice follows from
the documents' own hashes, so reruns agree.

Defined results: null or empty texts have size 0 and take 0; a null source
is a source of its own, the last in order; repeated rows are documents of
their own; a source without words has target 0; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import free_name, n_words, numbered, ready, stored

WEIGHTS, MOST_TIMES, BLOCK = (1, 2, 3), 3.0, 1000
#: Documents of a block that are left for the landing.
LANDING = 12
NEAR = 1e-9


def row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, target, src) from rows of (source, size); one
    row per source.  Water filling: sources in the order of the level at
    which they reach their ceiling; the level of the first that does not
    reach it (the greatest such level) holds for all."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("src") % len(weights) + 1).cast("int"))
    per = per.withColumn("src", F.row_number().over(by_name) - 1).withColumn("w", w).withColumn(
        "ceiling", most * F.col("source_size"))
    before = Window.orderBy(F.col("ceiling") / F.col("w"), "src").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(whole) - F.sum("ceiling").over(before)
                                   + F.col("ceiling"))
                         / (F.sum("w").over(whole) - F.sum("w").over(before) + F.col("w")))
    short = F.when(F.col("ceiling") > F.col("w") * F.col("level"), F.col("level"))
    per = per.withColumn("at", F.coalesce(F.max(short).over(whole), F.lit(float("inf"))))
    return per.select("source", "source_size", "src",
                      F.least(F.col("ceiling"), F.col("w") * F.col("at")).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight; their sum and their sum weighted by
    ``size`` are unchanged, and at most two lie strictly between 0 and 1."""
    p, size, draw = p.tolist(), size.astype(float).tolist(), rng.random
    active: list[int] = []
    for k in range(len(p)):
        if not NEAR < p[k] < 1 - NEAR:
            p[k] = float(round(p[k]))
            continue
        active.append(k)
        while len(active) == 3 or len(active) == 2 and size[active[0]] == size[active[1]]:
            s = [size[i] for i in active]
            u = ([s[1] - s[2], s[2] - s[0], s[0] - s[1]] if len(s) == 3 and not s[0] == s[1] == s[2]
                 else [1.0, -1.0, 0.0][:len(s)])
            up = min((1 - p[i]) / c if c > 0 else -p[i] / c for i, c in zip(active, u) if c)
            down = min(p[i] / c if c > 0 else (p[i] - 1) / c for i, c in zip(active, u) if c)
            step = up if draw() * (up + down) < down else -down
            for i, c in zip(active, u):
                p[i] += step * c
            left = [i for i in active if NEAR < p[i] < 1 - NEAR]
            for i in active:
                if i not in left:
                    p[i] = float(round(p[i]))
            if len(left) == len(active):  # rounding only: the nearest one lands
                i = min(left, key=lambda i: min(p[i], 1 - p[i]))
                p[i] = float(round(p[i]))
                left.remove(i)
            active = left
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decides the open documents (LANDING + 2 at most): of all choices the one whose
    words come nearest to their expectation, then whose number does."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = choices - p[open_]
    words, number = np.abs(off @ size[open_].astype(float)), np.abs(off.sum(1))
    out = p.copy()
    out[open_] = choices[np.lexsort((number, np.round(words, 6)))[0]]
    return out


def set_aside(n: int, keep: int = LANDING) -> np.ndarray:
    """Which of ``n`` documents in order of size are left for the landing: evenly
    spaced ones, the smallest among them."""
    aside = np.zeros(n, bool)
    aside[np.unique(n - 1 - np.arange(min(n, keep)) * n // max(1, min(n, keep)))] = True
    return aside


def fly_block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "h", "k"], ascending=[False, True, True], kind="stable")
    size, p = rows["size"].to_numpy(), rows["p"].to_numpy().copy()
    seed = [int(rows[c].iloc[0]) for c in ("src", "turn", "block")]
    flies = ~set_aside(len(rows))
    p[flies] = flight(p[flies], size[flies], np.random.default_rng(seed))
    if rows["blocks"].iloc[0] == 1:
        p = landing(p, size)
    rows = rows[["row", "src", "size", "h", "k"]].copy()
    rows["p"] = p
    return rows


def ordinals(rows: DataFrame) -> DataFrame:
    """``rows`` (with h and part, the partition they were stored from) with k, a number
    among the rows of one h, from 0.  Rows are numbered within each part and the
    parts' counts are added up, so that no task holds all rows of a frequent h."""
    per = rows.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    several = per.groupBy("h").agg(F.sum("n").alias("rows")).where("rows > 1").select("h")
    start = F.sum("n").over(Window.partitionBy("h").orderBy("part")) - F.col("n")
    starts = stored(per.join(several, "h", "left_semi").select("h", "part", start.alias("start")), "repeats")
    alone = rows.join(starts.select("h").distinct(), "h", "left_anti").withColumn("k", F.lit(0).cast("long"))
    own = F.row_number().over(Window.partitionBy("h", "part").orderBy("row")) - 1
    more = rows.join(starts, ["h", "part"]).withColumn("k", F.col("start") + own).drop("start")
    return alone.unionByName(more).drop("part")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most: float = MOST_TIMES, block: int = BLOCK, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken,
    times (how often the document is taken) and row (``row_col``, or the rows' order as read)."""
    ready(docs)
    sizes = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               n_words(F.col(text_col).cast("string")).alias("size"),
                               row_hash(id_col, text_col).alias("h"), F.spark_partition_id().alias("part"),
                               (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row")), "sizes")
    per = stored(targets(sizes, weights, most).withColumn(
        "rate", F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))), "targets")
    base = F.floor(F.col("rate") + NEAR)
    rows = stored(
        sizes.join(per.withColumnRenamed("source", "s_"), F.col("source").eqNullSafe(F.col("s_")))
        .select("doc_id", "size", "h", "part", "src", "source_size", "target", base.alias("base"),
                F.greatest(F.col("rate") - base, F.lit(0.0)).alias("p"), "row"), "rates")
    open_ = ordinals(rows.where(F.col("p") > NEAR).select("row", "part", "src", "size", "h", "p"))
    decided, turn = None, 0
    while True:
        blocks = open_.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        blocks = stored(blocks, "blocks")
        most_blocks = blocks.agg(F.max("blocks")).first()[0]
        if most_blocks is None:
            break
        dealt = open_.join(blocks, "src").withColumns({
            "turn": F.lit(turn), "block": F.pmod(F.xxhash64("h", "k", F.lit(turn)), "blocks").cast("long")})
        flown = stored(dealt.groupBy("src", "block").applyInPandas(
            fly_block, "row long, src int, size long, h long, k long, p double"), f"flight{turn}")
        done = flown.where("p = 0 or p = 1").select("row", F.col("p").cast("int").alias("more"))
        decided = done if decided is None else decided.unionByName(done)
        open_ = flown.where("p > 0 and p < 1")
        turn += 1
        if most_blocks == 1:
            break
    if decided is None:
        rows = rows.withColumn("more", F.lit(0))
    else:
        rows = rows.join(decided, "row", "left")
    times = (F.col("base") + F.coalesce("more", F.lit(0))).cast("int")
    return rows.withColumn("times", times).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "row")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs``, read from files, with each row as often as the mix takes it (options
    as in mix()); further columns stay, whatever their names."""
    rowed, row = numbered(docs)
    times = free_name(rowed, "times")
    taken = mix(rowed, row_col=row, **options).where("times > 0").select(
        F.col("row").alias(row), F.col("times").alias(times))
    again = F.explode(F.array_repeat(F.lit(0), F.col(times))).alias(free_name(rowed, "again"))
    return rowed.join(taken, row).select(*docs.columns, again).select(*docs.columns)
