"""Exact quantiles by rank (A14, A15, A19, A25, M03) without a value map or a
sort of all values.

The range of each column is cut into equal bins and their rows are counted by
partial aggregates; the counts tell which bin holds a wanted rank.  Only the
values of those bins are cut into bins again, between the smallest and the
largest value found there, and only what is left after that is ordered: distinct
values with their counts, about rows / BINS² of them.  A bin of one value, however
often it occurs, needs no ordering.  Results are interpolated linearly
(pandas, ``percentile``); NaN counts as greatest, nulls are left out.

Leave-one-part-out quantiles (the training sides of cross-validation) come from the
same passes: counts are kept per part, and a side's counts are all but one part's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, LEVELS = 1024, 2
_INF = float("inf")


def _long(df: DataFrame, cols: Sequence[str], keep: dict[str, Column]) -> DataFrame:
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"`{c}`").cast("double").alias("v"))
                                 for i, c in enumerate(cols)])).alias("_s")
    return df.select(*[c.alias(n) for n, c in keep.items()], values).select(
        *keep, "_s.k", "_s.v").where("v is not null")


def _same(a: DataFrame, b: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Join on null-safe equal keys; ``b`` renamed.  A table with a row per column, or per
    bin with a wanted rank, is broadcast; one with rows per group is not."""
    other = b.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in b.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & a[c].eqNullSafe(other[f"_{c}"])
    return a.join(F.broadcast(other) if small else other, cond).drop(*[f"_{c}" for c in on])


def _bin(lo: Column, hi: Column) -> Column:
    """Bin of ``v`` between ``lo`` and ``hi``: rising with v, values without end outside."""
    share = (F.col("v") - lo) / F.nullif(hi - lo, F.lit(0.0))
    return (F.when(F.isnan("v") | (F.col("v") == _INF), F.lit(BINS)).when(F.col("v") == -_INF, F.lit(-1))
            .otherwise(F.least(F.lit(BINS - 1), F.coalesce(F.floor(share * BINS), F.lit(0)).cast("int"))))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              without: str | None = None) -> DataFrame:
    """(by, column, n, q): n values and the quantiles (array, in the order of ``probs``)
    of each column, per group; with ``without``, instead of groups, per value of that
    column (as ``side``) over the rows that have another value.  Groups and columns
    without values are missing from the result."""
    names = [f"_g{i}" for i in range(len(by))]
    keep = {n: F.col(f"`{c}`") for n, c in zip(names, by)}
    if without:
        if by:
            raise ValueError("by and without exclude each other")
        keep["_part"] = F.col(f"`{without}`")
    long = _long(df, cols, keep)
    key, small = [*names, "k"], not by
    side = [*key, "side"] if without else key
    finite = F.when(~F.isnan("v") & (F.abs("v") != _INF), F.col("v"))
    ends = long.groupBy(*key).agg(F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    scan = _same(long, ends, key, small).withColumn("b1", _bin(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    if without:
        parts = df.select(F.col(f"`{without}`").alias("_p")).distinct().agg(F.collect_list("_p").alias("_all"))

    def counted(frame: DataFrame, bins: list[str]) -> DataFrame:
        """Rows, smallest and largest value of each bin (of each side)."""
        per = frame.groupBy(*key, *bins, *(["_part"] if without else [])).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        if not without:
            return per
        others = F.filter(F.col("_all"), lambda p: p != F.col("_part"))
        return per.withColumn("_all", parts.scalar()).withColumn("side", F.explode(others)).groupBy(*side, *bins).agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def placed(cells: DataFrame, bins: list[str], base: Column) -> DataFrame:
        """Those bins that hold a wanted rank, with the number of values before them."""
        w = Window.partitionBy(*side, *bins[:-1]).orderBy(bins[-1])
        cells = cells.withColumn("start", base + F.sum("n").over(w) - F.col("n"))
        return cells.where(F.exists("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n"))))

    def wanted(total: Column) -> Column:
        at = [F.lit(float(p)) * (total - 1) for p in probs]
        return F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))

    first = counted(scan, ["b1"])
    totals = first.groupBy(*side).agg(F.sum("n").alias("total"))
    bins, found = ["b1"], []
    cells = _same(first, totals.withColumn("ranks", wanted(F.col("total"))), side, small)
    open_ = placed(cells, bins, F.lit(0))
    pick = [*side, "start", "n", "v"]
    for level in range(2, LEVELS + 2):
        found.append(open_.where("lo = hi").select(*side, "start", "n", F.col("lo").alias("v")))
        open_ = open_.where("lo <> hi")
        need = open_.groupBy(*key, *bins).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        scan = _same(scan, need, [*key, *bins], small)
        inner = f"b{level}"
        if level <= LEVELS:
            ends = (F.when(F.abs("lo") == _INF, F.lit(0.0)).otherwise(F.col("lo")),
                    F.when(F.isnan("hi") | (F.abs("hi") == _INF), F.lit(0.0)).otherwise(F.col("hi")))
            scan = scan.withColumn(inner, _bin(*ends)).drop("lo", "hi")
        else:
            scan = scan.withColumn(inner, F.col("v")).drop("lo", "hi")
        below = open_.select(*side, *bins, F.col("start").alias("base"), "ranks")
        cells = _same(counted(scan, [*bins, inner]), below, [*side, *bins], small)
        bins.append(inner)
        open_ = placed(cells, bins, F.col("base"))
    found.append(open_.select(*side, "start", "n", F.col("lo").alias("v")))
    values = found[0].select(*pick)
    for more in found[1:]:
        values = values.unionByName(more.select(*pick))
    held = values.groupBy(*side).agg(F.collect_list(F.struct("start", "n", "v")).alias("held"))
    out = _same(totals, held, side, small)

    def at(rank: Column) -> Column:
        return F.filter("held", lambda h: (rank >= h["start"]) & (rank < h["start"] + h["n"]))[0]["v"]

    def value(p: float) -> Column:
        place = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
        return F.when((low == high) | (at(low) == at(high)), at(low)).otherwise(
            (high - place) * at(low) + (place - low) * at(high))

    labels = F.array(*[F.lit(c) for c in cols])
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, by)], *(["side"] if without else []),
                      labels[F.col("k")].alias("column"), F.col("total").alias("n"),
                      F.array(*[value(p) for p in probs]).alias("q"))


def wide(found: DataFrame, cols: Sequence[str], by: Sequence[str] = (), at: int = 0, prefix: str = "") -> DataFrame:
    """One column per quantile column (the quantile at ``at``), one row per group."""
    one = [F.max(F.when(F.col("column") == c, F.col("q")[at])).alias(f"{prefix}{c}") for c in cols]
    return found.groupBy(*by).agg(*one) if by else found.agg(*one)
