"""Data behind the charts (A23-A26): histogram bins, kernel
density on a grid, box-plot statistics and least-squares lines.

Drawing is out of scope; these return the numbers a chart shows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import quantiles


def histogram(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the column's min and max (per group
    with ``by``); the last bin includes the max; empty bins are 0.

    The range is one aggregate; binning is a projection; counts are a
    partial aggregate; the bin list (``bins`` rows per group) is generated
    per group row with ``explode(sequence)`` — never per data row.
    """
    by = list(by)
    v = F.col(col)
    clean = df.where(v.isNotNull() & ~F.isnan(v))
    rng = clean.groupBy(*by).agg(F.min(v).cast("double").alias("_lo"),
                                 F.max(v).cast("double").alias("_hi"))
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins).otherwise(1.0)
    if by:
        joined = clean.join(rng, by)
    else:
        joined = clean.withColumn("_r", rng.select(F.struct("_lo", "_hi")).scalar()) \
                      .select("*", F.col("_r._lo").alias("_lo"), F.col("_r._hi").alias("_hi"))
    b = F.least(F.floor((v - F.col("_lo")) / width).cast("int"), F.lit(bins - 1))
    counts = joined.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = rng.select(*by, "_lo", width.alias("_w"),
                       F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = edges.join(counts, [*by, "bin"], "left")
    return out.select(*by, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lower"),
                      (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("upper"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def density(df: DataFrame, col: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth n^(-1/5)·std) on
    ``points`` grid values from min − cut·h to max + cut·h.

    Every grid point is a sum of its own in one aggregate, so a task folds each of
    its rows into ``points`` running sums; no rows are made and none are shuffled
    but one per task.
    """
    v = F.col(col)
    clean = df.where(v.isNotNull() & ~F.isnan(v)).select(v.cast("double").alias("x"))
    st = clean.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                   F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    if not n or not sd:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-0.2)
    step = (hi - lo + 2 * cut * h) / (points - 1)
    at = [lo - cut * h + k * step for k in range(points)]
    kernel = [F.sum(F.exp(-0.5 * F.pow((F.lit(x) - F.col("x")) / h, 2))).alias(f"s{k}") for k, x in enumerate(at)]
    scale = n * h * math.sqrt(2 * math.pi)
    return clean.agg(*kernel).select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("point"), F.lit(x).alias("x"), (F.col(f"s{k}") / scale).alias("density"))
        for k, x in enumerate(at)])))


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whis: float = 1.5) -> DataFrame:
    """Quartiles (linear), IQR, whiskers (most extreme values inside
    the 1.5·IQR fences) and the outlier count per group."""
    by = list(by)
    v = F.col(col)
    q = quantiles(df, [col], [0.25, 0.5, 0.75], by)
    if not by:  # a row without values, too
        q = q.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("q").alias("q"))
    q = q.select(*by, "n", *[F.col("q")[k].alias(name) for k, name in enumerate(("q1", "median", "q3"))])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - whis * F.col("iqr")
    hi_f = F.col("q3") + whis * F.col("iqr")
    j = df.where(v.isNotNull()).join(q, by) if by else \
        df.where(v.isNotNull()).withColumn("_q", q.select(F.struct(*q.columns)).scalar()).select(
            "*", *[F.col(f"_q.{c}").alias(c) for c in q.columns])
    inside = (v >= lo_f) & (v <= hi_f)
    w = j.groupBy(*by).agg(F.min(F.when(inside, v)).cast("double").alias("whisker_low"),
                           F.max(F.when(inside, v)).cast("double").alias("whisker_high"),
                           F.count_if(~inside).alias("outliers"))
    return q.join(w, by) if by else q.withColumn("_w", w.select(F.struct(*w.columns)).scalar()) \
        .select(*q.columns, "_w.whisker_low", "_w.whisker_high", "_w.outliers")


def fit_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope / intercept and Pearson r (complete pairs)."""
    g = df.groupBy(*by) if by else df
    return g.agg(F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n"),
                 F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                 F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                 F.corr(F.col(x), F.col(y)).alias("r"))
