"""One-way ANOVA (A27) and the F distribution tail.

The F statistic is one grouped aggregate (count, mean, variance per group)
folded into one row.  The p-value is the regularised incomplete beta function of
that row, as Column expressions: Stirling's series for the gamma functions and
Lentz's evaluation of the continued fraction as a fold over its steps, which
stands still once a step no longer changes the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of the continued fraction at most (about the square root of the greater
#: parameter is needed), and the relative change that ends it.
STEPS, SMALL, TINY = 20_000, 1e-15, 1e-300
# Bernoulli numbers B(2k) / (2k (2k - 1)) of Stirling's series
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156]


def log_gamma(x: Column) -> Column:
    """ln Γ(x) for positive x: shifted up by 10, where Stirling's series is exact to
    the last digits."""
    z = x + 10
    series = sum((F.lit(c) / F.pow(z, 2 * k + 1) for k, c in enumerate(STIRLING)), F.lit(0.0))
    shift = sum((F.log(x + k) for k in range(10)), F.lit(0.0))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def _away(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function; null if it does not settle."""
    start = F.lit(1.0) / _away(1.0 - (a + b) * x / (a + 1.0))

    def half(state: Column, term: Column) -> list[Column]:
        """(c, d, h) after a term of the fraction."""
        d = 1.0 / _away(1.0 + term * state["d"])
        c = _away(1.0 + term / state["c"])
        return [c, d, state["h"] * c * d]

    def step(state: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        c, d, h = half(state, even)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        middle = F.struct(c.alias("c"), d.alias("d"), h.alias("h"))
        c, d, h = half(middle, odd)
        new = F.struct(c.alias("c"), d.alias("d"), h.alias("h"), (F.abs(c * d - 1.0) < SMALL).alias("done"))
        return F.when(state["done"], state).otherwise(new)

    first = F.struct(F.lit(1.0).alias("c"), start.alias("d"), start.alias("h"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, step,
                       lambda state: F.when(state["done"], state["h"]))


def beta_cdf(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b)."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    # the fraction is evaluated once, on the side where it settles quickly
    low = x < (a + 1.0) / (a + b + 2.0)
    p, q, t = F.when(low, a).otherwise(b), F.when(low, b).otherwise(a), F.when(low, x).otherwise(1.0 - x)
    part = front * _fraction(p, q, t) / p
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(F.when(low, part).otherwise(1.0 - part))


def f_tail(f: Column, d1: Column, d2: Column) -> Column:
    """Survival function of the F distribution: P(F' > f); null without degrees of freedom."""
    inside = beta_cdf(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
    return F.when((d1 > 0) & (d2 > 0) & f.isNotNull(), F.when(f <= 0, F.lit(1.0)).when(
        f == float("inf"), F.lit(0.0)).otherwise(inside))


def anova(df: DataFrame, value: str, group: str, exclude=(-1,), with_p: bool = True
          ) -> DataFrame:
    """One-way ANOVA of ``value`` across ``group`` (rows whose group is
    in ``exclude`` dropped, e.g. DBSCAN noise).  Fewer than 2 groups →
    NULL F / p."""
    v, g = F.col(value), F.col(group)
    keep = v.isNotNull() & g.isNotNull()
    if exclude:
        keep = keep & ~g.isin(list(exclude))
    kept = df.where(keep)
    centre = kept.agg(F.avg(v)).scalar()  # sums around the mean keep their digits
    per = kept.groupBy(group).agg(
        F.count(v).alias("n"), F.avg(v - centre).alias("m"),
        F.coalesce(F.var_samp(v), F.lit(0.0)).alias("var"))
    tot = per.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n_total"),
                  F.sum(F.col("n") * F.col("m") * F.col("m")).alias("ssb"),
                  F.sum((F.col("n") - 1) * F.col("var")).alias("ssw"))
    d1 = F.col("groups") - 1
    d2 = F.col("n_total") - F.col("groups")
    fstat = F.when((F.col("groups") >= 2) & (d2 > 0),
                   (F.col("ssb") / d1) / F.nullif(F.col("ssw") / d2, F.lit(0.0)))
    out = tot.select("groups", "n_total", "ssb", "ssw", fstat.alias("f_stat"),
                     d1.cast("double").alias("df_between"), d2.cast("double").alias("df_within"))
    if with_p:
        out = out.withColumn("p_value", f_tail(F.col("f_stat"), F.col("df_between"), F.col("df_within")))
    return out
