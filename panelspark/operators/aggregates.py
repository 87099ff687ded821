"""Grouped aggregates.

Every aggregate here is a single ``groupBy().agg()`` built from Spark's
built-in aggregate functions, so the physical plan is a partial
(map-side) aggregate, a shuffle of the small partial rows, and a final
aggregate.  A key holding a third of all rows is folded on the map side
before it reaches any single task.  ``median``/``percentile`` are the exact
ones (linear interpolation, like pandas); their buffer is a value→count
map, so the memory per group is bounded by the number of distinct values,
not by the group size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import quantiles, wide
from pyspark.sql import types as T

from panelspark.functions.numbers import round_half_even
from panelspark.functions.rules import flag_in, flag_over


def exposure_stats(df: DataFrame, keys: Sequence[str], value: str, prefix: str,
                   quantiles: Mapping[str, float] = {"p90": 0.9}) -> list[Column]:
    """A01 aggregate expressions: count, mean, std, median, quantiles, max."""
    v = F.col(value)
    out = [
        F.count(v).alias(f"{prefix}observed_days"),
        F.avg(v).alias(f"{prefix}mean"),
        F.stddev_samp(v).alias(f"{prefix}std"),
        F.median(v).alias(f"{prefix}median"),
    ]
    out += [F.percentile(v, q).alias(f"{prefix}{name}") for name, q in quantiles.items()]
    out.append(F.max(v).alias(f"{prefix}max"))
    return out


def days_over(value: str, thresholds: Sequence[float], prefix: str) -> list[Column]:
    """Number of rows whose value exceeds each threshold."""
    return [F.count_if(flag_over(value, t)).alias(f"{prefix}days_over_{int(t)}")
            for t in thresholds]


def count_in(col: str, values: Sequence[str], alias: str) -> Column:
    return F.count_if(flag_in(col, values)).alias(alias)


def monthly_profile(df: DataFrame, keys: Sequence[str], month: str, value: str,
                    prefix: str) -> DataFrame:
    """Mean per (keys, month), then std / max / count of the monthly
    means per keys.  Both levels are partial aggregates; the second one
    only shuffles at most one row per month and key."""
    monthly = (df.groupBy(*keys, month)
                 .agg(F.avg(value).alias("_monthly_mean")))
    return (monthly.groupBy(*keys)
                   .agg(F.stddev_samp("_monthly_mean").alias(f"{prefix}monthly_mean_std"),
                        F.max("_monthly_mean").alias(f"{prefix}monthly_mean_max"),
                        F.count("_monthly_mean").alias(f"{prefix}months_observed")))


def crosstab_exprs(col: Column, values: Sequence[str], names: Sequence[str],
                   prefix: str) -> list[Column]:
    """A04 as conditional counts: one column per listed value, 0 when absent.

    Equivalent to ``groupBy.pivot(col, values).count().fillna(0)`` but it
    stays inside the same aggregate as the other statistics, so the whole
    feature row is one partial/final aggregate pair.  Rows whose pivot
    value is NULL are not counted (pandas ``crosstab`` drops them); a value
    that is not listed raises, as its rows would vanish.
    """
    listed = F.concat(F.lit("value not listed for the crosstab: "), col.cast("string"))
    col = F.when(col.isNull() | col.isin(list(values)), col).otherwise(F.raise_error(listed))
    return [F.count_if(F.coalesce(col == F.lit(v), F.lit(False))).alias(f"{prefix}{n}")
            for v, n in zip(values, names)]


def crosstab_counts(df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str],
                    prefix: str, name_fn=None) -> DataFrame:
    """A04 as a pivot with an explicit value list (stable schema)."""
    names = [name_fn(v) if name_fn else v for v in values]
    return df.groupBy(*keys).agg(*crosstab_exprs(F.col(col), values, names, prefix))


def coverage(df: DataFrame, by: str | Sequence[str], flags: Mapping[str, str],
             digits: int = 3) -> DataFrame:
    """Share of non-missing values per period, rounded half-even."""
    by = [by] if isinstance(by, str) else list(by)
    return (df.groupBy(*by)
              .agg(*[round_half_even(F.avg(F.col(c).isNotNull().cast("double")), digits)
                     .alias(name) for name, c in flags.items()]))


def baseline_mean(series: DataFrame, keys: Sequence[str], period: str, value: str,
                  lo: int, hi: int, alias: str) -> DataFrame:
    """Mean of ``value`` over periods in [lo, hi] per key."""
    return (series.where(F.col(period).between(lo, hi))
                  .groupBy(*keys).agg(F.avg(value).alias(alias)))


def value_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(k, value, n): how often each value (as text, null included) occurs in column
    number ``k``.  One partial aggregate for all columns, so a frequent value is folded
    in each task; counts, distinct counts and modes follow from it."""
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        v = F.col(f"`{c}`")
        if kinds[c] in ("double", "float"):
            v = v + F.lit(0.0).cast(kinds[c])  # 0.0 and -0.0 are one value
        return F.hex(v) if kinds[c] == "binary" else v.cast("string")

    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), text(c).alias("value")) for k, c in enumerate(cols)]))
    return df.select(each.alias("_s")).select("_s.k", "_s.value").groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None,
                    approx_distinct: bool = False) -> DataFrame:
    """Per column — missing count, missing %, type, distinct count, from one
    value table of all columns; ``approx_distinct=True`` takes HyperLogLog++ instead,
    for very wide tables.  A table without rows gives zeros."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    if approx_distinct:
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[x for i, c in enumerate(cols) for x in (
            F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing{i}"), F.approx_count_distinct(F.col(f"`{c}`")).alias(f"n_distinct{i}"))])
        found = row.select("_n", F.inline(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"missing{i}").alias("missing"),
                                                             F.col(f"n_distinct{i}").alias("n_distinct")) for i in range(len(cols))])))
    else:
        found = value_table(df, cols).groupBy("k").agg(
            F.sum("n").alias("_n"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(i, c, types[c]) for i, c in enumerate(cols)], "k int, feature string, dtype string")
    zero = F.lit(0).cast("long")
    return names.join(F.broadcast(found), "k", "left").select(  # a row per column
        "feature", "dtype", F.coalesce("missing", zero).alias("missing"),
        (F.col("missing") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("missing_pct"),
        F.coalesce("n_distinct", zero).alias("n_distinct"))


def count_any_missing(cols: Sequence[str]) -> Column:
    """Rows with any of ``cols`` missing."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return F.count_if(cond)


def count_all_missing(cols: Sequence[str]) -> Column:
    """Rows with every one of ``cols`` missing."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return F.count_if(cond)


def group_counts(df: DataFrame, by: str | Sequence[str], cols: Sequence[str] | None = None
                 ) -> DataFrame:
    """Non-missing count of every column per group (missing keys dropped)."""
    by = [by] if isinstance(by, str) else list(by)
    cols = [c for c in (cols or df.columns) if c not in by]
    keep = F.lit(True)
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return df.where(keep).groupBy(*by).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str, with_share: bool = True) -> DataFrame:
    """A10: frequency table with the share of all non-missing rows.

    The total is a scalar subquery over the aggregated counts (one row,
    evaluated once), so no single-partition window or cross join is needed.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if not with_share:
        return counts
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows beyond the first per key, and keys affected."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
                 F.count_if(F.col("_n") > 1).alias("duplicated_keys"))


SUMMARY_STATS = ["count", "missing", "mean", "std", "min", "p25", "p50", "p75", "max"]


def _stacked(row: DataFrame, cols: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row of columns named statistic and number → one row per column."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{s}{i}").alias(s) for s in stats]) for i, c in enumerate(cols)])))


def _with_quantiles(stacked: DataFrame, df: DataFrame, cols: Sequence[str], names: dict[str, float]) -> DataFrame:
    """``stacked`` with exact quantiles, one row per column on both sides."""
    q = quantiles(df, cols, list(names.values()))
    q = q.select(F.col("column").alias("feature"), *[F.col("q")[k].alias(n) for k, n in enumerate(names)])
    return stacked.join(F.broadcast(q), "feature", "left")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14 + R03: pandas-style ``describe`` (exact quartiles) plus missing,
    transposed to one row per column."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        aggs += [F.count(v).cast("double").alias(f"count{i}"),
                 F.count_if(v.isNull()).cast("double").alias(f"missing{i}"),
                 F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                 F.min(v).cast("double").alias(f"min{i}"), F.max(v).cast("double").alias(f"max{i}")]
    base = _stacked(df.agg(*aggs), cols, ["count", "missing", "mean", "std", "min", "max"])
    return _with_quantiles(base, df, cols, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).select("feature", *SUMMARY_STATS)


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Range, sample variance and inter-quartile range per column."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        aggs += [(F.max(v) - F.min(v)).cast("double").alias(f"value_range{i}"), F.var_samp(v).alias(f"variance{i}")]
    base = _stacked(df.agg(*aggs), cols, ["value_range", "variance"])
    return _with_quantiles(base, df, cols, {"_q1": 0.25, "_q3": 0.75}).select(
        "feature", "value_range", "variance", (F.col("_q3") - F.col("_q1")).alias("iqr"))


def column_totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column sums, one row per column."""
    row = df.agg(*[F.sum(F.col(c)).cast("double").alias(f"t{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"t{i}").alias("total"))
        for i, c in enumerate(cols)])))


def group_means(df: DataFrame, by: str | Sequence[str], cols: Sequence[str],
                prefix: str = "avg_") -> DataFrame:
    """Means per period or region (missing keys dropped)."""
    by = [by] if isinstance(by, str) else list(by)
    keep = F.lit(True)
    for b in by:
        keep = keep & F.col(b).isNotNull()
    return df.where(keep).groupBy(*by).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])


def error_by(df: DataFrame, by: str | Sequence[str], residual: str = "residual",
             extra_means: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and row count per group plus means of extra columns."""
    by = [by] if isinstance(by, str) else list(by)
    r = F.col(residual)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        *[F.avg(c).alias(f"mean_{c}") for c in extra_means])


def mode(col: str) -> Column:
    """Most frequent value, ties broken by the smallest value."""
    return F.mode(F.col(col), deterministic=True)


def overview(df: DataFrame, key: str, period: str, region: str,
             coverage_col: str | None = None) -> DataFrame:
    """One-row panel overview."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.count_distinct(key).alias("entities"),
            F.min(period).alias("first_period"), F.max(period).alias("last_period"),
            F.count_distinct(region).alias("regions")]
    if coverage_col:
        aggs.append((F.avg(F.col(coverage_col).isNotNull().cast("double")) * 100)
                    .alias("coverage_pct"))
    return df.agg(*aggs)


def cluster_profile(df: DataFrame, label: str, spec: Mapping[str, tuple[str, str]],
                    count_col: str = "entities") -> DataFrame:
    """Per-cluster count and aggregates ``{alias: (func, col)}``; medians are
    selected by rank."""
    funcs = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    out = df.groupBy(label).agg(F.count(F.lit(1)).alias(count_col),
                                *[funcs[f](c).alias(a) for a, (f, c) in spec.items() if f != "median"])
    medians = sorted({c for f, c in spec.values() if f == "median"})
    if medians:
        found = wide(quantiles(df, medians, [0.5], by=[label]), medians, [label], prefix="_m_").withColumnRenamed(label, "_l")
        out = out.join(found, F.col(label).eqNullSafe(F.col("_l")), "left")
    return out.select(label, count_col, *[(F.col(f"_m_{c}") if f == "median" else F.col(a)).alias(a)
                                          for a, (f, c) in spec.items()])
