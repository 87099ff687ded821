"""Window and ordering operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage


def lead_target(df: DataFrame, key: str, order: str, cols: dict[str, str]) -> DataFrame:
    """Value of the next period within the entity.

    The window partitions by entity; each entity has one row per period, so
    a partition holds a handful of rows however large the panel grows."""
    w = Window.partitionBy(key).orderBy(order)
    return df.select("*", *[F.lead(src, 1).over(w).alias(dst) for src, dst in cols.items()])


def consecutive_only(df: DataFrame, period: str = "year", next_period: str = "next_year"
                     ) -> DataFrame:
    """Keep rows whose next period is exactly period + 1."""
    return df.where(F.col(next_period) == F.col(period) + 1)


def _sort_cols(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]],
                    n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  ``order`` must end with a total
    tie-breaker for a deterministic result.  Spark plans this as a
    group-limit (window group limit pushdown), so each partition keeps at
    most ``n`` rows per group before the window sort."""
    w = Window.partitionBy(*by).orderBy(*_sort_cols(order))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]
                  ) -> DataFrame:
    """Keep the first row per key under ``order``."""
    return top_n_per_group(df, keys, order, 1)


def zscore_within(df: DataFrame, by: Sequence[str] | None, col: str, out: str | None = None
                  ) -> DataFrame:
    """(x − mean) / population std within a group, 0 when std is 0.

    Group statistics come from a grouped aggregate joined back on the key
    (partial aggregation, no whole-group buffering); with ``by=None`` they
    come from a scalar subquery over the table."""
    out = out or f"{col}_z"
    if not by:
        stats = df.agg(F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s"))
        m, s = stats.select("_m").scalar(), stats.select("_s").scalar()
        return df.withColumn(out, F.coalesce((F.col(col) - m) / F.nullif(s, F.lit(0.0)),
                                             F.when(F.col(col).isNotNull(), F.lit(0.0))))
    stats = df.groupBy(*by).agg(F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s"))
    j = df.join(stats, list(by), "left")
    z = F.coalesce((F.col(col) - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)),
                   F.when(F.col(col).isNotNull(), F.lit(0.0)))
    return j.withColumn(out, z).drop("_m", "_s")


def sort(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Multi-key sort, mixed directions, missing last (pandas)."""
    return df.orderBy(*_sort_cols(order))


def top_k(df: DataFrame, order: Sequence[tuple[str, bool]], k: int) -> DataFrame:
    """First ``k`` rows under ``order`` (TakeOrderedAndProject:
    each task keeps its own top k, the driver merges k × tasks rows)."""
    return df.orderBy(*_sort_cols(order)).limit(k)


def best_row(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Arg-min / arg-max by a tuple of criteria."""
    return top_k(df, order, 1)


def sort_abs(df: DataFrame, col: str, descending: bool = True) -> DataFrame:
    """Order by absolute value."""
    a = F.abs(F.col(col))
    return df.orderBy(a.desc_nulls_last() if descending else a.asc_nulls_last())


def preview(df: DataFrame, order: Sequence[tuple[str, bool]], n: int, tail: bool = False
            ) -> DataFrame:
    """First or last ``n`` rows after an order (tail = reversed order)."""
    if tail:
        order = [(c, not asc) for c, asc in order]
    return top_k(df, order, n)


def ordinal(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with its rows' positions in ``order``, from 0, without a window over all
    rows: sorted by range, then each partition's start is the number of rows before it
    (one row per partition)."""
    df = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = df.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    start = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"))
    return df.withColumn("_p", part).join(F.broadcast(start), "_p").withColumn(
        out, F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_p", "_start")
