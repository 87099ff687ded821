"""Join operators.

Strategy is left to Catalyst + AQE: a side whose runtime size is under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, otherwise both sides
are shuffled on the key and sort-merge joined; skewed partitions are split
by AQE's skew-join handling.  Nothing here forces a broadcast of a side
whose size grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numbers import clip


def outer_merge(dfs: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Full outer join chain; the USING form coalesces the key."""
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda a, b: a.join(b, on, "full"), dfs)


def enrich(base: DataFrame, features: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left join chain onto the (entity, period) spine."""
    return reduce(lambda a, b: a.join(b, list(on), "left"), features, base)


def join_clipped_period(keys: DataFrame, feats: DataFrame, lo: int, hi: int,
                        key: str = "geoid", period: str = "year",
                        source_period: str = "source_year") -> DataFrame:
    """Each (key, period) takes the features of the nearest available
    period (period clipped into [lo, hi]); the source period is kept."""
    spine = (keys.select(key, period).distinct()
                 .withColumn(source_period, clip(period, lo, hi)))
    return spine.join(feats, [key, source_period], "left")


def join_on_pairs(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]],
                  null_safe: bool = False, how: str = "left") -> DataFrame:
    """Join with different key names, right keys dropped.  With
    ``null_safe`` missing matches missing (pandas merge semantics)."""
    cond = None
    for lcol, rcol in pairs:
        c = df[lcol].eqNullSafe(other[rcol]) if null_safe else df[lcol] == other[rcol]
        cond = c if cond is None else cond & c
    out = df.join(other, cond, how)
    for _, rcol in pairs:
        out = out.drop(other[rcol])
    return out


def attach_predictions(entities: DataFrame, preds: DataFrame, key: str,
                       value: str = "prediction", status: str = "status",
                       missing_label: str = "No prediction") -> DataFrame:
    """All entities kept; unmatched marked with ``missing_label``."""
    out = entities.join(preds, key, "left")
    return out.withColumn(status, F.when(F.col(value).isNull(), F.lit(missing_label))
                                   .otherwise(F.lit("Predicted")))


def grid(entities: DataFrame, periods: Sequence[int], period: str = "year") -> DataFrame:
    """Entity × period grid.

    The period list is a driver-side parameter (a handful of years), so it
    is expanded per row with ``explode`` — no join, no shuffle.
    """
    return entities.withColumn(period, F.explode(F.array(*[F.lit(p) for p in periods])))
