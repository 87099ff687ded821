"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name, same columns."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_loose(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key combinations (partial aggregate before shuffle)."""
    return df.select(*keys).distinct()


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable",
         value: str = "value") -> DataFrame:
    """Wide → long (``unpivot``; row-local, no shuffle)."""
    return df.unpivot(list(ids), list(cols), var, value)


def widen(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str,
          values: Sequence[str], prefix: str = "") -> DataFrame:
    """Long → wide with an explicit pivot value list (stable schema,
    no extra job to discover the values)."""
    return (df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.first(value))
              .select(*keys, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values]))
