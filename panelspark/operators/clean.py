"""Table-level cleaning operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.numbers import (SENTINEL_FLOOR, nan_to_null, null_infinite_col,
                                          null_sentinel_col)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = (), prefix: str | None = None
                    ) -> list[str]:
    """Numeric columns from the schema (position-free), minus
    ``exclude``; optionally only names starting with ``prefix``."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex
            and (prefix is None or f.name.startswith(prefix))]


def null_sentinels(df: DataFrame, floor: float = SENTINEL_FLOOR,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """P10: every numeric value ≤ floor → NULL, in one projection."""
    targets = set(cols if cols is not None else numeric_columns(df))
    return df.select(*[null_sentinel_col(_q(c), floor).alias(c) if c in targets else _q(c)
                       for c in df.columns])


def null_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN → NULL on floating columns (ingest hygiene)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = set(cols if cols is not None else fl) & fl
    return df.select(*[nan_to_null(_q(c)).alias(c) if c in targets else _q(c)
                       for c in df.columns])


def null_infinite(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """±inf → NULL on floating columns."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = set(cols if cols is not None else fl) & fl
    return df.select(*[null_infinite_col(_q(c)).alias(c) if c in targets else _q(c)
                       for c in df.columns])


def filter_measure(df: DataFrame, value: str, candidates: Sequence[str]) -> DataFrame:
    """Keep rows whose first existing candidate column equals
    ``value`` ignoring case (API exports name the column differently)."""
    for c in candidates:
        if c in df.columns:
            return df.where(F.coalesce(F.upper(_q(c)) == F.lit(value.upper()), F.lit(False)))
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def filter_all(df: DataFrame, preds: Sequence[Column]) -> DataFrame:
    """Conjunction of predicates; a NULL predicate drops the row."""
    cond = F.lit(True)
    for p in preds:
        cond = cond & F.coalesce(p, F.lit(False))
    return df.where(cond)


def filter_in(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    """Keep (or drop) a value set; pandas keeps missing rows on ``!=``."""
    m = _q(col).isin(list(values))
    return df.where(F.coalesce(~m, F.lit(True)) if negate else F.coalesce(m, F.lit(False)))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows missing any of ``cols``."""
    return df.dropna(subset=list(cols))


def fill(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill missing values with a constant (type-matched columns)."""
    return df.fillna(value, subset=list(cols) if cols else None)


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename in one projection (pruning reaches the scan)."""
    return df.select(*[_q(src).alias(dst) for src, dst in mapping.items()])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case headers, non-alphanumerics → '_'."""
    import re
    return df.toDF(*[re.sub(r"[^0-9a-z]+", "_", c.lower()).strip("_") for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = True) -> DataFrame:
    """Cast columns; ``lenient`` uses ``try_cast`` (bad → NULL)."""
    return df.select(*[(_q(c).try_cast(types[c]) if lenient else _q(c).cast(types[c])).alias(c)
                       if c in types else _q(c) for c in df.columns])


def map_codes(df: DataFrame, col: str, mapping: DataFrame, code: str = "code",
              label: str = "label", out: str | None = None) -> DataFrame:
    """Code → label via a left join to a mapping table (unmapped → NULL).

    The mapping is a dimension table (one row per code); AQE broadcasts it
    when its measured size is under the broadcast threshold and falls back
    to a shuffle join otherwise, so no unchecked broadcast is forced.
    """
    m = mapping.select(F.col(code).alias("_code"), F.col(label).alias(out or label))
    return df.join(m, _q(col) == F.col("_code"), "left").drop("_code")
