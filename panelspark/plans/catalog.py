"""Query catalog: every registered query is (Spark builder, DuckDB oracle).

Each Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole fixture tables; the oracle is the same computation in SQL over
the same tables.  Double outputs are rounded to 6 digits on both sides
(summation order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.plans import fixtures as fx
from panelspark.plans.fixture_sql import rnd, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


from panelspark.plans import q_enrichment, q_clean, q_audit, q_windows, q_model, q_geo, q_charts, q_ml, q_cluster, q_sources, q_cover  # noqa: E402,F401  (registers queries)
