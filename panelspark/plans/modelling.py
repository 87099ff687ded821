"""Modelling compositions (path B): the supervised next-period frame,
baseline evaluation and failure analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numbers import parse_grouped_number
from panelspark.functions.rules import case_ladder
from panelspark.operators.clean import null_sentinels, numeric_columns
from panelspark.operators.features import temporal_split
from panelspark.operators.windows import consecutive_only, lead_target

# Columns never used as model features (targets, intervals,
# period bookkeeping).
EXCLUDE = ["outcome", "lower_ci", "upper_ci", "next_outcome", "next_year", "source_year", "year"]


def supervised_frame(panel: DataFrame, key: str = "geoid", period: str = "year",
                     outcome: str = "outcome") -> DataFrame:
    """Sentinels → NULL, next-period target within the entity, only truly
    consecutive pairs, thousands-grouped population parsed."""
    df = null_sentinels(panel)
    df = lead_target(df, key, period, {period: "next_year", outcome: "next_outcome"})
    df = consecutive_only(df, period, "next_year")
    if "total_population" in df.columns:
        df = df.withColumn("total_population_numeric", parse_grouped_number("total_population"))
    return df


def feature_list(df: DataFrame, exclude: Sequence[str] = EXCLUDE) -> list[str]:
    """Numeric columns minus the exclusions (schema walk)."""
    return numeric_columns(df, exclude)


def split(sup: DataFrame, period: str = "year", target: str = "next_outcome"
          ) -> tuple[DataFrame, DataFrame]:
    """M01 on rows that have a target."""
    return temporal_split(sup.where(F.col(target).isNotNull()), period)


def residuals(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """residual = actual − prediction, and its absolute value."""
    return (df.withColumn("residual", F.col(y) - F.col(yhat))
              .withColumn("abs_residual", F.abs(F.col("residual"))))


def failure_examples(preds: DataFrame, rules: Sequence[tuple[Column, str]],
                     default: str = "Large residual outlier", n: int = 12,
                     tie: Sequence[str] = ("geoid", "year")) -> DataFrame:
    """The ``n`` largest absolute residuals with a first-match
    category (P24).  A top-k report: ``limit`` is the feature here."""
    top = preds.orderBy(F.col("abs_residual").desc_nulls_last(), *tie).limit(n)
    return top.withColumn("failure_category", case_ladder(rules, default))
