"""Text expressions: label cleaning, parameter parsing, WKT points and
display formatting (P29-P31, P35, P36)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def slug(col: str | Column) -> Column:
    """lower-case, spaces and '/' → '_' (category column names)."""
    return F.regexp_replace(F.lower(_c(col)), "[ /]", "_")


def slugs(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """``slug`` of each of a few names (schema-sized metadata)."""
    rows = spark.createDataFrame(list(enumerate(names)), "k int, name string")
    return [r["s"] for r in rows.select("k", slug("name").alias("s")).orderBy("k").collect()]


def param_slug(col: str | Column) -> Column:
    """lower-case, drop '.', spaces → '_' (pollutant names: PM2.5 → pm25)."""
    return F.regexp_replace(F.replace(F.lower(_c(col)), F.lit("."), F.lit("")), " ", "_")


def clean_label(col: str | Column, prefix: str = "") -> Column:
    """Strip a prefix, '_' → ' ', title case ('avg_median_aqi' → 'Median Aqi')."""
    c = _c(col)
    if prefix:
        c = F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def parse_param(col: str | Column, name: str, as_type: str = "double") -> Column:
    """Typed value of ``name=value`` inside a parameter string."""
    raw = F.regexp_extract(_c(col), rf"(?:^|[\s,]){name}\s*=\s*([^,\s]+)", 1)
    return F.nullif(raw, F.lit("")).try_cast(as_type)


def parse_point(col: str | Column) -> tuple[Column, Column]:
    """WKT ``POINT (lon lat)`` → (lon, lat) doubles; bad text → NULL."""
    num = r"(-?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)"
    pattern = rf"^\s*POINT\s*\(\s*{num}\s+{num}\s*\)\s*$"
    c = _c(col)
    lon = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("double")
    lat = F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).try_cast("double")
    return lon, lat


def fmt_num(col: str | Column, digits: int = 2, missing: str = "--") -> Column:
    """Thousands-grouped number text, ``--`` for missing."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(missing)).otherwise(F.format_number(c, digits))


def fmt_pct(col: str | Column, digits: int = 1, missing: str = "--") -> Column:
    """Share → percent text (0.314 → '31.4%'), ``--`` for missing."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(missing)).otherwise(
        F.concat(F.format_number(c * 100, digits), F.lit("%")))


def direction(col: str | Column, above: str = "above average",
              below: str = "below average") -> Column:
    c = _c(col)
    return F.when(c > 0, F.lit(above)).when(c.isNotNull(), F.lit(below))
