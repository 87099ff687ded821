"""Registered audit / EDA aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import clean as C
from panelspark.operators import windows as W
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import cnt, finalize, with_views

PANEL_TYPES = [("geoid", "string"), ("county_name", "string"), ("state_name", "string"),
               ("year", "int"), ("outcome", "double"), ("lower_ci", "double"),
               ("upper_ci", "double"), ("total_population", "string"),
               ("population", "bigint"), ("median_income", "double"),
               ("poverty_count", "double"), ("unemployed_count", "double"),
               ("aqi_median", "double"), ("aqi_max", "double")]
NUMERIC = ["outcome", "population", "median_income", "aqi_median", "aqi_max"]


def clean_panel(spark, sf_dir):
    """Panel with sentinels nulled (always the first step, quirk Q5)."""
    return C.null_sentinels(fx.panel(spark, sf_dir))


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{t}' AS dtype, {cnt(f'{c} IS NULL')} AS missing, "
    f"{cnt(f'{c} IS NULL')} * 100.0 / nullif(count(*), 0) AS missing_pct, "
    f"count(DISTINCT {c}) AS n_distinct FROM panel" for c, t in PANEL_TYPES)


@register("column_profile", with_views(finalize(_PROFILE_SQL, ["feature", "dtype"]), ["panel"]))
def q_column_profile(spark, sf_dir):
    """Missing count / share, type and distinct count per column."""
    return ag.profile_columns(fx.panel(spark, sf_dir))


def _clean_panel_sql():
    return ("SELECT * REPLACE (CASE WHEN median_income > -1e8 THEN median_income END "
            "AS median_income) FROM panel")


_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count({c}) AS DOUBLE) AS count, "
    f"CAST({cnt(f'{c} IS NULL')} AS DOUBLE) AS missing, avg({c}) AS mean, "
    f"stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM cpanel"
    for c in NUMERIC)


@register("describe", with_views(finalize(_DESCRIBE_SQL, ["feature"]), ["panel"],
                                 [("cpanel", _clean_panel_sql())]))
def q_describe(spark, sf_dir):
    """A14 + R03: count, missing, mean, std, min, exact quartiles, max per
    column, transposed."""
    return ag.describe(clean_panel(spark, sf_dir), NUMERIC)


_SPREAD_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(max({c}) - min({c}) AS DOUBLE) AS value_range, "
    f"var_samp({c}) AS variance, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr "
    f"FROM cpanel" for c in NUMERIC)


@register("spread", with_views(finalize(_SPREAD_SQL, ["feature"]), ["panel"],
                               [("cpanel", _clean_panel_sql())]))
def q_spread(spark, sf_dir):
    """Range, variance and IQR."""
    return ag.spread(clean_panel(spark, sf_dir), NUMERIC)


_TOTALS = ["population", "poverty_count", "unemployed_count"]
_TOTALS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(sum({c}) AS DOUBLE) AS total FROM panel" for c in _TOTALS)


@register("column_totals", with_views(finalize(_TOTALS_SQL, ["feature"]), ["panel"]))
def q_column_totals(spark, sf_dir):
    """Column totals side by side."""
    return ag.column_totals(fx.panel(spark, sf_dir), _TOTALS)


_OVERVIEW_SQL = f"""
SELECT count(*) AS rows, {len(PANEL_TYPES)} AS columns, count(DISTINCT geoid) AS entities,
       min(year) AS first_period, max(year) AS last_period,
       count(DISTINCT state_name) AS regions,
       avg(CASE WHEN outcome IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE * 100 AS coverage_pct
FROM panel"""


@register("overview", with_views(finalize(_OVERVIEW_SQL), ["panel"]))
def q_overview(spark, sf_dir):
    """Panel overview row."""
    return ag.overview(fx.panel(spark, sf_dir), "geoid", "year", "state_name", "outcome")


_DUP_SQL = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows,
       CNTIF(n > 1) AS duplicated_keys
FROM (SELECT state_name, year, count(*) AS n FROM panel GROUP BY 1, 2)"""


@register("duplicates", with_views(_DUP_SQL, ["panel"]))
def q_duplicates(spark, sf_dir):
    """Rows beyond the first per (region, year)."""
    return ag.count_duplicates(fx.panel(spark, sf_dir), ["state_name", "year"])


_SHARES_SQL = """
SELECT state_name, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM panel WHERE state_name IS NOT NULL GROUP BY 1"""


@register("value_shares", with_views(finalize(_SHARES_SQL, ["state_name"]), ["panel"]))
def q_value_shares(spark, sf_dir):
    """A10: frequency table with shares."""
    return ag.value_counts(fx.panel(spark, sf_dir), "state_name")


_GROUP_COUNTS_SQL = "SELECT year, " + ", ".join(
    f"count({c}) AS {c}" for c, _ in PANEL_TYPES if c != "year") + \
    " FROM panel WHERE year IS NOT NULL GROUP BY year"


@register("group_counts", with_views(_GROUP_COUNTS_SQL, ["panel"]))
def q_group_counts(spark, sf_dir):
    """Non-missing count of every column per year."""
    return ag.group_counts(fx.panel(spark, sf_dir), "year")


_MISSING_SQL = """
SELECT year, CNTIF(aqi_median IS NULL OR aqi_max IS NULL) AS any_missing,
       CNTIF(aqi_median IS NULL AND aqi_max IS NULL) AS all_missing, count(*) AS n
FROM panel GROUP BY year"""


@register("missing_counts", with_views(_MISSING_SQL, ["panel"]))
def q_missing_counts(spark, sf_dir):
    """Rows with any / all of a column set missing."""
    cols = ["aqi_median", "aqi_max"]
    return fx.panel(spark, sf_dir).groupBy("year").agg(
        ag.count_any_missing(cols).alias("any_missing"),
        ag.count_all_missing(cols).alias("all_missing"),
        F.count(F.lit(1)).alias("n"))


_DISTINCT_SQL = """
SELECT state_name, count(DISTINCT geoid) AS entities,
       (SELECT count(DISTINCT state_name) FROM panel) AS n_regions
FROM panel GROUP BY 1"""


@register("distinct_values", with_views(_DISTINCT_SQL, ["panel"]))
def q_distinct_values(spark, sf_dir):
    """Distinct regions, distinct entities per region, distinct count."""
    p = fx.panel(spark, sf_dir)
    n = p.agg(F.count_distinct("state_name").alias("n")).scalar()
    return (p.groupBy("state_name").agg(F.count_distinct("geoid").alias("entities"))
             .withColumn("n_regions", n))


_TREND_COLS = ["outcome", "aqi_median", "aqi_max", "median_income"]
_TREND_SQL = "SELECT year, " + ", ".join(f"avg({c}) AS avg_{c}" for c in _TREND_COLS) + \
    " FROM cpanel WHERE year IS NOT NULL GROUP BY year"


@register("trend_by_year", with_views(finalize(_TREND_SQL), ["panel"],
                                      [("cpanel", _clean_panel_sql())]))
def q_trend_by_year(spark, sf_dir):
    """Period means."""
    return ag.group_means(clean_panel(spark, sf_dir), "year", _TREND_COLS)


_TOP_REGIONS_SQL = """
SELECT state_name, avg(outcome) AS avg_outcome, avg(aqi_median) AS avg_aqi_median
FROM panel WHERE state_name IS NOT NULL GROUP BY 1
ORDER BY avg_outcome DESC NULLS LAST, state_name LIMIT 5"""


@register("top_regions", with_views(finalize(_TOP_REGIONS_SQL, ["state_name"]), ["panel"]))
def q_top_regions(spark, sf_dir):
    """A18 + O02: region means, top 5 by outcome."""
    g = ag.group_means(fx.panel(spark, sf_dir), "state_name", ["outcome", "aqi_median"])
    return W.top_k(g, [("avg_outcome", False), ("state_name", True)], 5)


_EXTREMES_SQL = """
SELECT * FROM (SELECT geoid, year, outcome, 'top' AS side FROM panel
               ORDER BY outcome DESC NULLS LAST, geoid, year LIMIT 10)
UNION ALL
SELECT * FROM (SELECT geoid, year, outcome, 'bottom' AS side FROM panel
               ORDER BY outcome ASC NULLS LAST, geoid, year LIMIT 10)"""


@register("extremes", with_views(finalize(_EXTREMES_SQL, ["geoid", "side"]), ["panel"]))
def q_extremes(spark, sf_dir):
    """Top-10 and bottom-10 rows with a total tie-breaker."""
    p = fx.panel(spark, sf_dir).select("geoid", "year", "outcome")
    top = W.top_k(p, [("outcome", False), ("geoid", True), ("year", True)], 10)
    bottom = W.preview(p, [("outcome", False), ("geoid", False), ("year", False)], 10, tail=True)
    return (top.withColumn("side", F.lit("top"))
               .unionByName(bottom.withColumn("side", F.lit("bottom"))))


_MODE_SQL = """
SELECT state_name, year AS mode_year FROM (
  SELECT state_name, year, row_number() OVER (PARTITION BY state_name ORDER BY n DESC, year) AS rn
  FROM (SELECT state_name, year, count(*) AS n FROM panel GROUP BY 1, 2))
WHERE rn = 1"""


@register("mode_by_region", with_views(_MODE_SQL, ["panel"]))
def q_mode_by_region(spark, sf_dir):
    """Most frequent year per region (ties → smallest)."""
    return fx.panel(spark, sf_dir).groupBy("state_name").agg(ag.mode("year").alias("mode_year"))


_SIZES_SQL = "SELECT state_name, year, count(*) AS n FROM panel GROUP BY 1, 2"


@register("pair_sizes", with_views(_SIZES_SQL, ["panel"]))
def q_pair_sizes(spark, sf_dir):
    """Group sizes by key pair."""
    return ag.group_size(fx.panel(spark, sf_dir), ["state_name", "year"])
