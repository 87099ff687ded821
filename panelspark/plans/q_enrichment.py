"""Registered enrichment queries (path A)."""

from __future__ import annotations

from panelspark.plans import enrichment as en
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import rnd, with_views

_DAILY_DOUBLES = ["daily_aqi_mean", "daily_aqi_std", "daily_aqi_median", "daily_aqi_p90",
                  "daily_aqi_max", "daily_aqi_reporting_sites_mean",
                  "daily_aqi_monthly_mean_std", "daily_aqi_monthly_mean_max"]

DAILY_FEATURES_SQL = """
SELECT s.geoid, s.year,
  s.daily_aqi_observed_days, s.daily_aqi_mean, coalesce(s.daily_aqi_std, 0) AS daily_aqi_std,
  coalesce(s.daily_aqi_median, 0) AS daily_aqi_median, coalesce(s.daily_aqi_p90, 0) AS daily_aqi_p90,
  coalesce(s.daily_aqi_max, 0) AS daily_aqi_max,
  s.daily_aqi_days_over_100, s.daily_aqi_days_over_150, s.daily_aqi_days_over_200,
  s.daily_aqi_unhealthy_or_worse_days, s.daily_aqi_reporting_sites_mean,
  s.daily_aqi_defining_param_days_co, s.daily_aqi_defining_param_days_no2,
  s.daily_aqi_defining_param_days_ozone, s.daily_aqi_defining_param_days_pm10,
  s.daily_aqi_defining_param_days_pm25, s.daily_aqi_defining_param_days_nan,
  s.daily_aqi_category_days_good, s.daily_aqi_category_days_moderate,
  s.daily_aqi_category_days_unhealthy_for_sensitive_groups,
  s.daily_aqi_category_days_unhealthy, s.daily_aqi_category_days_very_unhealthy,
  s.daily_aqi_category_days_hazardous,
  coalesce(m.daily_aqi_monthly_mean_std, 0) AS daily_aqi_monthly_mean_std,
  coalesce(m.daily_aqi_monthly_mean_max, 0) AS daily_aqi_monthly_mean_max,
  coalesce(m.daily_aqi_months_observed, 0) AS daily_aqi_months_observed
FROM (
  SELECT geoid, year,
    count(aqi) AS daily_aqi_observed_days, coalesce(avg(aqi), 0) AS daily_aqi_mean,
    stddev_samp(aqi) AS daily_aqi_std, median(aqi) AS daily_aqi_median,
    quantile_cont(aqi, 0.9) AS daily_aqi_p90, max(aqi) AS daily_aqi_max,
    CNTIF(coalesce(aqi > 100, false)) AS daily_aqi_days_over_100,
    CNTIF(coalesce(aqi > 150, false)) AS daily_aqi_days_over_150,
    CNTIF(coalesce(aqi > 200, false)) AS daily_aqi_days_over_200,
    CNTIF(coalesce(category IN ('Unhealthy for Sensitive Groups', 'Unhealthy',
                                   'Very Unhealthy', 'Hazardous'), false))
      AS daily_aqi_unhealthy_or_worse_days,
    coalesce(avg(sites), 0) AS daily_aqi_reporting_sites_mean,
    CNTIF(p = 'co') AS daily_aqi_defining_param_days_co,
    CNTIF(p = 'no2') AS daily_aqi_defining_param_days_no2,
    CNTIF(p = 'ozone') AS daily_aqi_defining_param_days_ozone,
    CNTIF(p = 'pm10') AS daily_aqi_defining_param_days_pm10,
    CNTIF(p = 'pm25') AS daily_aqi_defining_param_days_pm25,
    CNTIF(p = 'nan') AS daily_aqi_defining_param_days_nan,
    CNTIF(category = 'Hazardous') AS daily_aqi_category_days_hazardous,
    CNTIF(category = 'Good') AS daily_aqi_category_days_good,
    CNTIF(category = 'Moderate') AS daily_aqi_category_days_moderate,
    CNTIF(category = 'Unhealthy for Sensitive Groups')
      AS daily_aqi_category_days_unhealthy_for_sensitive_groups,
    CNTIF(category = 'Unhealthy') AS daily_aqi_category_days_unhealthy,
    CNTIF(category = 'Very Unhealthy') AS daily_aqi_category_days_very_unhealthy
  FROM (SELECT *, coalesce(replace(replace(lower(defining_param), '.', ''), ' ', '_'), 'nan') AS p
        FROM daily)
  GROUP BY geoid, year) s
LEFT JOIN (
  SELECT geoid, year, stddev_samp(mm) AS daily_aqi_monthly_mean_std,
         max(mm) AS daily_aqi_monthly_mean_max, count(mm) AS daily_aqi_months_observed
  FROM (SELECT geoid, year, month, avg(aqi) AS mm FROM daily GROUP BY 1, 2, 3)
  GROUP BY 1, 2) m
ON s.geoid = m.geoid AND s.year = m.year"""


@register("daily_exposure_features", with_views(
    f"SELECT * REPLACE ({rnd(*_DAILY_DOUBLES)}) FROM ({DAILY_FEATURES_SQL})", ["daily"]))
def q_daily_exposure_features(spark, sf_dir):
    """P01 P02 P06 P08 P15 P16 A01 A02 A03 A04 J02 P23 on the daily stand-in."""
    return en.daily_exposure_features(fx.daily_raw(spark, sf_dir))


from panelspark.functions.text import slug  # noqa: E402
from panelspark.operators import aggregates as ag  # noqa: E402
from panelspark.operators.joins import join_clipped_period, outer_merge  # noqa: E402
from panelspark.plans.fixture_sql import cnt, finalize, zf  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

_MONTHLY_SQL = """
SELECT geoid, year, stddev_samp(mm) AS daily_aqi_monthly_mean_std,
       max(mm) AS daily_aqi_monthly_mean_max, count(mm) AS daily_aqi_months_observed
FROM (SELECT geoid, year, month, avg(aqi) AS mm FROM daily GROUP BY 1, 2, 3)
GROUP BY 1, 2"""


@register("monthly_profile", with_views(finalize(_MONTHLY_SQL, ["geoid"]), ["daily"]))
def q_monthly_profile(spark, sf_dir):
    """Two-level aggregate (monthly mean → std / max / count)."""
    d = en.clean_daily(fx.daily_raw(spark, sf_dir))
    return ag.monthly_profile(d, ["geoid", "year"], "month", "aqi", "daily_aqi_")


@register("param_crosstab", with_views(f"""
SELECT geoid, year, {cnt("p = 'co'")} AS co, {cnt("p = 'no2'")} AS no2,
       {cnt("p = 'ozone'")} AS ozone, {cnt("p = 'pm10'")} AS pm10, {cnt("p = 'pm25'")} AS pm25
FROM (SELECT geoid, year, replace(lower(defining_param), '.', '') AS p FROM daily)
GROUP BY 1, 2""", ["daily"]))
def q_param_crosstab(spark, sf_dir):
    """A04 (pivot form, explicit value list) on slugged pollutant names."""
    from panelspark.functions.text import param_slug
    d = en.clean_daily(fx.daily_raw(spark, sf_dir)).withColumn("p", param_slug("defining_param"))
    return ag.crosstab_counts(d, ["geoid", "year"], "p", ["co", "no2", "ozone", "pm10", "pm25"], "")


@register("category_crosstab", with_views(f"""
SELECT year, {cnt("category = 'Good'")} AS good, {cnt("category = 'Moderate'")} AS moderate,
       {cnt("category = 'Unhealthy for Sensitive Groups'")} AS unhealthy_for_sensitive_groups,
       {cnt("category = 'Unhealthy'")} AS unhealthy,
       {cnt("category = 'Very Unhealthy'")} AS very_unhealthy,
       {cnt("category = 'Hazardous'")} AS hazardous
FROM daily GROUP BY 1""", ["daily"]))
def q_category_crosstab(spark, sf_dir):
    """A04 with slugged category names; an absent category gives 0."""
    d = en.clean_daily(fx.daily_raw(spark, sf_dir))
    cats = ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
            "Very Unhealthy", "Hazardous"]
    return ag.crosstab_counts(d, ["year"], "category", cats, "",
                              name_fn=lambda c: c.lower().replace(" ", "_").replace("/", "_"))


def _share_features(spark, sf_dir):
    ind = en.industry_shares(fx.industry_source(spark, sf_dir),
                             [f"band_{i}" for i in range(1, 6)], "employed_total")
    edu = en.education_shares(fx.education_source(spark, sf_dir), "education_total",
                              ["level_1", "level_2"], ["level_3", "level_4", "level_5"],
                              ["level_5"])
    hea = en.health_shares(fx.health_source(spark, sf_dir), "civilian_total",
                           ["uninsured_a", "uninsured_r"])
    return outer_merge([ind, edu, hea], "geoid")


_SHARES_SQL = """
SELECT * FROM
 (SELECT geoid, employed_total,
         band_1 / nullif(employed_total, 0) AS pct_band_1,
         band_2 / nullif(employed_total, 0) AS pct_band_2,
         band_3 / nullif(employed_total, 0) AS pct_band_3,
         band_4 / nullif(employed_total, 0) AS pct_band_4,
         band_5 / nullif(employed_total, 0) AS pct_band_5 FROM industry_source) i
 FULL JOIN
 (SELECT geoid, education_total,
         (coalesce(level_1, 0) + coalesce(level_2, 0)) / nullif(education_total, 0) AS pct_less_than_hs,
         (coalesce(level_3, 0) + coalesce(level_4, 0) + coalesce(level_5, 0))
            / nullif(education_total, 0) AS pct_hs_or_higher,
         coalesce(level_5, 0) / nullif(education_total, 0) AS pct_bachelors_or_higher
  FROM education_source) e USING (geoid)
 FULL JOIN
 (SELECT geoid, civilian_total, coalesce(uninsured_a, 0) + coalesce(uninsured_r, 0) AS uninsured_count,
         (coalesce(uninsured_a, 0) + coalesce(uninsured_r, 0)) / nullif(civilian_total, 0) AS pct_uninsured,
         1.0 - (coalesce(uninsured_a, 0) + coalesce(uninsured_r, 0)) / nullif(civilian_total, 0) AS pct_insured
  FROM health_source) h USING (geoid)"""


@register("share_features", with_views(finalize(_SHARES_SQL, ["geoid"]),
                                       ["industry_source", "education_source", "health_source"]))
def q_share_features(spark, sf_dir):
    """P17 P19 P21 + J01: three source tables with different key sets,
    shares with zero-safe denominators, full outer chain on geoid."""
    return _share_features(spark, sf_dir)


_CLIPPED_SQL = """
SELECT k.geoid, k.year, k.source_year, p.source_rows, p.pct_discounted, p.pct_taxed
FROM (SELECT DISTINCT geoid, year, least(greatest(year, 1997), 1999) AS source_year FROM panel) k
LEFT JOIN period_features p ON p.geoid = k.geoid AND p.source_year = k.source_year"""


@register("clipped_period_join", with_views(finalize(_CLIPPED_SQL, ["geoid"]),
                                            ["panel", "period_features"]))
def q_clipped_period_join(spark, sf_dir):
    """Nearest available source year (clip 1997..1999)."""
    return join_clipped_period(fx.panel(spark, sf_dir), fx.period_features(spark, sf_dir),
                               1997, 1999)


def _years(spark, sf_dir):
    """The panel's periods, a handful of values."""
    return sorted(r["year"] for r in fx.panel(spark, sf_dir).select("year").distinct().collect())


_SERIES_SQL = """
SELECT geoid, parameter, TRY_CAST(k AS INTEGER) AS year,
       TRY_CAST(NULLIF(payload::JSON ->> k, 'nan') AS DOUBLE) AS value
FROM (SELECT geoid, parameter, payload, unnest(json_keys(payload::JSON)) AS k
      FROM climate_payloads)"""

_CLIMATE_SQL = f"""
SELECT g.geoid, g.location_id, g.year,
       y.annual_avg_temp_f, y.annual_precip_inches,
       b.temp_baseline_mean, b.precip_baseline_mean,
       y.annual_avg_temp_f - b.temp_baseline_mean AS annual_temp_anomaly_f,
       y.annual_precip_inches - b.precip_baseline_mean AS annual_precip_anomaly_inches
FROM (SELECT e.geoid, CASE WHEN m.label IS NOT NULL THEN m.label || '-' || right(e.geoid, 3) END
               AS location_id, yr.year
      FROM (SELECT DISTINCT geoid FROM climate_payloads) e
      LEFT JOIN code_map m ON m.code = substr(e.geoid, 1, 2)
      CROSS JOIN (SELECT DISTINCT CAST(year AS INTEGER) AS year FROM panel) yr) g
LEFT JOIN (SELECT geoid, year,
                  max(CASE WHEN parameter = 'tavg' THEN value END) AS annual_avg_temp_f,
                  max(CASE WHEN parameter = 'pcp' THEN value END) AS annual_precip_inches
           FROM series WHERE year IN (SELECT year FROM panel) GROUP BY 1, 2) y
  ON y.geoid = g.geoid AND y.year = g.year
LEFT JOIN (SELECT geoid, avg(CASE WHEN parameter = 'tavg' THEN value END) AS temp_baseline_mean,
                  avg(CASE WHEN parameter = 'pcp' THEN value END) AS precip_baseline_mean
           FROM series WHERE year BETWEEN 1995 AND 1998 GROUP BY 1) b
  ON b.geoid = g.geoid"""


def _climate(spark, sf_dir):
    return en.climate_features(fx.climate_payloads(spark, sf_dir), _years(spark, sf_dir), 1995, 1998,
                               code_map=fx.code_map(spark, sf_dir))


@register("climate_anomaly", with_views(finalize(_CLIMATE_SQL, ["geoid", "location_id"]),
                                        ["panel", "climate_payloads", "code_map"],
                                        [("series", _SERIES_SQL)]))
def q_climate_anomaly(spark, sf_dir):
    """JSON series → long rows, baseline mean
    over 1995..1998, yearly value and anomaly on an entity × year grid."""
    return _climate(spark, sf_dir)


@register("series_long", with_views(finalize(_SERIES_SQL, ["geoid", "parameter"]),
                                    ["climate_payloads"]))
def q_series_long(spark, sf_dir):
    """Exploded ``{year: value}`` series."""
    return en.explode_series(fx.climate_payloads(spark, sf_dir), ["geoid", "parameter"])


def _enriched(spark, sf_dir):
    return en.enriched_panel(fx.panel(spark, sf_dir), fx.period_features(spark, sf_dir),
                             en.daily_exposure_features(fx.daily_raw(spark, sf_dir)),
                             _climate(spark, sf_dir), 1997, 1999)


_ENRICHED_SQL = f"""
SELECT b.*, c.source_year, c.source_rows, c.pct_discounted, c.pct_taxed,
       d.* EXCLUDE (geoid, year), cl.* EXCLUDE (geoid, year)
FROM panel b
LEFT JOIN ({_CLIPPED_SQL}) c ON c.geoid = b.geoid AND c.year = b.year
LEFT JOIN ({DAILY_FEATURES_SQL}) d ON d.geoid = b.geoid AND d.year = b.year
LEFT JOIN ({_CLIMATE_SQL}) cl ON cl.geoid = b.geoid AND cl.year = b.year"""

_PANEL_TEXT = ["geoid", "county_name", "state_name", "total_population"]


@register("enriched_panel", with_views(finalize(_ENRICHED_SQL, _PANEL_TEXT + ["location_id"]),
                                       ["panel", "period_features", "daily", "climate_payloads",
                                        "code_map"], [("series", _SERIES_SQL)]))
def q_enriched_panel(spark, sf_dir):
    """J02 chain: panel ⋈ clipped period ⋈ daily features ⋈ climate."""
    return _enriched(spark, sf_dir)


_COVERAGE_SQL = f"""
SELECT year,
       round_even(avg(CASE WHEN pct_discounted IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 3) AS has_period,
       round_even(avg(CASE WHEN daily_aqi_mean IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 3) AS has_daily,
       round_even(avg(CASE WHEN annual_avg_temp_f IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 3) AS has_climate
FROM ({_ENRICHED_SQL}) GROUP BY year"""


@register("coverage_by_year", with_views(_COVERAGE_SQL,
                                         ["panel", "period_features", "daily", "climate_payloads",
                                          "code_map"], [("series", _SERIES_SQL)]))
def q_coverage_by_year(spark, sf_dir):
    """A05 + P34: share of rows with each enrichment, rounded half-even."""
    return ag.coverage(_enriched(spark, sf_dir), "year",
                       {"has_period": "pct_discounted", "has_daily": "daily_aqi_mean",
                        "has_climate": "annual_avg_temp_f"})
