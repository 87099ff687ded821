"""Registered geographic queries: centroid attachment (J04) and kNN
imputation (J08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import text as X
from panelspark.operators.joins import join_on_pairs
from panelspark.operators.knn import knn_impute
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views
from panelspark.plans.q_clean import _POINTS_SQL

KNN_COLS = ["aqi_median", "aqi_max"]


def located_panel(spark, sf_dir):
    """Panel with lon / lat from centroids joined on the name pair."""
    p = fx.panel(spark, sf_dir)
    c = fx.centroids(spark, sf_dir)
    lon, lat = X.parse_point("geolocation")
    c = c.select("state", "county", lon.alias("lon"), lat.alias("lat"))
    return join_on_pairs(p, c, [("state_name", "state"), ("county_name", "county")])


_LOCATED_SQL = f"""
SELECT p.*, c.lon, c.lat FROM panel p
LEFT JOIN ({_POINTS_SQL}) c ON c.state = p.state_name AND c.county = p.county_name"""


@register("centroid_join", with_views(finalize(
    "SELECT geoid, year, state_name, county_name, lon, lat FROM located",
    ["geoid", "state_name", "county_name"]), ["panel", "centroids"], [("located", _LOCATED_SQL)]))
def q_centroid_join(spark, sf_dir):
    """Left join on a pair of differently named keys, right keys dropped."""
    return located_panel(spark, sf_dir).select("geoid", "year", "state_name", "county_name",
                                               "lon", "lat")


def _hav(a, b):
    return (f"2 * asin(sqrt(least(1.0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + "
            f"cos(radians({a}.lat)) * cos(radians({b}.lat)) * "
            f"pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2))))")


_KNN_SQL = f"""
WITH obs AS (SELECT * FROM located WHERE aqi_median IS NOT NULL AND aqi_max IS NOT NULL
               AND lat IS NOT NULL AND lon IS NOT NULL),
miss AS (SELECT * FROM located WHERE aqi_median IS NULL AND aqi_max IS NULL
               AND lat IS NOT NULL AND lon IS NOT NULL),
pairs AS (SELECT m.geoid, m.year, o.geoid AS ogeoid, o.aqi_median AS v1, o.aqi_max AS v2,
                 {_hav('m', 'o')} AS d
          FROM miss m JOIN obs o ON o.year = m.year),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY geoid, year ORDER BY d, ogeoid) AS rn
                       FROM pairs) WHERE rn <= 10),
agg AS (SELECT geoid, year,
          CASE WHEN count_if(d = 0) > 0 THEN avg(CASE WHEN d = 0 THEN v1 END)
               ELSE sum(CASE WHEN d <> 0 THEN v1 / d END) / sum(CASE WHEN d <> 0 THEN 1 / d END) END AS f1,
          CASE WHEN count_if(d = 0) > 0 THEN avg(CASE WHEN d = 0 THEN v2 END)
               ELSE sum(CASE WHEN d <> 0 THEN v2 / d END) / sum(CASE WHEN d <> 0 THEN 1 / d END) END AS f2
        FROM top GROUP BY 1, 2)
SELECT b.geoid, b.year, coalesce(b.aqi_median, a.f1) AS aqi_median,
       coalesce(b.aqi_max, a.f2) AS aqi_max, a.f1 IS NOT NULL AS imputed
FROM located b LEFT JOIN agg a ON a.geoid = b.geoid AND a.year = b.year"""


@register("knn_impute", with_views(finalize(_KNN_SQL, ["geoid", "imputed"]),
                                   ["panel", "centroids"], [("located", _LOCATED_SQL)]))
def q_knn_impute(spark, sf_dir):
    """10 nearest observed rows of the same year by great-circle
    distance, inverse-distance weighted; exact via cell levels."""
    df = located_panel(spark, sf_dir)
    out = knn_impute(df, KNN_COLS, k=10, period="year", key="geoid", lat="lat", lon="lon")
    return out.select("geoid", "year", "aqi_median", "aqi_max", "imputed")
