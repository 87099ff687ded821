"""Registered scalar cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import keys as K
from panelspark.functions import numbers as N
from panelspark.functions import rules as R
from panelspark.functions import text as X
from panelspark.operators import clean as C
from panelspark.plans import enrichment as en
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views, zf
from panelspark.session import read_table

_CLEAN_KEYS_SQL = f"""
SELECT c_custkey,
       {zf('c_custkey', 5)} AS geoid,
       {zf('c_custkey * 1000', 5)} AS wide_key,
       {zf('c_nationkey', 2)} || {zf('c_custkey % 1000', 3)} AS composite,
       right(c_name, 5) AS name_tail,
       right('0500000US' || {zf('c_custkey', 5)}, 5) AS cut_key,
       coalesce(starts_with(c_mktsegment, 'AUTO'), false) AS is_auto
FROM customer"""


@register("clean_keys", with_views(_CLEAN_KEYS_SQL, []))
def q_clean_keys(spark, sf_dir):
    """Zero padding that never truncates, composite keys,
    last-k characters and a missing-safe prefix predicate."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        K.zfill("c_custkey", 5).alias("geoid"),
        K.zfill(F.col("c_custkey") * 1000, 5).alias("wide_key"),
        K.composite_key(("c_nationkey", 2), (F.col("c_custkey") % 1000, 3)).alias("composite"),
        K.right_chars("c_name", 5).alias("name_tail"),
        K.right_chars(F.concat(F.lit("0500000US"), K.zfill("c_custkey", 5)), 5).alias("cut_key"),
        K.starts_with("c_mktsegment", "AUTO").alias("is_auto"))


_DIRTY_SQL = """
SELECT o_orderkey,
       CASE o_orderkey % 7 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN 'nan'
            WHEN 3 THEN format('{:,.2f}', o_totalprice)
            ELSE CAST(o_totalprice AS VARCHAR) END AS raw
FROM orders"""

_NUMBERS_SQL = """
SELECT o_orderkey, raw,
       CASE WHEN isnan(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS strict_value,
       CASE WHEN isnan(TRY_CAST(replace(raw, ',', '') AS DOUBLE)) THEN NULL
            ELSE TRY_CAST(replace(raw, ',', '') AS DOUBLE) END AS grouped_value,
       TRY_CAST(trunc(TRY_CAST(replace(raw, ',', '') AS DOUBLE)) AS INTEGER) AS int_value
FROM dirty"""


def dirty_numbers(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    m = F.col("o_orderkey") % 7
    raw = (F.when(m == 0, "x").when(m == 1, "").when(m == 2, "nan")
            .when(m == 3, F.format_number("o_totalprice", 2))
            .otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", raw.alias("raw"))


@register("clean_numbers", with_views(finalize(_NUMBERS_SQL, ["raw"]), [],
                                      [("dirty", _DIRTY_SQL)]))
def q_clean_numbers(spark, sf_dir):
    """Lenient coercion, thousands separators, NaN → NULL,
    lenient integer cast."""
    d = dirty_numbers(spark, sf_dir)
    return d.select("o_orderkey", "raw",
                    N.to_number("raw").alias("strict_value"),
                    N.parse_grouped_number("raw").alias("grouped_value"),
                    N.parse_grouped_number("raw").try_cast("int").alias("int_value"))


_SENTINEL_SQL = """
SELECT geoid, year,
       CASE WHEN median_income > -1e8 THEN median_income END AS median_income,
       CASE WHEN abs(signal) <> 'inf'::DOUBLE THEN signal END AS signal
FROM (SELECT geoid, year, median_income,
             CASE WHEN CAST(geoid AS BIGINT) % 11 = 0 THEN 'inf'::DOUBLE
                  WHEN CAST(geoid AS BIGINT) % 13 = 0 THEN '-inf'::DOUBLE
                  ELSE outcome END AS signal FROM panel)"""


@register("sentinel_nulls", with_views(finalize(_SENTINEL_SQL, ["geoid"]), ["panel"]))
def q_sentinel_nulls(spark, sf_dir):
    """Sentinel floor and ±inf to missing across numeric columns."""
    p = fx.panel(spark, sf_dir)
    k = F.col("geoid").cast("bigint")
    sig = (F.when(k % 11 == 0, F.lit(float("inf"))).when(k % 13 == 0, F.lit(float("-inf")))
            .otherwise(F.col("outcome")))
    df = p.select("geoid", "year", "median_income", sig.alias("signal"))
    return C.null_infinite(C.null_sentinels(df, cols=["median_income"]), ["signal"])


_RATES_SQL = """
SELECT p.geoid, p.year,
       p.poverty_count / nullif(p.population, 0) AS poverty_rate,
       p.unemployed_count / nullif(p.population, 0) AS unemployment_rate,
       p.poverty_count + p.unemployed_count + p.aqi_median AS strict_total,
       coalesce(p.poverty_count, 0) + coalesce(p.unemployed_count, 0) + coalesce(p.aqi_median, 0) AS loose_total,
       1.0 - p.poverty_count / nullif(p.population, 0) AS above_poverty_share,
       CASE WHEN p.aqi_max IS NOT NULL THEN least(greatest(p.aqi_max, 80), 180) END AS aqi_max_clipped
FROM panel p"""


@register("rates", with_views(finalize(_RATES_SQL, ["geoid"]), ["panel"]))
def q_rates(spark, sf_dir):
    """Rates with zero-safe denominators,
    missing-propagating and missing-skipping row sums, complement, clip."""
    p = fx.panel(spark, sf_dir)
    return p.select(
        "geoid", "year",
        N.rate("poverty_count", "population").alias("poverty_rate"),
        N.rate("unemployed_count", "population").alias("unemployment_rate"),
        N.sum_cols_strict(["poverty_count", "unemployed_count", "aqi_median"]).alias("strict_total"),
        N.sum_cols(["poverty_count", "unemployed_count", "aqi_median"]).alias("loose_total"),
        N.complement(N.rate("poverty_count", "population")).alias("above_poverty_share"),
        N.clip("aqi_max", 80, 180).alias("aqi_max_clipped"))


_CODES_SQL = f"""
SELECT c.c_custkey, {zf('c.c_nationkey', 2)} AS code, m.label,
       CASE WHEN m.label IS NOT NULL THEN m.label || '-' || {zf('c.c_custkey % 1000', 3)} END
         AS location_id
FROM customer c LEFT JOIN code_map m ON m.code = {zf('c.c_nationkey', 2)}"""


@register("code_lookup", with_views(_CODES_SQL, ["code_map"]))
def q_code_lookup(spark, sf_dir):
    """Code → label through a mapping table, derived id, unmapped →
    NULL."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", K.zfill("c_nationkey", 2).alias("code"),
        K.zfill(F.col("c_custkey") % 1000, 3).alias("_cty"))
    out = C.map_codes(c, "code", fx.code_map(spark, sf_dir))
    return out.select("c_custkey", "code", "label",
                      F.when(F.col("label").isNotNull(),
                             F.concat("label", F.lit("-"), "_cty")).alias("location_id"))


_SLUG_SQL = """
SELECT category, defining_param,
       regexp_replace(lower(category), '[ /]', '_', 'g') AS category_slug,
       replace(replace(lower(defining_param), '.', ''), ' ', '_') AS param_slug,
       'daily_aqi_category_days_' || regexp_replace(lower(category), '[ /]', '_', 'g') AS feature_name,
       CAST(count(*) AS BIGINT) AS n
FROM daily GROUP BY 1, 2"""


@register("slug_labels", with_views(_SLUG_SQL, ["daily"]))
def q_slug_labels(spark, sf_dir):
    """Category / pollutant slugs and derived feature names."""
    d = fx.daily_raw(spark, sf_dir)
    return (d.groupBy("category", "defining_param").agg(F.count(F.lit(1)).alias("n"))
             .select("category", "defining_param",
                     X.slug("category").alias("category_slug"),
                     X.param_slug("defining_param").alias("param_slug"),
                     F.concat(F.lit("daily_aqi_category_days_"), X.slug("category"))
                      .alias("feature_name"), "n"))


_TITLE_SQL = """
SELECT variable, list_aggr(list_transform(string_split(
         CASE WHEN starts_with(variable, 'daily_aqi_') THEN substr(variable, 11) ELSE variable END, '_'),
         lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ' ') AS label
FROM (SELECT DISTINCT 'daily_aqi_category_days_' || regexp_replace(lower(category), '[ /]', '_', 'g')
        AS variable FROM daily)"""


@register("title_labels", with_views(_TITLE_SQL, ["daily"]))
def q_title_labels(spark, sf_dir):
    """Strip a prefix, '_' → ' ', title case."""
    d = fx.daily_raw(spark, sf_dir).select(
        F.concat(F.lit("daily_aqi_category_days_"), X.slug("category")).alias("variable")).distinct()
    return d.select("variable", X.clean_label("variable", "daily_aqi_").alias("label"))


_PARAMS_TEXT_SQL = """
SELECT id, CASE WHEN id % 2 = 0
                THEN 'eps=' || CAST((id % 20) / 10.0 AS VARCHAR) || ', min_samples=' || CAST(label + 3 AS VARCHAR)
                ELSE 'k=' || CAST(label + 2 AS VARCHAR) END AS params
FROM points2d"""

_PARAMS_SQL = """
SELECT id, params,
       TRY_CAST(NULLIF(regexp_extract(params, '(?:^|[\\s,])eps\\s*=\\s*([^,\\s]+)', 1), '') AS DOUBLE) AS eps,
       TRY_CAST(NULLIF(regexp_extract(params, '(?:^|[\\s,])min_samples\\s*=\\s*([^,\\s]+)', 1), '') AS INTEGER) AS min_samples,
       TRY_CAST(NULLIF(regexp_extract(params, '(?:^|[\\s,])k\\s*=\\s*([^,\\s]+)', 1), '') AS INTEGER) AS k
FROM param_text"""


@register("parse_params", with_views(finalize(_PARAMS_SQL, ["params"]), ["points2d"],
                                     [("param_text", _PARAMS_TEXT_SQL)]))
def q_parse_params(spark, sf_dir):
    """Typed values out of ``name=value`` parameter text."""
    p = fx.points2d(spark, sf_dir)
    txt = F.when(F.col("id") % 2 == 0,
                 F.concat(F.lit("eps="), ((F.col("id") % 20) / 10.0).cast("string"),
                          F.lit(", min_samples="), (F.col("label") + 3).cast("string"))
                 ).otherwise(F.concat(F.lit("k="), (F.col("label") + 2).cast("string")))
    t = p.select("id", txt.alias("params"))
    return t.select("id", "params", X.parse_param("params", "eps").alias("eps"),
                    X.parse_param("params", "min_samples", "int").alias("min_samples"),
                    X.parse_param("params", "k", "int").alias("k"))


_POINTS_SQL = """
SELECT state, county, geolocation,
  TRY_CAST(NULLIF(regexp_extract(geolocation, '^\\s*POINT\\s*\\(\\s*(-?[0-9]+(?:\\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)\\s+(-?[0-9]+(?:\\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)\\s*\\)\\s*$', 1), '') AS DOUBLE) AS lon,
  TRY_CAST(NULLIF(regexp_extract(geolocation, '^\\s*POINT\\s*\\(\\s*(-?[0-9]+(?:\\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)\\s+(-?[0-9]+(?:\\.[0-9]*)?(?:[eE][-+]?[0-9]+)?)\\s*\\)\\s*$', 2), '') AS DOUBLE) AS lat
FROM centroids"""


@register("parse_points", with_views(finalize(_POINTS_SQL, ["state", "county", "geolocation"]),
                                     ["centroids"]))
def q_parse_points(spark, sf_dir):
    """WKT ``POINT (lon lat)`` → two doubles."""
    c = fx.centroids(spark, sf_dir)
    lon, lat = X.parse_point("geolocation")
    return c.select("state", "county", "geolocation", lon.alias("lon"), lat.alias("lat"))


_DATES_SQL = """
SELECT file_year, CAST(month(d) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS n
FROM (SELECT 1995 + CAST(l_orderkey % 7 AS INTEGER) AS file_year,
             TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'not a date'
                           ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS DATE) AS d
      FROM lineitem)
WHERE year(d) = file_year
GROUP BY 1, 2"""


@register("clean_dates", with_views(_DATES_SQL, []))
def q_clean_dates(spark, sf_dir):
    """Lenient date parsing, keep rows dated in their file's
    period, month counts."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    txt = F.when(F.col("l_linenumber") == 7, F.lit("not a date")).otherwise(
        F.to_date("l_shipdate").cast("string"))
    d = li.select((F.lit(1995) + (F.col("l_orderkey") % 7)).cast("int").alias("file_year"),
                  F.try_to_date(txt, "yyyy-MM-dd").alias("d"))
    return (d.where(F.year("d") == F.col("file_year"))
             .groupBy("file_year", F.month("d").alias("month"))
             .agg(F.count(F.lit(1)).alias("n")))


_FORMAT_SQL = """
SELECT geoid, year,
       CASE WHEN outcome IS NULL THEN '--' ELSE format('{:,.2f}', outcome) END AS outcome_text,
       CASE WHEN population IS NULL THEN '--' ELSE format('{:,.0f}', CAST(population AS DOUBLE)) END AS population_text,
       CASE WHEN outcome IS NULL THEN '--' ELSE format('{:,.1f}', outcome / 100 * 100) || '%' END AS outcome_pct,
       CASE WHEN outcome - 25 > 0 THEN 'above average' WHEN outcome IS NOT NULL THEN 'below average' END
         AS direction,
       'panel' AS section
FROM panel"""


@register("display_format", with_views(_FORMAT_SQL, ["panel"]))
def q_display_format(spark, sf_dir):
    """Display text with '--' for missing, sign labels, a
    literal tag column."""
    p = fx.panel(spark, sf_dir)
    return p.select("geoid", "year",
                    X.fmt_num("outcome", 2).alias("outcome_text"),
                    X.fmt_num("population", 0).alias("population_text"),
                    X.fmt_pct(F.col("outcome") / 100, 1).alias("outcome_pct"),
                    X.direction(F.col("outcome") - 25).alias("direction"),
                    F.lit("panel").alias("section"))
