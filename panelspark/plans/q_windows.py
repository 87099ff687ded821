"""Registered window, ordering and reshape queries (W01-W06, O01-O05,
U01-U03, R01-R03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import reshape as RS
from panelspark.operators import windows as W
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views

_LEAD_SQL = """
SELECT geoid, year, outcome,
       lead(year) OVER (PARTITION BY geoid ORDER BY year) AS next_year,
       lead(outcome) OVER (PARTITION BY geoid ORDER BY year) AS next_outcome
FROM panel"""


def lead_panel(spark, sf_dir):
    p = fx.panel(spark, sf_dir).select("geoid", "year", "outcome")
    return W.lead_target(p, "geoid", "year", {"year": "next_year", "outcome": "next_outcome"})


@register("next_period_target", with_views(finalize(_LEAD_SQL, ["geoid"]), ["panel"]))
def q_next_period_target(spark, sf_dir):
    """Next period and next outcome within the entity."""
    return lead_panel(spark, sf_dir)


@register("consecutive_pairs", with_views(
    finalize(f"SELECT * FROM ({_LEAD_SQL}) WHERE next_year = year + 1", ["geoid"]), ["panel"]))
def q_consecutive_pairs(spark, sf_dir):
    """Keep only truly consecutive (year → year + 1) pairs."""
    return W.consecutive_only(lead_panel(spark, sf_dir))


_LEAD_CHECK_SQL = f"""
SELECT CASE WHEN next_year IS NULL THEN 'last'
            WHEN next_year = year + 1 THEN 'consecutive' ELSE 'gap' END AS step,
       count(*) AS n
FROM ({_LEAD_SQL}) GROUP BY 1"""


@register("lead_check", with_views(_LEAD_CHECK_SQL, ["panel"]))
def q_lead_check(spark, sf_dir):
    """W01/W02 audit: consecutive / gap / last step counts."""
    d = lead_panel(spark, sf_dir)
    step = (F.when(F.col("next_year").isNull(), "last")
             .when(F.col("next_year") == F.col("year") + 1, "consecutive").otherwise("gap"))
    return d.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"))


_TOP3_SQL = """
SELECT state_name, geoid, year, outcome, rn FROM (
  SELECT state_name, geoid, year, outcome,
         CAST(row_number() OVER (PARTITION BY state_name ORDER BY outcome DESC NULLS LAST, geoid, year) AS INTEGER) AS rn
  FROM panel) WHERE rn <= 3"""


@register("top3_per_group", with_views(finalize(_TOP3_SQL, ["state_name", "geoid"]), ["panel"]))
def q_top3_per_group(spark, sf_dir):
    """Top 3 rows per region by outcome (total tie-breaker)."""
    p = fx.panel(spark, sf_dir).select("state_name", "geoid", "year", "outcome")
    return W.top_n_per_group(p, ["state_name"],
                             [("outcome", False), ("geoid", True), ("year", True)], 3,
                             rank_col="rn")


_FIRST_SQL = """
SELECT state, county, geolocation FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY county, geolocation) AS rn
  FROM centroids) WHERE rn = 1"""


@register("first_centroid", with_views(_FIRST_SQL, ["centroids"]))
def q_first_centroid(spark, sf_dir):
    """First row per key under an order (deduplicate centroids)."""
    return W.first_per_key(fx.centroids(spark, sf_dir), ["state"],
                           [("county", True), ("geolocation", True)])


_Z_SQL = """
SELECT p.geoid, p.year, p.outcome,
       CASE WHEN p.outcome IS NULL THEN NULL
            ELSE coalesce((p.outcome - s.m) / nullif(s.sd, 0), 0.0) END AS outcome_z
FROM panel p LEFT JOIN (SELECT year, avg(outcome) AS m, stddev_pop(outcome) AS sd
                        FROM panel GROUP BY year) s ON s.year = p.year"""


@register("zscore_within", with_views(finalize(_Z_SQL, ["geoid"]), ["panel"]))
def q_zscore_within(spark, sf_dir):
    """Z-score within the period (population std, 0 when std = 0)."""
    p = fx.panel(spark, sf_dir).select("geoid", "year", "outcome")
    return W.zscore_within(p, ["year"], "outcome")


DRIVER_FEATURES = [f"f{i}" for i in range(64)]


def top_drivers(df, label, feats, k=6):
    """Strongest ``k`` features per cluster by |z| of the cluster mean
    against the whole-sample mean / population std."""
    overall = df.agg(*[F.avg(f).alias(f"m_{f}") for f in feats],
                     *[F.stddev_pop(f).alias(f"s_{f}") for f in feats])
    means = df.groupBy(label).agg(*[F.avg(f).alias(f) for f in feats])
    long = RS.melt(means, [label], feats, "feature", "cluster_mean")
    ov = RS.melt(overall.select(*[F.struct(F.col(f"m_{f}").alias("m"),
                                           F.col(f"s_{f}").alias("s")).alias(f) for f in feats]),
                 [], feats, "feature", "ms").select("feature", "ms.m", "ms.s")
    z = (long.join(ov, "feature")
             .withColumn("z", (F.col("cluster_mean") - F.col("m")) / F.nullif(F.col("s"), F.lit(0.0)))
             .withColumn("abs_z", F.abs("z")))
    return W.top_n_per_group(z.select(label, "feature", "cluster_mean", "z", "abs_z"), [label],
                             [("abs_z", False), ("feature", True)], k, rank_col="rank")


_DRIVERS_SQL = """
SELECT label, feature, cluster_mean, z, abs_z, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY abs_z DESC NULLS LAST, feature) AS INTEGER) AS rank
  FROM (SELECT c.label, c.feature, c.cluster_mean,
               (c.cluster_mean - o.m) / nullif(o.s, 0) AS z,
               abs((c.cluster_mean - o.m) / nullif(o.s, 0)) AS abs_z
        FROM (UNPIVOT (SELECT label, """ + ", ".join(f"avg({f}) AS {f}" for f in DRIVER_FEATURES) + \
    """ FROM vectors GROUP BY label) ON """ + ", ".join(DRIVER_FEATURES) + \
    """ INTO NAME feature VALUE cluster_mean) c
        JOIN (""" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg({f}) AS m, stddev_pop({f}) AS s FROM vectors"
        for f in DRIVER_FEATURES) + """) o ON o.feature = c.feature))
WHERE rank <= 6"""


@register("top_drivers", with_views(finalize(_DRIVERS_SQL, ["feature"]), ["vectors"]))
def q_top_drivers(spark, sf_dir):
    """Per given cluster, the 6 features whose mean departs most."""
    return top_drivers(fx.vectors(spark, sf_dir), "label", DRIVER_FEATURES, 6)


_SORT_SQL = """
SELECT geoid, year, state_name, outcome, aqi_median FROM panel
ORDER BY state_name, aqi_median DESC NULLS LAST, outcome NULLS LAST, geoid, year LIMIT 25"""


@register("sorted_preview", with_views(finalize(_SORT_SQL, ["geoid", "state_name"]), ["panel"]))
def q_sorted_preview(spark, sf_dir):
    """O01 + O05: multi-key mixed-direction sort, missing last; first 25."""
    p = fx.panel(spark, sf_dir).select("geoid", "year", "state_name", "outcome", "aqi_median")
    return W.top_k(p, [("state_name", True), ("aqi_median", False), ("outcome", True),
                       ("geoid", True), ("year", True)], 25)


_ABS_SQL = f"""
SELECT geoid, year, outcome_z FROM ({_Z_SQL})
ORDER BY abs(outcome_z) DESC NULLS LAST, geoid, year LIMIT 10"""


@register("largest_abs", with_views(finalize(_ABS_SQL, ["geoid"]), ["panel"]))
def q_largest_abs(spark, sf_dir):
    """Order by absolute value (largest |z| first)."""
    p = fx.panel(spark, sf_dir).select("geoid", "year", "outcome")
    z = W.zscore_within(p, ["year"], "outcome").select("geoid", "year", "outcome_z")
    return (z.orderBy(F.abs("outcome_z").desc_nulls_last(), "geoid", "year").limit(10))


_BEST_SQL = """
SELECT year, avg(outcome) AS avg_outcome, count(*) AS n FROM panel GROUP BY year
ORDER BY avg_outcome DESC NULLS LAST, n DESC, year LIMIT 1"""


@register("best_row", with_views(finalize(_BEST_SQL), ["panel"]))
def q_best_row(spark, sf_dir):
    """Arg-max by a tuple of criteria."""
    g = fx.panel(spark, sf_dir).groupBy("year").agg(F.avg("outcome").alias("avg_outcome"),
                                                    F.count(F.lit(1)).alias("n"))
    return W.best_row(g, [("avg_outcome", False), ("n", False), ("year", True)])


_UNION_SQL = """
SELECT 'by_year' AS method, CAST(year AS VARCHAR) AS key, count(*) AS n,
       avg(outcome) AS mean_outcome, NULL::DOUBLE AS max_outcome FROM panel GROUP BY year
UNION ALL
SELECT 'by_region' AS method, state_name AS key, count(*) AS n,
       NULL::DOUBLE AS mean_outcome, max(outcome) AS max_outcome FROM panel GROUP BY state_name
UNION ALL
SELECT 'by_entity' AS method, geoid AS key, count(*) AS n,
       avg(outcome) AS mean_outcome, NULL::DOUBLE AS max_outcome
FROM panel GROUP BY geoid"""


@register("union_loose", with_views(finalize(_UNION_SQL, ["method", "key"]), ["panel"]))
def q_union_loose(spark, sf_dir):
    """Union by name, missing columns filled with NULL."""
    p = fx.panel(spark, sf_dir)
    a = p.groupBy(F.col("year").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("outcome").alias("mean_outcome")) \
        .withColumn("method", F.lit("by_year"))
    b = p.groupBy(F.col("state_name").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max("outcome").alias("max_outcome")) \
        .withColumn("method", F.lit("by_region"))
    c = p.groupBy(F.col("geoid").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("outcome").alias("mean_outcome")) \
        .withColumn("method", F.lit("by_entity"))
    return RS.union_loose([RS.union_all([a, c]), b])


_MELT_COLS = ["avg_outcome", "avg_aqi_median", "avg_aqi_max"]
_MELT_SQL = """
UNPIVOT (SELECT year, avg(outcome) AS avg_outcome, avg(aqi_median) AS avg_aqi_median,
                avg(aqi_max) AS avg_aqi_max FROM panel GROUP BY year)
ON avg_outcome, avg_aqi_median, avg_aqi_max INTO NAME variable VALUE value"""


@register("melt_profile", with_views(finalize(_MELT_SQL, ["variable"]), ["panel"]))
def q_melt_profile(spark, sf_dir):
    """Wide period profile → long (year, variable, value)."""
    g = ag.group_means(fx.panel(spark, sf_dir), "year", ["outcome", "aqi_median", "aqi_max"])
    return RS.melt(g, ["year"], _MELT_COLS)


_WIDEN_SQL = """
SELECT geoid, year,
       max(CASE WHEN model = 'last_value' THEN prediction END) AS pred_last_value,
       max(CASE WHEN model = 'region_mean' THEN prediction END) AS pred_region_mean
FROM (SELECT geoid, year, 'last_value' AS model, outcome AS prediction FROM panel
      UNION ALL
      SELECT p.geoid, p.year, 'region_mean' AS model, r.m AS prediction
      FROM panel p JOIN (SELECT state_name, year, avg(outcome) AS m FROM panel GROUP BY 1, 2) r
        ON r.state_name = p.state_name AND r.year = p.year)
GROUP BY 1, 2"""


@register("widen_predictions", with_views(finalize(_WIDEN_SQL, ["geoid"]), ["panel"]))
def q_widen_predictions(spark, sf_dir):
    """Long (entity, model, prediction) → one column per model."""
    p = fx.panel(spark, sf_dir)
    last = p.select("geoid", "year", F.lit("last_value").alias("model"),
                    F.col("outcome").alias("prediction"))
    rm = p.groupBy("state_name", "year").agg(F.avg("outcome").alias("m"))
    reg = p.join(rm, ["state_name", "year"]).select(
        "geoid", "year", F.lit("region_mean").alias("model"), F.col("m").alias("prediction"))
    return RS.widen(RS.union_all([last, reg]), ["geoid", "year"], "model", "prediction",
                    ["last_value", "region_mean"], prefix="pred_")
