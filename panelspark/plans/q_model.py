"""Registered modelling queries with SQL oracles (M01-M06, M11, M15,
M20, A20, P24, P32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import features as FE
from panelspark.plans import fixtures as fx
from panelspark.plans import modelling as MD
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views

FEATURES = ["population", "median_income", "poverty_count", "unemployed_count", "aqi_median",
            "aqi_max", "total_population_numeric"]

_SUP_SQL = """
SELECT * FROM (
  SELECT *, lead(year) OVER w AS next_year, lead(outcome) OVER w AS next_outcome,
         TRY_CAST(replace(total_population, ',', '') AS DOUBLE) AS total_population_numeric
  FROM (SELECT * REPLACE (CASE WHEN median_income > -1e8 THEN median_income END AS median_income)
        FROM panel)
  WINDOW w AS (PARTITION BY geoid ORDER BY year))
WHERE next_year = year + 1"""
_TRAIN_SQL = ("SELECT * FROM sup WHERE next_outcome IS NOT NULL AND year < "
              "(SELECT max(year) FROM sup WHERE next_outcome IS NOT NULL)")
_TEST_SQL = ("SELECT * FROM sup WHERE next_outcome IS NOT NULL AND year = "
             "(SELECT max(year) FROM sup WHERE next_outcome IS NOT NULL)")
_CTES = [("sup", _SUP_SQL), ("train", _TRAIN_SQL), ("test", _TEST_SQL)]


def _split(spark, sf_dir):
    sup = MD.supervised_frame(fx.panel(spark, sf_dir))
    return MD.split(sup)


_SPLIT_SQL = """
SELECT 'train' AS part, year, count(*) AS n FROM train GROUP BY year
UNION ALL SELECT 'test' AS part, year, count(*) AS n FROM test GROUP BY year"""


@register("temporal_split_sizes", with_views(_SPLIT_SQL, ["panel"], _CTES))
def q_temporal_split_sizes(spark, sf_dir):
    """Next-year target, consecutive pairs, last year = test."""
    train, test = _split(spark, sf_dir)
    cnt = lambda d, p: d.groupBy("year").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(p))
    return cnt(train, "train").unionByName(cnt(test, "test"))


_MED_SQL = ("SELECT geoid, year, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM train)) AS {c}" for c in FEATURES)
    + " FROM test")


@register("median_imputed", with_views(finalize(_MED_SQL, ["geoid"]), ["panel"], _CTES))
def q_median_imputed(spark, sf_dir):
    """Exact medians learned on train, applied to test."""
    train, test = _split(spark, sf_dir)
    imp = FE.MedianImputer(FEATURES).fit(train)
    return imp.transform(test.select("geoid", "year", *FEATURES))


_STD_SQL = ("WITH imp_train AS (SELECT " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM train)) AS {c}" for c in FEATURES)
    + " FROM train), imp_test AS (" + _MED_SQL + ") SELECT geoid, year, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM imp_train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}) END FROM imp_train) AS {c}" for c in FEATURES) + " FROM imp_test")


@register("standardised", with_views(finalize(_STD_SQL, ["geoid"]), ["panel"], _CTES))
def q_standardised(spark, sf_dir):
    """M03 + M04: impute, then standardise with train mean / population std."""
    train, test = _split(spark, sf_dir)
    imp = FE.MedianImputer(FEATURES).fit(train)
    tr = imp.transform(train.select("geoid", "year", *FEATURES))
    te = imp.transform(test.select("geoid", "year", *FEATURES))
    return FE.Standardiser(FEATURES).fit(tr).transform(te)


_BASE_METRICS_SQL = """
SELECT count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
       1 - sum(e * e) / nullif(sum((y - ym) * (y - ym)), 0) AS r2
FROM (SELECT next_outcome AS y, next_outcome - (SELECT avg(next_outcome) FROM train) AS e,
             avg(next_outcome) OVER () AS ym FROM test)"""


@register("mean_baseline_metrics", with_views(finalize(_BASE_METRICS_SQL), ["panel"], _CTES))
def q_mean_baseline_metrics(spark, sf_dir):
    """M06 + M15: training-mean prediction scored on the hold-out year."""
    train, test = _split(spark, sf_dir)
    pred = FE.mean_baseline(train, test, "next_outcome")
    return FE.regression_metrics(pred, "next_outcome", "prediction")


_CV_FOLDS_SQL = """
SELECT t.year, count(*) AS n, sqrt(avg((t.next_outcome - f.p) * (t.next_outcome - f.p))) AS rmse,
       avg(abs(t.next_outcome - f.p)) AS mae,
       1 - sum((t.next_outcome - f.p) * (t.next_outcome - f.p))
           / nullif(sum((t.next_outcome - s.ym) * (t.next_outcome - s.ym)), 0) AS r2
FROM train t
JOIN (SELECT g.year, (a.s - g.s) / (a.n - g.n) AS p
      FROM (SELECT year, sum(next_outcome) AS s, count(next_outcome) AS n FROM train GROUP BY year) g,
           (SELECT sum(next_outcome) AS s, count(next_outcome) AS n FROM train) a) f ON f.year = t.year
JOIN (SELECT year, avg(next_outcome) AS ym FROM train GROUP BY year) s ON s.year = t.year
GROUP BY t.year"""


@register("grouped_cv_baseline", with_views(finalize(_CV_FOLDS_SQL), ["panel"], _CTES))
def q_grouped_cv_baseline(spark, sf_dir):
    """M11 (mean baseline): leave-one-year-out fold metrics in one plan."""
    train, _ = _split(spark, sf_dir)
    return FE.grouped_cv_mean_baseline(train, "next_outcome")


_CV_SUMMARY_SQL = f"""
SELECT count(*) AS folds, avg(rmse) AS cv_rmse_mean, stddev_pop(rmse) AS cv_rmse_sd,
       avg(mae) AS cv_mae_mean, stddev_pop(mae) AS cv_mae_sd,
       avg(r2) AS cv_r2_mean, stddev_pop(r2) AS cv_r2_sd
FROM ({_CV_FOLDS_SQL})"""


@register("grouped_cv_summary", with_views(finalize(_CV_SUMMARY_SQL), ["panel"], _CTES))
def q_grouped_cv_summary(spark, sf_dir):
    """Mean ± population SD of the fold metrics."""
    train, _ = _split(spark, sf_dir)
    return FE.cv_summary(FE.grouped_cv_mean_baseline(train, "next_outcome"))


_PREDS_SQL = """
SELECT geoid, county_name, state_name, year, next_year, next_outcome,
       (SELECT avg(next_outcome) FROM train) AS prediction,
       next_outcome - (SELECT avg(next_outcome) FROM train) AS residual,
       abs(next_outcome - (SELECT avg(next_outcome) FROM train)) AS abs_residual
FROM test"""


def _preds(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    pred = FE.mean_baseline(train, test.select("geoid", "county_name", "state_name", "year",
                                               "next_year", "next_outcome"), "next_outcome")
    return MD.residuals(pred, "next_outcome", "prediction")


_ERR_SQL = f"""
SELECT state_name, count(*) AS n, sqrt(avg(residual * residual)) AS rmse,
       avg(abs(residual)) AS mae, avg(next_outcome) AS mean_next_outcome
FROM ({_PREDS_SQL}) GROUP BY state_name"""


@register("error_by_region", with_views(finalize(_ERR_SQL, ["state_name"]), ["panel"], _CTES))
def q_error_by_region(spark, sf_dir):
    """P32 + A20: residuals and RMSE / MAE per region."""
    return ag.error_by(_preds(spark, sf_dir), "state_name", extra_means=["next_outcome"])


_FAIL_SQL = f"""
SELECT *, CASE WHEN abs_residual >= 6 THEN 'far off' WHEN residual >= 1.5 THEN 'too low'
               WHEN residual <= -1.5 THEN 'too high' ELSE 'close' END AS failure_category
FROM ({_PREDS_SQL}) ORDER BY abs_residual DESC NULLS LAST, geoid, year LIMIT 12"""


@register("failure_examples", with_views(
    finalize(_FAIL_SQL, ["geoid", "county_name", "state_name", "failure_category"]),
    ["panel"], _CTES))
def q_failure_examples(spark, sf_dir):
    """M20 + P24: 12 largest absolute residuals with a rule-ladder category."""
    rules = [(F.abs("residual") >= 6, "far off"), (F.col("residual") >= 1.5, "too low"),
             (F.col("residual") <= -1.5, "too high")]
    return MD.failure_examples(_preds(spark, sf_dir), rules, "close")


@register("random_split_sizes")
def q_random_split_sizes(spark, sf_dir):
    """Seeded hash split (80/20) by entity; rows per side."""
    sup = MD.supervised_frame(fx.panel(spark, sf_dir))
    tr, te = FE.random_split(sup, "geoid", 20, 42)
    return (tr.select(F.lit("train").alias("part")).unionByName(te.select(F.lit("test").alias("part")))
              .groupBy("part").agg(F.count(F.lit(1)).alias("n")))
