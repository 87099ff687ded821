"""Registered chart-data and test-statistic queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import charts as CH
from panelspark.operators import stats as ST
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views

_HIST_SQL = """
WITH c AS (SELECT outcome AS v FROM panel WHERE outcome IS NOT NULL AND NOT isnan(outcome)),
w AS (SELECT min(v) AS lo, CASE WHEN max(v) > min(v) THEN (max(v) - min(v)) / 20 ELSE 1.0 END AS w FROM c),
b AS (SELECT least(CAST(floor((v - lo) / w) AS INTEGER), 19) AS bin, count(*) AS n
      FROM c CROSS JOIN w GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS lower, lo + (g.bin + 1) * w AS upper,
       coalesce(b.n, 0) AS count
FROM (SELECT unnest(range(0, 20)) AS bin) g CROSS JOIN w LEFT JOIN b ON b.bin = g.bin"""


@register("histogram", with_views(finalize(_HIST_SQL), ["panel"]))
def q_histogram(spark, sf_dir):
    """20 equal-width bins of the outcome, empty bins kept."""
    return CH.histogram(fx.panel(spark, sf_dir), "outcome", 20)


_DENS_SQL = """
WITH c AS (SELECT outcome AS x FROM panel WHERE outcome IS NOT NULL AND NOT isnan(outcome)),
s AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM c),
g AS (SELECT CAST(i AS INTEGER) AS point, lo - 3 * h + i * ((hi + 3 * h) - (lo - 3 * h)) / 49 AS gx, n, h
      FROM s CROSS JOIN (SELECT unnest(range(0, 50)) AS i))
SELECT point, gx AS x, sum(exp(-0.5 * pow((gx - c.x) / h, 2))) / (n * h * sqrt(2 * pi())) AS density
FROM g CROSS JOIN c GROUP BY point, gx, n, h"""


@register("density", with_views(finalize(_DENS_SQL), ["panel"]))
def q_density(spark, sf_dir):
    """Gaussian KDE of the outcome on a 50-point grid."""
    return CH.density(fx.panel(spark, sf_dir), "outcome", points=50)


_BOX_SQL = """
WITH q AS (SELECT year, count(aqi_max) AS n, quantile_cont(aqi_max, 0.25) AS q1,
                  median(aqi_max) AS median, quantile_cont(aqi_max, 0.75) AS q3
           FROM panel WHERE aqi_max IS NOT NULL GROUP BY year)
SELECT q.year, q.n, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr,
       CAST(min(CASE WHEN p.aqi_max BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)
                THEN p.aqi_max END) AS DOUBLE) AS whisker_low,
       CAST(max(CASE WHEN p.aqi_max BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)
                THEN p.aqi_max END) AS DOUBLE) AS whisker_high,
       CNTIF(NOT (p.aqi_max BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1))) AS outliers
FROM panel p JOIN q ON q.year = p.year WHERE p.aqi_max IS NOT NULL
GROUP BY q.year, q.n, q.q1, q.median, q.q3"""


@register("box_stats", with_views(finalize(_BOX_SQL), ["panel"]))
def q_box_stats(spark, sf_dir):
    """Per-year quartiles, whiskers and outlier counts of aqi_max."""
    return CH.box_stats(fx.panel(spark, sf_dir), "aqi_max", ["year"])


_LINE_SQL = """
SELECT year, CNTIF(aqi_median IS NOT NULL AND outcome IS NOT NULL) AS n,
       regr_slope(outcome, aqi_median) AS slope, regr_intercept(outcome, aqi_median) AS intercept,
       corr(aqi_median, outcome) AS r
FROM panel GROUP BY year"""


@register("fit_line", with_views(finalize(_LINE_SQL), ["panel"]))
def q_fit_line(spark, sf_dir):
    """Least-squares line of outcome on aqi_median per year."""
    return CH.fit_line(fx.panel(spark, sf_dir), "aqi_median", "outcome", ["year"])


_ANOVA_SQL = """
SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS n_total,
       sum(n * m * m) - pow(sum(n * m), 2) / sum(n) AS ssb, sum((n - 1) * var) AS ssw,
       CASE WHEN count(*) >= 2 AND sum(n) - count(*) > 0
            THEN ((sum(n * m * m) - pow(sum(n * m), 2) / sum(n)) / (count(*) - 1))
                 / nullif(sum((n - 1) * var) / (sum(n) - count(*)), 0) END AS f_stat,
       CAST(count(*) - 1 AS DOUBLE) AS df_between, CAST(sum(n) - count(*) AS DOUBLE) AS df_within
FROM (SELECT state_name, count(outcome) AS n, avg(outcome) AS m,
             coalesce(var_samp(outcome), 0.0) AS var
      FROM panel WHERE outcome IS NOT NULL AND state_name IS NOT NULL GROUP BY state_name)"""


@register("anova_f", with_views(finalize(_ANOVA_SQL), ["panel"]))
def q_anova_f(spark, sf_dir):
    """A27 (F): one-way ANOVA of the outcome across regions."""
    return ST.anova(fx.panel(spark, sf_dir), "outcome", "state_name", exclude=(), with_p=False)


# P(F' > f) in closed form for an even number of degrees of freedom between groups (24)
_ANOVA_P_SQL = f"""
SELECT *, (SELECT sum(exp(lgamma(df_within / 2 + j) - lgamma(df_within / 2) - lgamma(j + 1)
                  + df_within / 2 * ln(df_within / (df_within + df_between * f_stat))
                  + j * ln(df_between * f_stat / (df_within + df_between * f_stat))))
           FROM range(0, CAST(df_between / 2 AS BIGINT)) t(j)) AS p_value
FROM ({_ANOVA_SQL})"""


@register("anova_p", with_views(finalize(_ANOVA_P_SQL), ["panel"]))
def q_anova_p(spark, sf_dir):
    """A27 (p): F survival function via the regularised incomplete beta."""
    return ST.anova(fx.panel(spark, sf_dir), "outcome", "state_name", exclude=())
