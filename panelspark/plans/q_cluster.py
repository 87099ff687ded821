"""Registered clustering queries (J09, K01-K12, A19, A27 on clusters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import cluster as CL
from panelspark.operators.dbscan import dbscan, eps_degree
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views


def _dbscan_sql(eps: float, m: int) -> str:
    return f"""
WITH RECURSIVE nb AS (
  SELECT a.id AS i, b.id AS j FROM points2d a JOIN points2d b
  ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps} * {eps}),
deg AS (SELECT i, count(*) AS d FROM nb GROUP BY i),
core AS (SELECT i FROM deg WHERE d >= {m}),
cedge AS (SELECT nb.i, nb.j FROM nb JOIN core c1 ON c1.i = nb.i JOIN core c2 ON c2.i = nb.j),
reach(i, j) AS (SELECT i, i FROM core UNION SELECT r.i, e.j FROM reach r JOIN cedge e ON e.i = r.j),
comp AS (SELECT i, min(j) AS root FROM reach GROUP BY i),
lab AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS label
        FROM (SELECT DISTINCT root FROM comp)),
core_lab AS (SELECT comp.i, lab.label FROM comp JOIN lab ON lab.root = comp.root),
border AS (SELECT nb.i, min(cl.label) AS label FROM nb JOIN core_lab cl ON cl.i = nb.j
           WHERE nb.i NOT IN (SELECT i FROM core) GROUP BY nb.i)
SELECT p.id, CAST(coalesce(cl.label, b.label, -1) AS INTEGER) AS label, c.i IS NOT NULL AS is_core
FROM points2d p LEFT JOIN core c ON c.i = p.id LEFT JOIN core_lab cl ON cl.i = p.id
LEFT JOIN border b ON b.i = p.id"""


@register("dbscan_labels", with_views(f"SELECT * FROM ({_dbscan_sql(0.04, 5)})", ["points2d"]))
def q_dbscan_labels(spark, sf_dir):
    """DBSCAN (eps 0.04, min_samples 5) on two embedding coordinates."""
    return dbscan(fx.points2d(spark, sf_dir), 0.04, 5)


@register("dbscan_summary", with_views(f"""
SELECT CAST(count(DISTINCT CASE WHEN label >= 0 THEN label END) AS BIGINT) AS clusters,
       round(avg(CASE WHEN label = -1 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS noise_pct,
       count(*) AS n
FROM ({_dbscan_sql(0.02, 5)})""", ["points2d"]))
def q_dbscan_summary(spark, sf_dir):
    """Cluster count and noise share (eps 0.02, min_samples 5)."""
    return CL.cluster_summary(dbscan(fx.points2d(spark, sf_dir), 0.02, 5), "label")


@register("eps_degree", with_views("""
SELECT a.id, count(*) AS degree FROM points2d a JOIN points2d b
ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.04 * 0.04 GROUP BY a.id""",
                                   ["points2d"]))
def q_eps_degree(spark, sf_dir):
    """ε-neighbourhood sizes (self included) without an all-pairs join."""
    return eps_degree(fx.points2d(spark, sf_dir), 0.04)


FEATS = [f"f{i}" for i in range(64)]
_DIST = " + ".join(f"(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})" for i in range(64))

_SIL_SQL = f"""
WITH pairs AS (SELECT a.id AS i, a.label AS li, b.label AS lj, {_DIST} AS d
               FROM vectors a JOIN vectors b ON a.id <> b.id),
sizes AS (SELECT label, count(*) AS size FROM vectors GROUP BY label),
per AS (SELECT i, li, lj, sum(d) AS dsum FROM pairs GROUP BY 1, 2, 3),
ab AS (SELECT per.i, per.li,
              max(CASE WHEN per.li = per.lj THEN dsum / (s.size - 1) END) AS a,
              min(CASE WHEN per.li <> per.lj THEN dsum / s.size END) AS b
       FROM per JOIN sizes s ON s.label = per.lj GROUP BY 1, 2)
SELECT count(*) AS n,
       avg(CASE WHEN s.size <= 1 THEN 0.0
                ELSE coalesce((ab.b - ab.a) / nullif(greatest(ab.a, ab.b), 0), 0) END) AS silhouette
FROM vectors v JOIN sizes s ON s.label = v.label LEFT JOIN ab ON ab.i = v.id"""


@register("silhouette_exact", with_views(finalize(_SIL_SQL), ["vectors"]))
def q_silhouette_exact(spark, sf_dir):
    """Silhouette (squared Euclidean) of the given labels."""
    return CL.silhouette(fx.vectors(spark, sf_dir), FEATS, "label", exclude=())


_CH_SQL = f"""
WITH per AS (SELECT label, count(*) AS n, {", ".join(f"sum(f{i}) AS s{i}, sum(f{i} * f{i}) AS q{i}" for i in range(64))}
             FROM vectors GROUP BY label),
tot AS (SELECT count(*) AS k, sum(n) AS n_total,
               {", ".join(f"sum(s{i}) AS S{i}, sum(s{i} * s{i} / n) AS B{i}, sum(q{i}) AS Q{i}" for i in range(64))}
        FROM per)
SELECT k, CAST(n_total AS BIGINT) AS n_total,
       {" + ".join(f"(B{i} - S{i} * S{i} / n_total)" for i in range(64))} AS ssb,
       {" + ".join(f"(Q{i} - B{i})" for i in range(64))} AS ssw,
       CASE WHEN k >= 2 THEN (({" + ".join(f"(B{i} - S{i} * S{i} / n_total)" for i in range(64))}) / (k - 1))
            / nullif(({" + ".join(f"(Q{i} - B{i})" for i in range(64))}) / (n_total - k), 0) END AS calinski_harabasz
FROM tot"""


@register("calinski_harabasz", with_views(finalize(_CH_SQL), ["vectors"]))
def q_calinski_harabasz(spark, sf_dir):
    """Calinski–Harabasz index of the given labels."""
    return CL.calinski_harabasz(fx.vectors(spark, sf_dir), FEATS, "label")


_PROFILE_SPEC = {f"{name}_{c}": (func, c) for c in FEATS for name, func in (("avg", "mean"), ("median", "median"), ("max", "max"))}
_PROFILE_COLS = list(_PROFILE_SPEC)
_PROFILE_SQL = f"""
SELECT label, count(*) AS entities, {", ".join(f"avg({c}) AS avg_{c}, median({c}) AS median_{c}, max({c}) AS max_{c}" for c in FEATS)}
FROM vectors GROUP BY label"""


def _profile(spark, sf_dir):
    return ag.cluster_profile(fx.vectors(spark, sf_dir), "label", _PROFILE_SPEC)


@register("cluster_profile", with_views(finalize(_PROFILE_SQL), ["vectors"]))
def q_cluster_profile(spark, sf_dir):
    """Per-cluster count, means, median and max."""
    return _profile(spark, sf_dir)


_STD_PROFILE_SQL = f"""
WITH p AS ({_PROFILE_SQL}),
long AS (UNPIVOT p ON {", ".join(_PROFILE_COLS)} INTO NAME measure VALUE value),
st AS (SELECT measure, avg(value) AS m, stddev_pop(value) AS s FROM long GROUP BY measure)
SELECT long.label, long.measure, long.value,
       coalesce((long.value - st.m) / nullif(st.s, 0), CASE WHEN long.value IS NOT NULL THEN 0.0 END) AS z
FROM long JOIN st ON st.measure = long.measure"""


@register("standardised_profile", with_views(finalize(_STD_PROFILE_SQL, ["measure"]), ["vectors"]))
def q_standardised_profile(spark, sf_dir):
    """Cluster profile melted and z-scored across clusters."""
    return CL.standardised_profile(_profile(spark, sf_dir), "label", _PROFILE_COLS)


# ------------------------------------------------- unsupervised on the panel
from panelspark.operators import stats as ST  # noqa: E402
from panelspark.plans import unsupervised as UN  # noqa: E402
from panelspark.plans.q_enrichment import _enriched  # noqa: E402
from panelspark.session import cut_lineage  # noqa: E402

# The grids searched by the registered queries (the library takes any grid)
EPS_GRID = [round(0.15 + 1.85 * k / 13, 2) for k in range(14)]
MIN_GRID = [5, 10, 20, 35, 50]
K_GRID = [2, 3, 4, 5, 6]
RESTARTS = 25


def _embedded(spark, sf_dir):
    """Latest cross-section of the enriched panel with its embedding."""
    x, feats = UN.cross_section(_enriched(spark, sf_dir))
    return cut_lineage(CL.pca_embed(x, feats, 2)[0]), feats


def _searched(spark, sf_dir):
    """(DBSCAN search, k-means search) over one embedding."""
    emb, feats = _embedded(spark, sf_dir)
    return (UN.search_dbscan(emb, feats, EPS_GRID, MIN_GRID),
            UN.search_kmeans(emb, feats, K_GRID, RESTARTS), emb)


def _assigned(spark, sf_dir):
    db, km, emb = _searched(spark, sf_dir)
    return cut_lineage(emb.join(db.labels.withColumnRenamed("cluster", "dbscan_cluster"), "id")
                          .join(km.labels.withColumnRenamed("cluster", "kmeans_cluster"), "id"))


@register("pca_embed")
def q_pca_embed(spark, sf_dir):
    """Latest cross-section of the enriched panel, imputed and
    standardised, projected on 2 principal components."""
    return _embedded(spark, sf_dir)[0].select("geoid", "pca_1", "pca_2")


@register("dbscan_search")
def q_dbscan_search(spark, sf_dir):
    """DBSCAN over an (eps × min_samples) grid on the PCA embedding."""
    emb, feats = _embedded(spark, sf_dir)
    return UN.search_dbscan(emb, feats, EPS_GRID, MIN_GRID).table


@register("kmeans_search")
def q_kmeans_search(spark, sf_dir):
    """K-means per k with restarts; silhouettes and CH."""
    emb, feats = _embedded(spark, sf_dir)
    return UN.search_kmeans(emb, feats, K_GRID, RESTARTS).table


@register("method_comparison")
def q_method_comparison(spark, sf_dir):
    """The chosen setting of each method side by side."""
    db, km, _ = _searched(spark, sf_dir)
    return db.best.unionByName(km.best)


@register("cluster_assignments")
def q_cluster_assignments(spark, sf_dir):
    """Keys, outcome, embedding and both cluster labels."""
    return _assigned(spark, sf_dir).select(
        "geoid", "county_name", "state_name", "outcome", "pca_1", "pca_2",
        "dbscan_cluster", "kmeans_cluster")


@register("cluster_anova")
def q_cluster_anova(spark, sf_dir):
    """A27 on clusters: one-way ANOVA of the outcome per method, noise
    excluded, F and p."""
    a = _assigned(spark, sf_dir)
    d = ST.anova(a, "outcome", "dbscan_cluster").withColumn("method", F.lit("DBSCAN"))
    k = ST.anova(a, "outcome", "kmeans_cluster").withColumn("method", F.lit("KMeans"))
    return d.unionByName(k).select("method", "f_stat", "p_value", "groups")


@register("cluster_profiles")
def q_cluster_profiles(spark, sf_dir):
    """A19 + K12: per-cluster profile of each method, z-scored across
    clusters."""
    a = _assigned(spark, sf_dir)
    spec = {"avg_outcome": ("mean", "outcome"), "avg_aqi_median": ("mean", "aqi_median"),
            "avg_aqi_max": ("mean", "aqi_max"), "avg_population": ("mean", "population")}
    out = None
    for method, col in [("DBSCAN", "dbscan_cluster"), ("KMeans", "kmeans_cluster")]:
        prof = ag.cluster_profile(a, col, spec).withColumnRenamed(col, "cluster")
        z = CL.standardised_profile(prof, "cluster", list(spec)).withColumn("method", F.lit(method))
        out = z if out is None else out.unionByName(z)
    return out
