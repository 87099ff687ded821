"""Unsupervised composition (path B, second half): latest cross-section →
impute / scale → 2-D PCA → DBSCAN and k-means searches → comparison,
assignments, ANOVA of the held-out outcome and cluster profiles."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators import cluster as CL
from panelspark.operators.clean import null_sentinels, numeric_columns
from panelspark.operators.dbscan import dbscan_grid
from panelspark.operators.features import MedianImputer, Standardiser
from panelspark.operators.windows import ordinal
from panelspark.session import cut_lineage

# Columns never used as clustering features.
EXCLUDE = ["outcome", "lower_ci", "upper_ci", "year", "source_year", "next_year", "next_outcome"]


def cross_section(panel: DataFrame, key: str = "geoid", period: str = "year"
                  ) -> tuple[DataFrame, list[str]]:
    """K01 + P10 + M03 + M04: latest period, sentinels nulled, numeric
    features median-imputed and standardised (population std); rows get a
    numeric ``id`` in key order (the visiting order of DBSCAN)."""
    # stored: the period, the medians and the spreads each read it again
    latest = cut_lineage(null_sentinels(CL.latest(panel, period)))
    feats = numeric_columns(latest, EXCLUDE)
    imp = MedianImputer(feats).fit(latest)
    used = [f for f in feats if imp.values.get(f) is not None]
    x = imp.transform(latest)
    x = Standardiser(used).fit(x).transform(x)
    return cut_lineage(ordinal(x, [key], "id")), used


@dataclass
class Search:
    """All settings (one row each), the chosen row, and its labels."""
    table: DataFrame
    best: DataFrame
    labels: DataFrame


def _searched(emb: DataFrame, labels: DataFrame, settings: DataFrame, method: str, scaled: Sequence[str], dispersion: bool,
              order: Sequence[Column]) -> Search:
    """One row per setting of ``settings`` (_setting, params), whose number is its place in
    ``labels`` (id, labels); the first in ``order`` is chosen."""
    scores = CL.GridScores(emb, labels, [["pca_1", "pca_2"], scaled], settings.count())
    table = settings.join(scores.counts(), "_setting").join(scores.silhouettes(), "_setting", "left")
    table = table.join(scores.dispersion(1), "_setting", "left") if dispersion else table.withColumn(
        "calinski_harabasz", F.lit(None).cast("double"))
    table = cut_lineage(table.select("_setting", F.lit(method).alias("method"), "params", "clusters", "noise_pct",
                                     F.col("silhouette0").alias("silhouette_embedding"),
                                     F.col("silhouette1").alias("silhouette_scaled_features"), "calinski_harabasz"))
    best = table.orderBy(*order, "params").limit(1)  # one row per setting: the choice is a top-1
    chosen = best.first()["_setting"]
    return Search(table.drop("_setting"), best.drop("_setting"), labels.select("id", F.col("labels")[chosen].alias("cluster")))


def search_dbscan(emb: DataFrame, scaled_feats: Sequence[str], eps_grid: Sequence[float],
                  min_grid: Sequence[int]) -> Search:
    """Every (eps, min_samples) setting → clusters, noise share and
    silhouettes (embedding, scaled features) of the rows in clusters.  A
    setting with 2 to 12 clusters goes before others, there the better pair
    of silhouettes; among the others more clusters, then less noise.  All
    settings run in the jobs of one."""
    eps_grid, min_grid = list(dict.fromkeys(map(float, eps_grid))), list(dict.fromkeys(map(int, min_grid)))
    params = F.concat(F.lit("eps="), F.col("eps").cast("string"), F.lit(", min_samples="), F.col("min_samples").cast("string"))
    settings = emb.sparkSession.createDataFrame(
        [(k, e, m) for k, (e, m) in enumerate(itertools.product(eps_grid, min_grid))],
        "_setting int, eps double, min_samples int").select("_setting", params.alias("params"))
    labels = cut_lineage(dbscan_grid(emb, eps_grid, min_grid, "id", "pca_1", "pca_2"))
    fits = F.col("clusters").between(2, 12)
    return _searched(emb, labels, settings, "DBSCAN", scaled_feats, False, [
        fits.desc(), F.when(fits, F.col("silhouette_embedding")).desc_nulls_last(),
        F.when(fits, F.col("silhouette_scaled_features")).desc_nulls_last(),
        F.when(~fits, F.col("clusters")).desc_nulls_last(), F.when(~fits, F.col("noise_pct")).asc_nulls_last()])


def search_kmeans(x: DataFrame, feats: Sequence[str], ks: Sequence[int], restarts: int,
                  seed: int = 42) -> Search:
    """K05 + K06: k-means per k (best of ``restarts`` seeds); silhouettes
    and Calinski–Harabasz; the best silhouette on scaled features is chosen."""
    ks = list(dict.fromkeys(ks))
    best = CL.kmeans_many(x, feats, ks, restarts, seed)
    labels = cut_lineage(CL.assigned_all(x, feats, [best[k][0] for k in ks]))
    settings = x.sparkSession.createDataFrame([(j, f"k={k}") for j, k in enumerate(ks)], "_setting int, params string")
    return _searched(x, labels, settings, "KMeans", feats, True, [F.col("silhouette_scaled_features").desc_nulls_last()])
