"""Model and clustering invariants against NumPy closed forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from fixture_paths import SF_SMALL

from panelspark.operators import cluster as CL
from panelspark.operators import features as FE
from panelspark.operators import models as ML


@pytest.fixture(scope="module")
def reg_data(spark):
    rng = np.random.default_rng(0)
    n, p = 300, 4
    X = rng.normal(size=(n, p)) * [1, 5, 0.5, 2] + [0, 10, -3, 1]
    y = X @ np.array([1.5, -0.4, 0.0, 0.8]) + rng.normal(size=n) * 2 + 3
    rows = [(i, 2015 + i % 5, *map(float, X[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, year int, a double, b double, c double, d double, y double")
    return df, X, y


def _std(X):
    return (X - X.mean(0)) / X.std(0)


def _cd(X, y, a, r, it=20000):
    n, p = X.shape
    w = np.zeros(p)
    yc = y - y.mean()
    for _ in range(it):
        old = w.copy()
        for j in range(p):
            rj = yc - X @ w + X[:, j] * w[j]
            z = X[:, j] @ rj / n
            w[j] = np.sign(z) * max(abs(z) - a * r, 0) / (X[:, j] @ X[:, j] / n + a * (1 - r))
        if np.abs(w - old).max() < 1e-14:
            break
    return w


FEATS = ["a", "b", "c", "d"]


def test_elastic_net_equals_sklearn_objective(reg_data):
    df, X, y = reg_data
    for a, r in [(0.1, 0.9), (1.0, 0.5)]:
        f = ML.fit(ML.elastic_net(a, r), df, FEATS, "y")
        assert np.abs(np.array(f.model.coefficients) - _cd(_std(X), y, a, r)).max() < 1e-6


def test_ridge_equals_closed_form(reg_data):
    df, X, y = reg_data
    Xs = _std(X)
    alpha = 10.0
    w = np.linalg.solve(Xs.T @ Xs + alpha * np.eye(4), Xs.T @ (y - y.mean()))
    f = ML.fit(ML.ridge(alpha), df, FEATS, "y")
    assert np.abs(np.array(f.model.coefficients) - w).max() < 1e-6


def test_metrics_identities_and_baseline(spark, reg_data):
    df, X, y = reg_data
    f = ML.fit(ML.mean_spec(), df, FEATS, "y")
    m = ML.holdout_metrics(f, df)
    assert math.isclose(m["r2"], 0.0, abs_tol=1e-12) and m["rmse"] >= m["mae"]
    assert math.isclose(m["rmse"], float(np.std(y)), rel_tol=1e-9)


def test_grouped_cv_and_search(reg_data):
    df, X, y = reg_data
    rows = ML.grouped_cv(ML.elastic_net(0.1, 0.9), df, FEATS, "y")
    assert [r["fold"] for r in rows] == ["2015", "2016", "2017", "2018", "2019"]
    s = ML.summarise_cv(rows)
    assert math.isclose(s["cv_rmse_sd"], float(np.std([r["rmse"] for r in rows])))
    specs = ML.param_grid(ML.elastic_net, {"alpha": [0.01, 100.0], "l1_ratio": [0.5]})
    best, table = ML.grid_search(specs, df, FEATS, "y")
    assert best.params["alpha"] == 0.01 and len(table) == 2


def test_mean_baseline_cv_matches_model_loop(spark, reg_data):
    df, X, y = reg_data
    plan = {r.year: r.rmse for r in FE.grouped_cv_mean_baseline(df, "y").collect()}
    loop = {int(r["fold"]): r["rmse"] for r in ML.grouped_cv(ML.mean_spec(), df, FEATS, "y")}
    assert all(math.isclose(plan[k], loop[k], rel_tol=1e-9) for k in loop)


def test_forest_and_gbt_fit(reg_data):
    df, X, y = reg_data
    rf = ML.fit(ML.random_forest(20, "sqrt", 2, max_depth=6), df, FEATS, "y")
    imp = ML.importance(rf, FEATS)
    assert math.isclose(sum(r["importance"] for r in imp), 1.0, rel_tol=1e-9)
    g = ML.fit(ML.gbt(20, 0.1, 3), df, FEATS, "y")
    assert ML.holdout_metrics(g, df)["rmse"] < float(np.std(y))
    named = df.withColumnRenamed("a", "median_income").withColumnRenamed("b", "pct_trade")
    fam_feats = ["median_income", "pct_trade", "c", "d"]
    abl = ML.ablation(ML.random_forest(10, "sqrt", 1, max_depth=5), named, named, fam_feats, "y")
    fams = {r["removed_family"]: r for r in abl}
    assert abl[0]["rmse_delta"] == 0.0
    assert set(fams) == {"None (full model)", "Socioeconomic scale", "Industry composition", "Other"}
    assert fams["Other"]["features_removed"] == 2


def test_imputer_and_scaler_semantics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double")
    imp = FE.MedianImputer(["v"]).fit(df)
    assert imp.values["v"] == 2.5  # pandas / scikit-learn median
    sc = FE.Standardiser(["v"]).fit(imp.transform(df))
    vals = np.array([r.v for r in sc.transform(imp.transform(df)).collect()])
    assert abs(vals.mean()) < 1e-12 and abs(vals.std() - 1) < 1e-12  # population std


def test_split_helpers(spark):
    df = spark.createDataFrame([(i, 2019 + i % 3) for i in range(300)], "id long, year int")
    tr, te = FE.temporal_split(df)
    assert te.agg(F.min("year")).first()[0] == 2021 and tr.agg(F.max("year")).first()[0] == 2020
    a, b = FE.random_split(df, "id", 20, 42)
    a2, b2 = FE.random_split(df.repartition(7), "id", 20, 42)
    assert sorted(r.id for r in b.collect()) == sorted(r.id for r in b2.collect())
    assert a.count() + b.count() == 300 and 30 < b.count() < 90


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(c, 0.3, size=(40, 3)) for c in ([0, 0, 0], [3, 3, 0], [0, 4, 4])])
    lab = np.repeat([0, 1, 2], 40)
    rows = [(i, int(lab[i]), *map(float, X[i])) for i in range(len(X))]
    return spark.createDataFrame(rows, "id long, label int, x double, y double, z double"), X, lab


def test_silhouette_and_ch_match_numpy(blobs):
    df, X, lab = blobs
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = CL.silhouette(df, ["x", "y", "z"], "label", exclude=()).first()
    assert math.isclose(got.silhouette, float(np.mean(s)), rel_tol=1e-9)
    mu = X.mean(0)
    ssb = sum((lab == c).sum() * ((X[lab == c].mean(0) - mu) ** 2).sum() for c in range(3))
    ssw = sum(((X[lab == c] - X[lab == c].mean(0)) ** 2).sum() for c in range(3))
    ch = CL.calinski_harabasz(df, ["x", "y", "z"], "label").first().calinski_harabasz
    assert math.isclose(ch, (ssb / 2) / (ssw / (len(X) - 3)), rel_tol=1e-9)
    far = df.select("id", "label", *[(F.col(c) + 1e7).alias(c) for c in "xyz"])
    assert math.isclose(CL.silhouette(far, ["x", "y", "z"], "label").first().silhouette, float(np.mean(s)), rel_tol=1e-6)


def test_silhouette_and_ch_edges(spark):
    def both(rows):
        df = spark.createDataFrame(rows, "label int, x double")
        return (CL.silhouette(df, ["x"], "label").first().silhouette,
                CL.calinski_harabasz(df, ["x"], "label").first().calinski_harabasz)
    assert both([(0, 1.0), (1, 2.0)]) == (0.0, None)  # each point alone, n = k
    assert both([(0, 1.0), (0, 1.0), (1, 1.0), (1, 1.0)])[0] == 0.0  # all in one place
    assert both([(0, 1.0), (0, 2.0)])[0] is None  # one cluster
    assert both([(0, 0.0), (0, 0.0), (1, 5.0), (1, 5.0), (-1, 2.0)])[0] == 1.0  # noise left out


def test_kmeans_pca_invariants(blobs):
    df, X, lab = blobs
    out, cost = CL.kmeans(df, ["x", "y", "z"], 3, restarts=3)
    pairs = {(r.label, r.cluster) for r in out.collect()}
    assert len(pairs) == 3  # recovers the three blobs up to renaming
    emb, load, var = CL.pca_embed(df, ["x", "y", "z"], 2)
    L = np.array(load)
    assert np.allclose(L.T @ L, np.eye(2), atol=1e-9)
    assert all(L[np.abs(L[:, j]).argmax(), j] > 0 for j in range(2))
    e = np.array([(r.pca_1, r.pca_2) for r in emb.orderBy("id").collect()])
    assert np.allclose(e, (X - X.mean(0)) @ L, atol=1e-9)
    s = CL.cluster_summary(spark_df := df.withColumn("label", F.when(F.col("id") < 3, -1).otherwise(F.col("label"))), "label").first()
    assert s.clusters == 3 and math.isclose(s.noise_pct, 3 / 120)


def test_search_scores_equal_the_single_settings(spark, blobs):
    df = blobs[0]
    rows = df.select(F.xxhash64("x", "y", "z").alias("id"), "x", "y", "z").dropDuplicates(["id"])
    cut = {"a": "cast(pmod(id, 4) as int)", "b": "cast(pmod(id, 3) as int) - 1", "c": "0", "d": "-1"}
    labels = None
    for name, rule in cut.items():
        one = rows.selectExpr(f"'{name}' as params", "id", f"{rule} as cluster")
        labels = one if labels is None else labels.unionByName(one)
    got = {r.params: r for r in CL.search_scores(rows, labels, ["x", "y", "z"]).collect()}
    assert set(got) == {"a", "b", "c"}
    for name in got:
        each = rows.join(labels.where(F.col("params") == name), "id").where("cluster >= 0")
        want = CL.silhouette(each, ["x", "y", "z"], "cluster").first().silhouette
        ch = CL.calinski_harabasz(each, ["x", "y", "z"], "cluster").first().calinski_harabasz
        assert got[name].silhouette == pytest.approx(want) and got[name].calinski_harabasz == pytest.approx(ch)


def test_search_scores_multiply_matrices(spark, blobs, monkeypatch):
    """No expression per row and cluster: one product per task, in several lots of settings."""
    rows = blobs[0].select(F.xxhash64("x", "y", "z").alias("id"), "x", "y", "z").dropDuplicates(["id"])
    labels = rows.select(F.explode(F.sequence(F.lit(2), F.lit(5))).alias("k"), "id").select(
        F.concat(F.lit("k="), F.col("k")).alias("params"), "id", F.pmod("id", "k").cast("int").alias("cluster"))
    once = CL.search_scores(rows, labels, ["x", "y", "z"])
    assert "MapInArrow" in once._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(CL, "BROADCAST_SUMS", 7 * 8 * 6)  # 7 clusters a lot
    lots = {r.params: r.silhouette for r in CL.search_scores(rows, labels, ["x", "y", "z"]).collect()}
    assert CL._batched({"a": 3, "b": 4, "c": 9, "d": 1}, 7) == [["a", "b"], ["c"], ["d"]]
    assert lots == {r.params: pytest.approx(r.silhouette) for r in once.collect()} and len(lots) == 4


def test_kmeans_passes_read_packed_blocks(spark, blobs):
    df = blobs[0]
    packed = CL._packed(df, ["x", "y", "z"])
    assert packed.dtypes == [("x", "binary")]
    got = sorted(tuple(v) for r in packed.collect() for v in np.frombuffer(r.x).reshape(-1, 3))
    assert got == sorted((r.x, r.y, r.z) for r in df.collect())
    runs = [np.array(got[:2]), np.array(got[2:4]), np.array(got[4:7])]  # sizes 2, 2 and 3
    x = np.array(got)
    for (n, s, q), c in zip(CL._lloyd(packed, 3, runs), runs):
        far = ((x[:, None] - c[None]) ** 2).sum(-1)
        at = far.argmin(1)
        assert q == pytest.approx(far.min(1).sum()) and list(n) == [(at == k).sum() for k in range(len(c))]
        assert np.allclose(s, [x[at == k].sum(0) for k in range(len(c))])


def test_all_restarts_in_the_same_passes(spark, blobs):
    """Costs equal Lloyd's in numpy from the same starts, and the best one is kept."""
    df = blobs[0]
    feats = ["x", "y", "z"]
    x = np.array([[r.x, r.y, r.z] for r in df.collect()])
    best = CL.kmeans_many(df, feats, [2, 3, 5], 4, 7)
    for k, (centres, cost) in best.items():
        far = ((x[:, None] - centres[None]) ** 2).sum(-1)
        assert cost == pytest.approx(far.min(1).sum(), rel=1e-6)
        at = far.argmin(1)
        for c in range(k):
            assert np.allclose(centres[c], x[at == c].mean(0), atol=1e-4)
        got = [r.c for r in CL.assigned(df, feats, centres, "c").collect()]
        assert sorted(np.bincount(got)) == sorted(np.bincount(at))
    assert best[5][1] < best[3][1] < best[2][1]
    assert CL.kmeans_many(df.where("false"), feats, [2], 2)[2][1] == 0.0


def test_fold_statistics_equal_single_fits(spark):
    """Ridge and elastic net with missing values, a constant and an empty feature: metrics of
    every fold equal numpy's on the side's own medians and scaling."""
    rng = np.random.default_rng(4)
    n, feats = 240, list("abcde")
    x = rng.normal(size=(n, 5)) * [1, 50, 0.01, 1, 1] + [0, 1e6, 3, 0, 0]
    x[:, 3] = 7.0
    x[rng.random((n, 5)) < 0.2] = np.nan
    x[:, 4] = np.nan
    y = np.nan_to_num(x[:, 0]) * 2 - np.nan_to_num(x[:, 1] - 1e6) / 30 + rng.normal(size=n)
    fold = np.arange(n) % 4
    rows = [(int(fold[i]) + 2000, *[None if np.isnan(v) else float(v) for v in x[i]], float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "year int, a double, b double, c double, d double, e double, y double").repartition(3)
    specs = [ML.ridge(a) for a in (0.01, 1.0, 100.0)] + [ML.elastic_net(0.05, 0.5), ML.elastic_net(0.5, 0.9)]
    got = ML.cross_validated(specs, df, feats, "y", "year")
    for f in range(4):
        tr, te = fold != f, fold == f
        med = np.nanmedian(x[tr][:, :4], 0)
        xt, xe = (np.where(np.isnan(v[:, :4]), med, v[:, :4]) for v in (x[tr], x[te]))
        mu, sd = xt.mean(0), np.where(xt.std(0) < 1e-12, 1.0, xt.std(0))
        zt, ze = (xt - mu) / sd, (xe - mu) / sd
        for k, s in enumerate(specs):
            if s.kind == "ridge":
                w = np.linalg.solve(zt.T @ zt + s.params["alpha"] * np.eye(4), zt.T @ (y[tr] - y[tr].mean()))
            else:
                keep = [0, 1, 2]
                w = np.zeros(4)
                w[keep] = _cd(zt[:, keep], y[tr], s.params["alpha"], s.params["l1_ratio"])
            off = y[te] - ze @ w - y[tr].mean()
            r = got[k][f]
            assert r["fold"] == str(2000 + f) and r["n"] == te.sum()
            assert r["rmse"] == pytest.approx(np.sqrt((off ** 2).mean()), rel=1e-8)
            assert r["mae"] == pytest.approx(np.abs(off).mean(), rel=1e-8)
            assert r["r2"] == pytest.approx(1 - (off ** 2).sum() / ((y[te] - y[te].mean()) ** 2).sum(), rel=1e-8)
    one = ML.cross_validated(specs[:1], df.where("year = 2000"), feats, "y", "year")[0]
    assert [r["rmse"] for r in one] == [None]


def test_predictions_follow_each_other_on_one_frame(spark, reg_data):
    df, X, y = reg_data
    feats, out = list("abcd"), df
    for name, spec in [("m", ML.mean_spec()), ("l", ML.ridge(1e-9)), ("t", ML.random_forest(10, "sqrt", 1, max_depth=4))]:
        out = ML.fit(spec, df, feats, "y").predict(out, f"p_{name}")
    assert out.columns == [*df.columns, "p_m", "p_l", "p_t"]
    rows = out.orderBy("id").collect()
    w = np.linalg.lstsq(np.c_[X, np.ones(len(X))], y, rcond=None)[0]
    assert np.allclose([r.p_l for r in rows], np.c_[X, np.ones(len(X))] @ w, atol=1e-6)
    assert [r.a for r in rows] == X[:, 0].tolist()
    cv = ML.cross_validated([ML.mean_spec(), ML.random_forest(5, "sqrt", 1, max_depth=3), ML.ridge(1.0)], df, feats, "y", "year")
    assert [len(c) for c in cv] == [5, 5, 5] and cv[2][0]["rmse"] < cv[0][0]["rmse"]


def test_the_panel_is_built_once_per_query(spark, monkeypatch):
    """Of a panel read from files, only the first stored frame of a query reads the files."""
    from panelspark.plans import q_ml, unsupervised
    panel = q_ml._enriched(spark, SF_SMALL)
    reads = []

    def cut(df, real=q_ml.cut_lineage):
        reads.append(bool(df.inputFiles()))
        return real(df)

    monkeypatch.setattr(q_ml, "_enriched", lambda *a: panel)
    monkeypatch.setattr(q_ml, "cut_lineage", cut)
    q_ml.prepared(spark, SF_SMALL)
    assert reads == [True, False, False]
    learned = []
    fit = unsupervised.MedianImputer.fit
    monkeypatch.setattr(unsupervised.MedianImputer, "fit", lambda self, df: learned.append(df.inputFiles()) or fit(self, df))
    unsupervised.cross_section(panel)
    assert learned == [[]]


def test_a_search_reads_its_rows_once_for_all_settings(spark, blobs):
    """Labels of all sets of centres, and scores of two sets of features, come from matrices."""
    df = blobs[0].select(F.xxhash64("x", "y", "z").alias("id"), "x", "y", "z").dropDuplicates(["id"])
    sets = [np.array([[0.0, 0, 0], [0, 0, 0], [5, 5, 5]]), np.array([[1.0, 2, 3], [4, 4, 4]])]
    labels = CL.assigned_all(df, ["x", "y", "z"], sets).cache()
    assert "MapInArrow" in labels._jdf.queryExecution().executedPlan().toString()
    got = {r.id: list(r.labels) for r in labels.collect()}
    for k, centres in enumerate(sets):
        assert {r.id: r.c for r in CL.assigned(df, ["x", "y", "z"], centres, "c").collect()} == {i: v[k] for i, v in got.items()}
    labels = labels.select("id", F.concat("labels", F.array(F.when(F.pmod("id", F.lit(3)) > 0, F.lit(-1)).otherwise(0))).alias("labels"))
    scores = CL.GridScores(df, labels, [["x", "y"], ["x", "y", "z"]], 3)
    counts = {r._setting: r for r in scores.counts().collect()}
    away = sum(i % 3 > 0 for i in got) / len(got)
    assert [counts[k].clusters for k in range(3)] == [len({v[0] for v in got.values()}), len({v[1] for v in got.values()}), 1]
    assert [counts[k].noise_pct for k in range(3)] == [0.0, 0.0, pytest.approx(away)]
    found = {r._setting: r for r in scores.silhouettes().collect()}
    for k in range(2):
        each = df.join(labels.select("id", F.col("labels")[k].alias("c")), "id")
        for f, feats in enumerate((["x", "y"], ["x", "y", "z"])):
            assert found[k][f"silhouette{f}"] == pytest.approx(CL.silhouette(each, feats, "c").first().silhouette)
    assert found[2].silhouette0 is None
