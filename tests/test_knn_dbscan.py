"""kNN imputation and DBSCAN against brute-force NumPy implementations."""

import math

import numpy as np
import pytest

from panelspark.operators.components import connected_components
from panelspark.operators import dbscan as DB
from panelspark.operators.dbscan import dbscan, dbscan_many, eps_degree
from panelspark.operators.knn import knn_impute


def _hav(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return 2 * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def brute_knn(rows, k):
    out = {}
    for year in {r[1] for r in rows}:
        obs = [r for r in rows if r[1] == year and r[4] is not None and r[5] is not None]
        miss = [r for r in rows if r[1] == year and r[4] is None and r[5] is None]
        for m in miss:
            if not obs:
                continue
            d = [(_hav(m[2], m[3], o[2], o[3]), f"{o[0]}|{o[1]}", o) for o in obs]
            d.sort(key=lambda t: (t[0], t[1]))
            top = d[:k]
            zero = [t for t in top if t[0] == 0]
            if zero:
                vals = [np.mean([t[2][4] for t in zero]), np.mean([t[2][5] for t in zero])]
            else:
                w = np.array([1 / t[0] for t in top])
                vals = [float(np.sum(w * np.array([t[2][c] for t in top])) / w.sum()) for c in (4, 5)]
            out[(m[0], m[1])] = vals
    return out


@pytest.mark.parametrize("seed,n", [(1, 300), (2, 120)])
def test_knn_matches_brute_force(spark, seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        year = 2019 + i % 3
        lat = float(rng.uniform(20, 60)) if i % 17 else 45.0  # some co-located points
        lon = float(rng.uniform(-170, 179)) if i % 17 else -100.0
        full = rng.random() > 0.35
        a = float(rng.normal(50, 10)) if full else None
        b = float(rng.normal(5, 1)) if full else None
        if i % 23 == 0:  # partly missing rows stay untouched
            a, b = float(rng.normal(50, 10)), None
        rows.append((f"{i:05d}", year, lat, lon, a, b))
    rows.append(("99999", 2030, 10.0, 10.0, None, None))  # period with nothing observed
    df = spark.createDataFrame(rows, "geoid string, year int, lat double, lon double, a double, b double")
    got = {(r.geoid, r.year): (r.a, r.b, r.imputed)
           for r in knn_impute(df, ["a", "b"], k=5, lat="lat", lon="lon").collect()}
    want = brute_knn(rows, 5)
    for r in rows:
        g = got[(r[0], r[1])]
        if (r[0], r[1]) in want:
            assert g[2] is True
            assert math.isclose(g[0], want[(r[0], r[1])][0], rel_tol=1e-9)
            assert math.isclose(g[1], want[(r[0], r[1])][1], rel_tol=1e-9)
        else:
            assert g[2] is False and g[0] == r[4] and g[1] == r[5]


def brute_dbscan(pts, eps, m):
    """scikit-learn's visiting order: index order, BFS expansion."""
    n = len(pts)
    xy = np.array([(p[1], p[2]) for p in pts])
    d2 = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1)
    nb = [np.where(d2[i] <= eps * eps)[0] for i in range(n)]
    core = np.array([len(x) >= m for x in nb])
    labels = -np.ones(n, dtype=int)
    lab = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = lab
        while stack:
            u = stack.pop()
            for v in nb[u]:
                if labels[v] == -1:
                    labels[v] = lab
                    if core[v]:
                        stack.append(v)
        lab += 1
    return {pts[i][0]: (int(labels[i]), bool(core[i])) for i in range(n)}, [len(x) for x in nb]


def _blobs(seed):
    rng = np.random.default_rng(seed)
    pts = []
    centres = [(0, 0), (1, 1), (0.2, 1.4)]
    i = 0
    for cx, cy in centres:
        for _ in range(70):
            pts.append((i, float(rng.normal(cx, 0.08)), float(rng.normal(cy, 0.08))))
            i += 1
    for _ in range(40):  # dense clump of co-located points
        pts.append((i, 0.5, 0.5))
        i += 1
    for _ in range(30):
        pts.append((i, float(rng.uniform(-1, 2)), float(rng.uniform(-1, 2))))
        i += 1
    order = rng.permutation(len(pts))  # ids not in spatial order
    return [(int(order[k]), p[1], p[2]) for k, p in enumerate(pts)]


@pytest.mark.parametrize("eps,m", [(0.05, 5), (0.1, 10), (0.3, 20)])
def test_dbscan_matches_brute_force(spark, eps, m):
    pts = sorted(_blobs(3), key=lambda p: p[0])
    want, deg = brute_dbscan(pts, eps, m)
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r.id: (r.label, r.is_core) for r in dbscan(df, eps, m).collect()}
    assert got == want
    d = {r.id: r.degree for r in eps_degree(df, eps).collect()}
    assert [d[p[0]] for p in pts] == deg


def test_dbscan_many_settings_in_one_run(spark):
    pts = sorted(_blobs(5), key=lambda p: p[0])
    df = spark.createDataFrame(pts, "id long, x double, y double")
    epses, least = [0.03, 0.08, 0.15, 0.4, 1.5], [2, 5, 20, 41]
    got = {}
    for r in dbscan_many(df, epses, least).collect():
        got.setdefault((r.eps, r.min_samples), {})[r.id] = (r.label, r.is_core)
    assert set(got) == {(e, m) for e in epses for m in least}
    for (e, m), labels in got.items():
        assert labels == brute_dbscan(pts, e, m)[0], (e, m)


@pytest.mark.parametrize("gap,linked", [(0.9, True), (1.0, True), (1.02, False)])
def test_dbscan_two_dense_clumps_about_eps_apart(spark, gap, linked):
    """Thousands of points on each side: whether any two reach decides, without their pairs."""
    rng = np.random.default_rng(11)
    eps = 0.25
    a = np.c_[-rng.uniform(0, 0.2, 1500), rng.uniform(0, 0.2, 1500)]
    b = np.c_[gap * eps + rng.uniform(0, 0.2, 1500), rng.uniform(0, 0.2, 1500)]
    a[0], b[0] = (0.0, 0.1), (gap * eps, 0.1)  # the nearest pair
    a[1:, 0] -= 0.004
    b[1:, 0] += 0.004
    pts = [(k, float(x), float(y)) for k, (x, y) in enumerate(np.r_[a, b])]
    got = dbscan(spark.createDataFrame(pts, "id long, x double, y double"), eps, 5).collect()
    assert len({r.label for r in got}) == (1 if linked else 2) and all(r.is_core for r in got)


def test_components_chain_and_islands(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101)]
    nodes = sorted({x for e in edges for x in e} | {200})
    n = spark.createDataFrame([(x,) for x in nodes], "id long")
    e = spark.createDataFrame(edges, "src long, dst long")
    comp = {r.id: r.component for r in connected_components(n, e).collect()}
    assert all(comp[i] == 0 for i in range(41))
    assert comp[100] == comp[101] == comp[102] == 100 and comp[200] == 200
    alone = connected_components(n, e.where("src < 0"), "id")
    assert all(r.id == r.component for r in alone.collect())


def test_components_of_random_graphs_with_hubs(spark):
    """Stars around hubs, random trees and chains against union-find."""
    rng = np.random.default_rng(8)
    edges = [(int(rng.integers(0, 400)), int(rng.integers(0, 400))) for _ in range(150)]
    edges += [(500, k) for k in range(501, 900)] + [(899, 20), (950, 949), (949, 951), (5, 5)]
    up = list(range(1000))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    n = spark.range(1000)
    e = spark.createDataFrame(edges, "src long, dst long")
    comp = {r.id: r.component for r in connected_components(n, e).collect()}
    assert comp == {k: root(k) for k in range(1000)}


def test_hub_edges_do_not_meet_in_one_task(spark):
    """The join that follows the smallest-neighbour aggregate shuffles no hub."""
    from panelspark.operators.components import split_join
    rows = spark.range(4000).selectExpr("case when id < 3000 then 1 else id end as u", "id as v")
    least = rows.groupBy("u").agg({"v": "min", "*": "count"}).toDF("u", "m", "degree")
    got = split_join(rows, "u", least, 100)
    assert got.count() == 4000 and got.where("u = 1 and m = 0").count() == 3000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 2


def test_knn_rows_that_share_key_and_period(spark):
    """Two missing rows of one key and period each get all k neighbours."""
    rows = [("m", 2000, 0.0, 0.0, None), ("m", 2000, 0.0, 0.0, None), ("a", 2000, 0.0, 1.0, 0.0), ("b", 2000, 0.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "geoid string, year int, lat double, lon double, v double")
    got = [r.v for r in knn_impute(df, ["v"], k=2).where("imputed").collect()]
    assert len(got) == 2 and all(abs(v - 1 / 3) < 1e-6 for v in got)


def test_knn_reaches_a_far_island(spark):
    rows = [("m", 2000, -60.0, -170.0, None)] + [(f"a{k}", 2000, 40.0 + k / 100, 10.0, float(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "geoid string, year int, lat double, lon double, v double")
    got = knn_impute(df, ["v"], k=3).where("imputed").collect()
    assert len(got) == 1 and 0 <= got[0].v <= 39


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Each round is several jobs and exchanges, which the driver pays for with threads."""
    from panelspark.operators import components
    cuts = []
    monkeypatch.setattr(components, "cut_lineage", lambda df: cuts.append(df) or df.checkpoint())
    e = spark.createDataFrame([(1, 2), (3, 1), (4, 1), (8, 9), (9, 8), (7, 7)], "src long, dst long")
    n = spark.range(10).select("id")
    comp = {r.id: r.component for r in components.connected_components(n, e).collect()}
    assert comp == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8}
    assert len(cuts) == 1
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "src long, dst long")
    assert {r.component for r in components.connected_components(spark.range(41), chain).collect()} == {0}
    assert len(cuts) < 12


def test_a_search_has_a_row_per_point(spark):
    """All settings' labels in one row, equal to the settings one by one."""
    rng = np.random.default_rng(12)
    made = [(k, float(a), float(b)) for k, (a, b) in enumerate(np.r_[rng.normal(0, 0.1, (60, 2)), rng.uniform(-1, 1, (60, 2))])]
    df = spark.createDataFrame(made, "id long, x double, y double")
    epses, least = [0.08, 0.2], [3, 6, 12]
    grid = DB.dbscan_grid(df, epses, least)
    assert grid.dtypes == [("id", "bigint"), ("labels", "array<int>")]
    got = {r.id: list(r.labels) for r in grid.collect()}
    assert len(got) == 120
    for k, (e, m) in enumerate((e, m) for e in epses for m in least):
        assert {i: v[k] for i, v in got.items()} == {r.id: r.label for r in dbscan(df, e, m).collect()}
