import math
from collections import defaultdict

import numpy as np
import pytest

from panelspark.llm import whitening


def brute(rows, components=16):
    xs = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in xs})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[(n * c - s) / n for c, s in zip(x, total)] for x in fit])
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = defaultdict(list)
    for i, x in xs:
        off = [n * c - s for c, s in zip(x, total)]
        w = (np.array(off, float) / n) @ u[:, :components] / np.sqrt(np.maximum(e[:components], 1e-300))
        out[i].append((n, sum(o * o for o in off), w))
    return out, e / np.trace(v)


def check(spark, rows, parts):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, component int, n string")
    got = defaultdict(dict)
    want, share = brute(rows)
    out = whitening.whiten(df.repartition(3)).collect()
    assert len(out) == parts * sum(map(len, want.values()))
    for r in out:
        got[r["vec_id"]].setdefault(r["component"], []).append(r)
        assert r["identity_error"] <= 1e-4 and abs(r["explained"] - share[r["component"] - 1]) < 1e-9
    sign = {}
    for i, expected in want.items():
        for c in range(1, parts + 1):
            for r in got[i][c]:
                n, deviation, w = expected[0]
                assert (r["n"], r["deviation"]) == (n, deviation)
                if c not in sign and abs(w[c - 1]) > 0.3:
                    sign[c] = np.sign(w[c - 1] * r["whitened"])
                assert abs(abs(r["whitened"]) - abs(w[c - 1])) < 1e-8
                if c in sign and abs(w[c - 1]) > 1e-6:
                    assert sign[c] == np.sign(w[c - 1] * r["whitened"])
    return got


def test_equal_to_eigenvectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (300, 24)) @ rng.normal(0, 1, (24, 24)) * 0.2
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(k, x[0].tolist()) for k in range(400, 900)]  # copies count once in the fit
    rows += [(5, x[5].tolist()), (None, x[7].tolist()), (901, None), (902, [None] * 24), (903, [float("nan")] * 24),
             (904, [float("inf")] * 24)]
    check(spark, rows, 16)


def test_few_dimensions_and_missing_variance(spark):
    rng = np.random.default_rng(2)
    xs = (np.round(rng.normal(0, 1, (50, 2)) * 64) / 64).tolist()
    rows = [(k, [a, 2 * a, b]) for k, (a, b) in enumerate(xs)]
    check(spark, rows, 2)  # the second dimension is twice the first


def test_other_lengths_equal_vectors_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    mixed = [(k, [float(k % 5), float(k % 3)]) for k in range(30)] + [(99, [1.0]), (98, []), (97, [1.0] * 3)]
    got = whitening.whiten(spark.createDataFrame(mixed, schema)).collect()
    assert {r["vec_id"] for r in got} == set(range(30)) and {r["component"] for r in got} == {1, 2}
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], schema)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same.where("false")).collect() == []


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 30), np.r_[np.ones(10), np.full(10, 2.0), 5.0], np.geomspace(1e-8, 1, 40),
    np.r_[1.0, 1.0 + 1e-9, 1.0 + 2e-9, 3.0], np.zeros(6), np.ones(7), np.r_[0.0, 0, 0, 4.0], np.array([3.0])])
def test_spectrum_of_known_matrices(values):
    """Spread, repeated, graded and nearly equal eigenvalues."""
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(0, 1, (len(values), len(values))))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.refined(a, whitening.spectrum(a)[1])
    size = max(np.abs(values).max(), 1e-300)
    assert np.allclose(e, np.sort(values)[::-1], atol=1e-13 * size, rtol=0)
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ v - v * e).max() < 1e-13 * size


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(0, 1, (20, 20)))
    values = np.r_[np.geomspace(1e-12, 1, 12), -np.geomspace(1e-9, 2, 8)]
    u = whitening.polar((q * values) @ q.T)
    assert np.abs(u - (q * np.sign(values)) @ q.T).max() < 1e-3  # the smallest are near rounding
    assert np.abs(u @ u - np.eye(20)).max() < 1e-12
