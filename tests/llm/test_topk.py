import math

import numpy as np
import pytest

from panelspark.llm import topk


def brute(rows, every=50, k=5):
    good = []
    for r, (i, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            good.append((r, i, [math.floor(256 * c) for c in v]))
    out = []
    for r, i, v in good:
        if i is not None and i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for s, j, w in good if s != r]
            out += [(i, n, None if none else j, -s) for n, (s, none, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def vectors(seed, n, dims=8, scale=0.2):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, scale, (6, dims))
    rows = [(k, (centre[k % 6] + rng.normal(0, scale / 4, dims)).tolist()) for k in range(n)]
    return rows


def check(spark, rows, path, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, row int")
    df.repartition(4).write.parquet(path)
    got = sorted(map(tuple, topk.top_k(spark.read.parquet(path), **options).collect()), key=str)
    assert got == brute(rows, options.get("every", 50), options.get("k", 5))
    return got


@pytest.mark.parametrize("options", [{}, {"segment": 40, "summaries": 3}, {"segment": 100, "k": 1}])
def test_equal_brute_force(spark, tmpdir_fresh, options):
    check(spark, vectors(1, 700), f"{tmpdir_fresh}/v", every=7, **options)


def test_ties_copies_nulls_and_odd_vectors(spark, tmpdir_fresh):
    rows = vectors(2, 60) + [(1000 + k, [0.3] * 8) for k in range(300)] + [
        (50, [0.3] * 8), (50, [0.3] * 8), (None, [0.3] * 8), (None, [9.0] * 8), (7, None), (8, [0.1, None] * 4),
        (9, [float("nan")] * 8), (10, [float("inf")] * 8), (100, []), (11, [0.5, -0.5]), (150, [1e6] * 8), (200, [0.0] * 8)]
    check(spark, rows, f"{tmpdir_fresh}/a", segment=50)
    check(spark, vectors(3, 3), f"{tmpdir_fresh}/b")
    df = spark.read.parquet(f"{tmpdir_fresh}/a")
    assert topk.top_k(df.where("false")).collect() == []


def test_blocks_are_pruned():
    """Rows in groups far apart: a query scores only a part of the blocks, and nothing is lost."""
    rng = np.random.default_rng(4)
    centre = np.eye(16) * 300
    x = np.concatenate([centre[k % 16] + rng.integers(-9, 9, (1, 16)) for k in range(4096)]).astype(np.int64)
    s = topk.Segment(0, np.arange(4096), np.arange(4096), np.ones(4096, bool), x)
    bounds = np.maximum(s.matrix[:1], 0) @ s.high.T.astype(int) + np.minimum(s.matrix[:1], 0) @ s.low.T.astype(int)
    (at, score), = s.search(s.matrix[:1], s.rows[:1], [None], [None], 5)
    whole = np.sort(s.matrix[1:].astype(int) @ s.matrix[0].astype(int))[::-1][:5]
    assert sorted(score.astype(int), reverse=True) == whole.tolist()
    assert (bounds[0] >= whole[-1]).mean() < 0.2


def test_scores_beyond_64_bits_raise():
    with pytest.raises(OverflowError):
        topk.arithmetic(np.array([[2 ** 40]]), np.array([[2 ** 40]]))
