"""Rank-selected quantiles against numpy, and their plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import quantiles as Q


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, f int, a double, b double, c long")


def data(n=3000):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(n):
        a = None if k % 11 == 0 else float(rng.lognormal(0, 4))  # heavy tail: most in one bin
        b = float(rng.integers(0, 4)) if k % 3 else 2.0  # ties
        rows.append((None if k % 50 == 0 else f"g{k % 3 * (k % 5 > 0)}", k % 4, a, b, int(rng.integers(-10 ** 15, 10 ** 15))))
    return rows


PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def check(got, values):
    values = np.array([v for v in values if v is not None], float)
    assert got.n == len(values)
    assert np.allclose(got.q, np.quantile(values, PROBS), rtol=1e-12, atol=0)


def test_whole_groups_and_sides(spark):
    rows = data()
    df = frame(spark, rows).repartition(5)
    for r in Q.quantiles(df, ["a", "b", "c"], PROBS).collect():
        check(r, [x["gfabc".index(r["column"])] for x in rows])
    got = Q.quantiles(df, ["a", "b"], PROBS, by=["g"]).collect()
    assert {r.g for r in got} == {x[0] for x in rows} and len(got) == 2 * len({x[0] for x in rows})
    for r in got:
        check(r, [x["gfabc".index(r["column"])] for x in rows if x[0] == r.g])
    got = Q.quantiles(df, ["a", "c"], PROBS, without="f").collect()
    assert len(got) == 8
    for r in got:
        check(r, [x["gfabc".index(r["column"])] for x in rows if x[1] != r.side])


def test_odd_values(spark):
    df = frame(spark, [("x", 0, float("inf"), float("nan"), None), ("x", 1, 1.0, 2.0, None), ("x", 2, float("-inf"), None, None)])
    got = {r["column"]: r for r in Q.quantiles(df, ["a", "b", "c"], [0.0, 0.5]).collect()}
    assert got["a"].q == [float("-inf"), 1.0] and got["b"].q[0] == 2.0 and np.isnan(got["b"].q[1]) and "c" not in got
    assert Q.quantiles(df.where("false"), ["a"], [0.5]).collect() == []
    one = Q.wide(Q.quantiles(df, ["b", "c"], [0.0]), ["b", "c"]).first()
    assert (one.b, one.c) == (2.0, None)


def test_no_value_maps_in_the_plan(spark):
    plan = Q.quantiles(frame(spark, data(50)), ["a"], [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median" not in plan


@pytest.mark.parametrize("p", [0.5])
def test_equals_sparks_median(spark, p):
    df = frame(spark, data(999))
    want = df.agg(*[F.median(c).alias(c) for c in "abc"]).first()
    got = Q.wide(Q.quantiles(df, list("abc"), [p]), list("abc")).first()
    assert all(got[c] == pytest.approx(want[c], rel=1e-14) for c in "abc")
