from collections import defaultdict

import numpy as np
import pytest

from panelspark.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3.0):
    """Share by weight, cap at ``most`` times the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: most * sizes[s] for s in over})


def sizes_of(docs):
    return [len((r["text"] or "").split()) for r in docs.collect()]


def test_targets_sizes_and_limits(odd_docs):
    got = mixing.mix(odd_docs).collect()
    per = defaultdict(int)
    for r in odd_docs.collect():
        per[r["source"]] += len([w for w in (r["text"] or "").split()])
    want = brute_targets(per)
    assert sorted(r["size"] for r in got) == sorted(sizes_of(odd_docs))
    totals = {(r["source_size"], round(r["target"], 6)) for r in got}
    assert totals == {(per[s], round(want[s], 6)) for s in per}
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["times"] for r in got)


def many(spark, n=4000):
    rng = np.random.default_rng(2)
    rows = [(k, "w " * int(rng.integers(1, 80)), "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = many(spark)
    got = mixing.mix(docs, block=100).collect()
    taken, target, times = defaultdict(int), {}, defaultdict(list)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        times[source[r["doc_id"]]].append(r["times"])
    for s in target:
        assert abs(taken[s] - target[s]) <= 80  # one document
        assert max(times[s]) - min(times[s]) <= 1
        assert abs(np.mean(times[s]) - target[s] / sum(
            r["size"] for r in got if source[r["doc_id"]] == s)) < 3 / len(times[s]) + 1e-6  # documents balance too
    again = mixing.mix(docs.repartition(3), block=100).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_flight_keeps_sums_and_is_unbiased():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 60).astype(float)
    seen = np.zeros(60)
    for k in range(300):
        p = np.full(60, 0.3)
        out = mixing.flight(p, size, np.random.default_rng(k))
        assert abs(out.sum() - 18) < 1e-6 and abs(out @ size - 0.3 * size.sum()) < 1e-6
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
        seen += mixing.landing(out, size)
    assert abs(seen / 300 - 0.3).max() < 0.15


def test_repeated_takes_each_row_its_times(spark, odd_docs, tmpdir_fresh):
    """Columns named as the operator's own stay as they are."""
    clash = ["row_", "id_", "h_", "k_", "i2_", "times_", "times", "again", "h", "k"]
    for c in clash:
        odd_docs = odd_docs.selectExpr("*", f"'{c}' as {c}")
    odd_docs.write.parquet(f"{tmpdir_fresh}/d")
    docs = spark.read.parquet(f"{tmpdir_fresh}/d")
    want = sum(r["times"] for r in mixing.mix(docs).collect())
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == want and all(r[c] == c for r in rows for c in clash)


def test_equal_rows_are_dealt_over_blocks(spark):
    """Thousands of equal rows of one source: blocks stay bounded, targets are met."""
    rows = [(1, "a b c", "s1")] * 3000 + [(k, "w " * (k % 50 + 1), "s2") for k in range(2, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    part = mixing.ordinals(docs.selectExpr("1L as h", "spark_partition_id() as part",
                                           "monotonically_increasing_id() as row").where("h = 1"))
    ks = [r["k"] for r in part.collect()]
    assert sorted(ks) == list(range(len(rows)))
    got = mixing.mix(docs, block=200)
    for r in got.groupBy("source_size", "target").agg({"taken": "sum"}).collect():
        assert abs(r["sum(taken)"] - r["target"]) < 0.005 * r["target"]


def test_landing_is_the_best_choice():
    rng = np.random.default_rng(4)
    p, size = rng.random(9), rng.integers(1, 90, 9)
    z = mixing.landing(p, size)
    best = min(abs(sum((k >> j & 1) * size[j] for j in range(9)) - p @ size) for k in range(512))
    assert set(z) <= {0.0, 1.0} and abs(abs(z @ size - p @ size) - best) < 1e-6


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).collect() == []
