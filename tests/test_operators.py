"""Table operators: windows, joins, reshape, aggregates, chart data, ANOVA."""

import math

import pytest
from pyspark.sql import functions as F

from panelspark.operators import aggregates as ag
from panelspark.operators import charts as CH
from panelspark.operators import clean as C
from panelspark.operators import joins as J
from panelspark.operators import reshape as RS
from panelspark.operators import stats as ST
from panelspark.operators import windows as W


def test_lead_and_consecutive(spark):
    df = spark.createDataFrame([("a", 2019, 1.0), ("a", 2020, 2.0), ("a", 2022, 3.0),
                                ("b", 2021, 5.0)], "g string, year int, v double")
    out = W.consecutive_only(W.lead_target(df, "g", "year", {"year": "next_year", "v": "next_v"}))
    assert [(r.g, r.year, r.next_v) for r in out.collect()] == [("a", 2019, 2.0)]


def test_top_n_and_first(spark):
    df = spark.createDataFrame([("x", 1, 3.0), ("x", 2, None), ("x", 3, 3.0), ("y", 4, 1.0)],
                               "g string, id int, v double")
    top = W.top_n_per_group(df, ["g"], [("v", False), ("id", True)], 2).orderBy("g", "id")
    assert [(r.g, r.id) for r in top.collect()] == [("x", 1), ("x", 3), ("y", 4)]
    srt = W.sort(df, [("v", True), ("id", True)])
    assert [r.id for r in srt.collect()][-1] == 2  # missing last


def test_zscore_zero_std(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 3.0)], "g string, v double")
    z = {(r.g, r.v): r.v_z for r in W.zscore_within(df, ["g"], "v").collect()}
    assert z[("a", 1.0)] == 0.0 and z[("b", 3.0)] == 1.0


def test_outer_merge_and_clipped(spark):
    a = spark.createDataFrame([("1", 1.0)], "geoid string, x double")
    b = spark.createDataFrame([("2", 2.0)], "geoid string, y double")
    m = J.outer_merge([a, b], "geoid")
    assert sorted(r.geoid for r in m.collect()) == ["1", "2"]
    keys = spark.createDataFrame([("1", 2019), ("1", 2024)], "geoid string, year int")
    f = spark.createDataFrame([("1", 2021, 0.5), ("1", 2023, 0.7)], "geoid string, source_year int, p double")
    got = {r.year: (r.source_year, r.p) for r in J.join_clipped_period(keys, f, 2021, 2023).collect()}
    assert got == {2019: (2021, 0.5), 2024: (2023, 0.7)}


def test_null_safe_pair_join(spark):
    l = spark.createDataFrame([("s", None, 1)], "state string, county string, v int")
    r = spark.createDataFrame([("s", None, "P")], "st string, co string, g string")
    strict = J.join_on_pairs(l, r, [("state", "st"), ("county", "co")]).first()
    safe = J.join_on_pairs(l, r, [("state", "st"), ("county", "co")], null_safe=True).first()
    assert strict.g is None and safe.g == "P"


def test_grid_and_attach(spark):
    e = spark.createDataFrame([("1",), ("2",)], "geoid string")
    assert J.grid(e, [2019, 2020]).count() == 4
    p = spark.createDataFrame([("1", 3.0)], "geoid string, prediction double")
    st = {r.geoid: r.status for r in J.attach_predictions(e, p, "geoid").collect()}
    assert st == {"1": "Predicted", "2": "No prediction"}


def test_union_loose_melt_widen(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, a double")
    b = spark.createDataFrame([(2, "x")], "k int, b string")
    u = RS.union_loose([a, b]).orderBy("k").collect()
    assert u[0].b is None and u[1].a is None
    m = RS.melt(a, ["k"], ["a"])
    assert [(r.variable, r.value) for r in m.collect()] == [("a", 2.0)]
    long = spark.createDataFrame([(1, "m1", 1.0), (1, "m2", 2.0)], "k int, model string, p double")
    w = RS.widen(long, ["k"], "model", "p", ["m1", "m2", "m3"], "pred_").first()
    assert (w.pred_m1, w.pred_m2, w.pred_m3) == (1.0, 2.0, None)


def test_aggregates_pandas_semantics(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (1, 10.0), (2, 5.0)], "g int, v double")
    r = df.groupBy("g").agg(*ag.exposure_stats(df, ["g"], "v", "x_")).orderBy("g").collect()
    assert r[0].x_median == 2.5 and math.isclose(r[0].x_p90, 7.9)  # linear interpolation
    assert r[1].x_std is None  # one observation
    dup = ag.count_duplicates(spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int"), ["k"]).first()
    assert (dup.duplicate_rows, dup.duplicated_keys) == (2, 1)
    vc = {r.k: r.share for r in ag.value_counts(spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), "k").collect()}
    assert vc == {1: 2 / 3, 2: 1 / 3}


def test_crosstab_explicit_values(spark):
    df = spark.createDataFrame([("a", "Good"), ("a", None), ("a", "Good")], "g string, c string")
    r = ag.crosstab_counts(df, ["g"], "c", ["Good", "Hazardous"], "n_").first()
    assert (r.n_Good, r.n_Hazardous) == (2, 0)


def test_profile_and_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (3.0, None)], "v double, s string")
    p = {r.feature: r for r in ag.profile_columns(df).collect()}
    assert p["v"].missing == 1 and p["s"].n_distinct == 1 and p["v"].dtype == "double"
    d = ag.describe(df, ["v"]).first()
    assert (d["count"], d["missing"], d["p50"]) == (2.0, 1.0, 2.0)


def test_histogram_last_bin_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "v double")
    h = CH.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 1, 0, 0, 1]  # numpy.histogram edges
    assert h[-1].upper == 10.0


def test_box_and_line(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(1, 11)] + [(100.0, 0.0)],
                               "x double, y double")
    b = CH.box_stats(df, "x").first()
    assert b.outliers == 1 and b.whisker_high == 10.0
    line = CH.fit_line(df.where("x < 50"), "x", "y").first()
    assert math.isclose(line.slope, 2.0) and math.isclose(line.intercept, 1.0)


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(200)], "v double")
    d = sorted((r.x, r.density) for r in CH.density(df, "v", 400).collect())
    area = sum((d[i + 1][0] - d[i][0]) * (d[i][1] + d[i + 1][1]) / 2 for i in range(len(d) - 1))
    assert abs(area - 1.0) < 0.01


def test_anova_known_values(spark):
    rows = [(g, v) for g, vals in {0: [1.0, 2.0, 3.0], 1: [4.0, 5.0, 6.0], -1: [100.0]}.items()
            for v in vals]
    r = ST.anova(spark.createDataFrame(rows, "g int, v double"), "v", "g").first()
    assert r.groups == 2 and math.isclose(r.f_stat, 13.5)
    assert math.isclose(r.p_value, 0.021311641128756727, rel_tol=1e-9)
    one = ST.anova(spark.createDataFrame([(0, 1.0), (0, 2.0)], "g int, v double"), "v", "g").first()
    assert one.f_stat is None and one.p_value is None


def test_f_tail_known_values(spark):
    # published ANOVA rows: F 8.6341 → p 0.0033, F 3.6457 → p 0.0563
    rows = [(8.6341, 1.0, 2810.0, 0.0033), (3.6457, 1.0, 2749.0, 0.0563), (0.0, 3.0, 5.0, 1.0), (float("inf"), 3.0, 5.0, 0.0),
            (1.0, 7.0, 7.0, 0.5), (2.0, 2.0, 10.0, (1 + 2 * 2 / 10) ** -5), (None, 1.0, 1.0, None),
            (1.0, 0.0, 4.0, None), (3.0, 1.0, 1.0, 1 - 2 / math.pi * math.atan(3 ** 0.5))]
    got = spark.createDataFrame(rows, "f double, a double, b double, want double").select(
        "want", ST.f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect()
    assert all(r.p is None if r.want is None else abs(r.p - r.want) < 6e-5 for r in got)
    exact = [(k, 4.0, 2.0 * k + 1) for k in range(1, 60, 7)]
    for r in spark.createDataFrame([(float(f), a, b) for f, a, b in exact], "f double, a double, b double").select(
            "*", ST.f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect():
        x, a = r.b / (r.b + r.a * r.f), r.b / 2
        assert math.isclose(r.p, x ** a * (1 + a * (1 - x)), rel_tol=1e-11)  # closed form for 4 degrees


def test_clean_table_helpers(spark):
    df = spark.createDataFrame([("MHLTH", 1.0, -666666666.0), ("x", 2.0, 3.0)],
                               "MeasureId string, a double, b double")
    assert C.filter_measure(df, "mhlth", ["measureid", "MeasureId"]).count() == 1
    assert [r.b for r in C.null_sentinels(df).collect()] == [None, 3.0]
    assert C.normalise_columns(df).columns == ["measureid", "a", "b"]
    assert C.numeric_columns(df, ["b"]) == ["a"]
    assert C.filter_in(df, "MeasureId", ["x"], negate=True).count() == 1
    with pytest.raises(ValueError):
        C.filter_measure(df, "m", ["nope"])


def test_crosstab_raises_on_a_value_not_listed(spark):
    from panelspark.operators.aggregates import crosstab_counts
    df = spark.createDataFrame([(1, "x"), (1, None), (1, "z")], "k int, c string")
    assert crosstab_counts(df, ["k"], "c", ["x", "z"], "n_").collect()[0].n_z == 1
    with pytest.raises(Exception, match="not listed"):
        crosstab_counts(df, ["k"], "c", ["x"], "n_").collect()
