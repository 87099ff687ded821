"""Semantic traps of the scalar expressions."""

import math

from pyspark.sql import functions as F

from panelspark.functions import keys as K
from panelspark.functions import numbers as N
from panelspark.functions import rules as R
from panelspark.functions import text as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("o")).collect()]


def test_zfill_never_truncates(spark):
    out = one(spark, K.zfill("k", 5), [("1",), ("1234567",), (None,)], "k string")
    assert out == ["00001", "1234567", None]


def test_composite_and_right(spark):
    df = spark.createDataFrame([("1", "7", "0500000US01007")], "s string, c string, g string")
    r = df.select(K.composite_key(("s", 2), ("c", 3)).alias("a"), K.right_chars("g", 5).alias("b"),
                  K.starts_with("g", "0500000US").alias("p")).first()
    assert (r.a, r.b, r.p) == ("01007", "01007", True)
    assert one(spark, K.starts_with("g", "x"), [(None,)], "g string") == [False]


def test_lenient_numbers(spark):
    out = one(spark, N.to_number("v"), [("1.5",), ("x",), ("",), ("nan",), (None,)], "v string")
    assert out == [1.5, None, None, None, None]
    out = one(spark, N.parse_grouped_number("v"), [("12,345",), ("nan",)], "v string")
    assert out == [12345.0, None]


def test_sentinel_and_infinite(spark):
    assert one(spark, N.null_sentinel_col("v"), [(-666666666.0,), (5.0,), (None,)], "v double") \
        == [None, 5.0, None]
    assert one(spark, N.null_infinite_col("v"), [(float("inf"),), (-float("inf"),), (1.0,)],
               "v double") == [None, None, 1.0]


def test_share_zero_safe_and_sums(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (1.0, 4.0, 1.0)], "a double, b double, c double")
    r = df.select(N.share("a", "b").alias("s"), N.sum_cols(["a", "c"]).alias("l"),
                  N.sum_cols_strict(["a", "c"]).alias("t"), N.complement(N.share("a", "b")).alias("k")
                  ).collect()
    assert r[0].s is None and r[0].l == 1.0 and r[0].t is None and r[0].k is None
    assert r[1].s == 0.25 and r[1].l == 2.0 and r[1].t == 2.0 and r[1].k == 0.75


def test_clip_keeps_null_and_round_half_even(spark):
    assert one(spark, N.clip("v", 2021, 2023), [(2019,), (2025,), (2022,), (None,)], "v int") \
        == [2021, 2023, 2022, None]
    assert one(spark, N.round_half_even("v", 3), [(0.3125,), (0.3135,)], "v double") == [0.312, 0.314]


def test_flags(spark):
    assert one(spark, R.flag_over("v", 100), [(150.0,), (None,), (100.0,)], "v double") == \
        [True, False, False]
    assert one(spark, R.flag_in("c", ["Unhealthy"]), [("Unhealthy",), (None,)], "c string") == \
        [True, False]


def test_case_ladder_first_match(spark):
    e = R.case_ladder([(F.col("r") > 4, "high"), (F.col("r") > 2, "mid")], "low")
    assert one(spark, e, [(5.0,), (3.0,), (1.0,)], "r double") == ["high", "mid", "low"]


def test_feature_family_matches_python_rules(spark):
    names = ["daily_aqi_mean", "annual_avg_temp_f", "pct_manufacturing", "pct_uninsured",
             "median_income", "acs_employed_total", "Days PM2.5", "Good Days", "Max AQI",
             "population", "source_rows", "unhealthy_days"]
    got = one(spark, R.feature_family("n"), [(n,) for n in names], "n string")
    by_name = R.families(spark, names)
    assert got == [by_name[n] for n in names]
    assert got[:6] == ["Daily AQI exposure", "Climate", "Industry composition",
                       "Education and health access", "Socioeconomic scale", "Socioeconomic scale"]
    assert got[6:9] == ["Annual AQI"] * 3 and got[10] == "Other"


def test_token_match_substring_quirk(spark):
    names = [("median_income",), ("co_days",), ("population",)]
    assert one(spark, R.match_any_token("n", ["co"]), names, "n string") == [True, True, False]
    assert one(spark, R.match_any_token("n", ["co"], whole_token=True), names, "n string") == \
        [False, True, False]


def test_text_helpers(spark):
    df = spark.createDataFrame([("POINT (-86.64 32.53)", "eps=0.15, min_samples=5",
                                 "Unhealthy for Sensitive Groups", "PM2.5")],
                               "g string, p string, c string, d string")
    lon, lat = X.parse_point("g")
    r = df.select(lon.alias("lon"), lat.alias("lat"), X.parse_param("p", "eps").alias("e"),
                  X.parse_param("p", "min_samples", "int").alias("m"),
                  X.parse_param("p", "k", "int").alias("k"), X.slug("c").alias("s"),
                  X.param_slug("d").alias("ps"),
                  X.clean_label(F.lit("avg_median_aqi"), "avg_").alias("l")).first()
    assert (r.lon, r.lat, r.e, r.m, r.k) == (-86.64, 32.53, 0.15, 5, None)
    assert (r.s, r.ps, r.l) == ("unhealthy_for_sensitive_groups", "pm25", "Median Aqi")
    bad = one(spark, X.parse_point("g")[0], [("POINT EMPTY",)], "g string")
    assert bad == [None]


def test_formatting(spark):
    df = spark.createDataFrame([(1234.567,), (None,)], "v double")
    r = df.select(X.fmt_num("v", 1).alias("a"), X.fmt_pct(F.col("v") / 10000).alias("b"),
                  X.direction("v").alias("c")).collect()
    assert (r[0].a, r[0].b, r[0].c) == ("1,234.6", "12.3%", "above average")
    assert (r[1].a, r[1].b, r[1].c) == ("--", "--", None)


def test_haversine_known_distance(spark):
    from panelspark.functions.geo import haversine
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0)], "a double, b double, c double, d double")
    d = df.select(haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]
    assert math.isclose(d, math.pi / 2, rel_tol=1e-12)
