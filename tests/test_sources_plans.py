"""Landing readers / sinks on generated files, and physical-plan checks."""

import io
import json
import os
import zipfile

import pytest
from fixture_paths import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as se
from panelspark.plans import enrichment as en
from panelspark.sources import landing as L
from panelspark.streaming import land_new_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_read_table_pins_key(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "panel.csv")
    _write(p, "geoid,year,v\n01001,2019,1.5\n02013,2020,\n")
    df = L.read_table(spark, p, key="geoid")
    assert dict(df.dtypes)["geoid"] == "string"
    assert [r.geoid for r in df.orderBy("geoid").collect()] == ["01001", "02013"]
    assert df.where("v is null").count() == 1


def test_read_bulk_prefix_and_pruning(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "bulk.dat")
    _write(p, "GEO_ID|A|B|C\n0500000US01001|10|x|7\n0400000US01|5|1|1\n0500000US02013|3|2|n/a\n")
    df = L.read_bulk(spark, p, ["A", "C"])
    rows = {r.geoid: (r.A, r.C) for r in df.collect()}
    assert rows == {"01001": (10.0, 7.0), "02013": (3.0, None)}
    assert "B" not in df.columns


def test_zipped_csv(spark, tmpdir_fresh):
    for year in (2019, 2020):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr(f"daily_{year}.csv", "State Code,County Code,AQI\n1,1,50\n6,37,\n")
            zf.writestr(f"more/daily_{year}.csv", "AQI,x,County Code,State Code\nbad,,3,1\n")
        with open(os.path.join(tmpdir_fresh, f"daily_aqi_by_county_{year}.zip"), "wb") as fh:
            fh.write(buf.getvalue())
    schema = T.StructType([T.StructField("State Code", T.StringType()),
                           T.StructField("County Code", T.StringType()),
                           T.StructField("AQI", T.DoubleType())])
    df = L.read_zipped_csv(spark, os.path.join(tmpdir_fresh, "*.zip"), schema)
    assert df.count() == 6 and df.where("AQI is null").count() == 4
    assert df.select("source_file").distinct().count() == 2
    assert df.where("`State Code` = '1' and `County Code` = '3'").count() == 2  # every member, columns by name
    for name, members, message in (("none", {"a.txt": "x"}, "no CSV"), ("less", {"a.csv": "AQI\n1\n"}, "without the columns")):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            for member, text in members.items():
                zf.writestr(member, text)
        with open(os.path.join(tmpdir_fresh, f"{name}.bin"), "wb") as fh:
            fh.write(buf.getvalue())
        with pytest.raises(Exception, match=message):
            L.read_zipped_csv(spark, os.path.join(tmpdir_fresh, f"{name}.bin"), schema).collect()


def test_json_rows_and_pages(spark, tmpdir_fresh):
    payloads = [(2019, json.dumps([["NAME", "B01003_001E", "state", "county"],
                                   ["A County", "100", "01", "001"]])),
                (2020, json.dumps([["NAME", "state", "county", "B01003_001E"]])),  # header only
                (2021, json.dumps([["county", "state", "NAME", "B01003_001E"],
                                   ["003", "01", "B County", "250"]]))]
    df = spark.createDataFrame(payloads, "year int, payload string")
    out = L.json_rows_to_df(df, "payload", ["NAME", "B01003_001E", "state", "county"], keep=["year"])
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(2019, "A County", "100", "01", "001"), (2021, "B County", "250", "01", "003")]
    pages = os.path.join(tmpdir_fresh, "pages")
    _write(os.path.join(pages, "p0.json"), json.dumps([{"MeasureId": "MHLTH", "Data_Value": "15.1"}]))
    _write(os.path.join(pages, "p1.json"), json.dumps([{"MeasureId": "OBESITY", "Data_Value": "30"}]))
    pg = L.read_json_pages(spark, pages)
    assert set(pg.columns) == {"measureid", "data_value"} and pg.count() == 2


def test_read_years_sink_and_materialise(spark, tmpdir_fresh):
    for y in (2018, 2019):
        _write(os.path.join(tmpdir_fresh, "in", f"places_{y}.csv"), f"geoid,v\n01001,{y - 2000}\n")
    df = L.read_years(spark, os.path.join(tmpdir_fresh, "in", "*.csv"), key="geoid")
    assert sorted((r.year, r.v) for r in df.collect()) == [(2018, 18), (2019, 19)]
    calls = []

    def build():
        calls.append(1)
        return df
    root = os.path.join(tmpdir_fresh, "stages")
    a = L.materialise(spark, "places", build, root=root, partition_by="year")
    b = L.materialise(spark, "places", build, root=root, partition_by="year")
    assert a.count() == b.count() == 2 and a.inputFiles() == b.inputFiles()
    c = L.materialise(spark, "places", build, root=root, force=True)
    assert not set(c.inputFiles()) & set(a.inputFiles()) and a.count() == 2  # readers of the last one go on
    _write(os.path.join(tmpdir_fresh, "in", "places_2020.csv"), "geoid,v\n01001,20\n01002,21\n")
    df = L.read_years(spark, os.path.join(tmpdir_fresh, "in", "*.csv"), key="geoid")
    assert L.materialise(spark, "places", build, root=root).count() == 4
    rows = spark.createDataFrame([(1,)], "a int")  # rows of this session have no fingerprint
    assert L.fingerprint(rows) is None and L.fingerprint(df) == L.fingerprint(df) != L.fingerprint(df.where("v > 1"))
    one, two = (L.materialise(spark, "rows", lambda: rows, root=root).inputFiles() for _ in range(2))
    assert one != two


def test_zip_members_are_checked(spark, tmpdir_fresh):
    """Stored and deflated members, and damage that the directory's size or checksum shows."""
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    text = "a,b\n" + "".join(f"{k},x{k}\n" for k in range(5000))
    for name, method in (("stored", zipfile.ZIP_STORED), ("deflated", zipfile.ZIP_DEFLATED)):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", method) as zf:
            for k in range(3):
                zf.writestr(f"m{k}.csv", text)
        with open(os.path.join(tmpdir_fresh, f"{name}.zip"), "wb") as fh:
            fh.write(buf.getvalue())
        df = L.read_zipped_csv(spark, os.path.join(tmpdir_fresh, f"{name}.zip"), schema)
        assert df.count() == 15000 and df.where("b = 'x7'").count() == 3
        bad = bytearray(buf.getvalue())
        bad[2000] ^= 1
        with open(os.path.join(tmpdir_fresh, f"{name}.bad"), "wb") as fh:
            fh.write(bytes(bad))
        with pytest.raises(Exception, match="m0.csv"):
            L.read_zipped_csv(spark, os.path.join(tmpdir_fresh, f"{name}.bad"), schema).collect()
    assert L.missing_pages(spark.createDataFrame([(0,), (2,), (5,), (2,)], "page int")).count() == 3
    assert L.missing_pages(spark.createDataFrame([], "page int")).count() == 0


def test_load_or_skip_and_split_errors(spark):
    good_df = spark.createDataFrame([(1,)], "a int")
    empty = spark.createDataFrame([], "a int")

    def boom():
        raise RuntimeError("network")
    good, skipped = L.load_or_skip({"ok": lambda: good_df, "empty": lambda: empty,
                                    "bad": boom, "wrong": lambda: good_df.toDF("b")},
                                   required=["a"])
    assert [n for n, _ in good] == ["ok"]
    assert dict(skipped)["empty"] == "no rows" and dict(skipped)["bad"].startswith("failed")
    p = spark.createDataFrame([("1", '{"1995": "1.5"}'), ("2", "not json")], "geoid string, payload string")
    ok, err = en.split_errors(p)
    assert [r.geoid for r in ok.collect()] == ["1"] and [r.geoid for r in err.collect()] == ["2"]


def test_streaming_landing_is_exactly_once(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "drop")
    _write(os.path.join(src, "daily_2019.csv"), "geoid,aqi\n01001,50\n01003,60\n")
    schema = T.StructType([T.StructField("geoid", T.StringType()), T.StructField("aqi", T.DoubleType())])
    target = os.path.join(tmpdir_fresh, "stage")
    ck = os.path.join(tmpdir_fresh, "ck")
    assert land_new_files(spark, src, schema, target, checkpoint=ck) == 2
    _write(os.path.join(src, "daily_2020.csv"), "geoid,aqi\n01001,70\n")
    land_new_files(spark, src, schema, target, checkpoint=ck)
    land_new_files(spark, src, schema, target, checkpoint=ck)  # nothing new
    got = spark.read.parquet(target)
    assert got.count() == 3 and sorted(r.year for r in got.select("year").distinct().collect()) == [2019, 2020]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_core_plans_stay_in_the_jvm(spark):
    qs = se.queries()
    for name in ["daily_exposure_features", "enriched_panel", "knn_impute", "share_features",
                 "rates", "zscore_within", "top3_per_group", "eps_degree"]:
        plan = _plan(qs[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_pushdown_and_pruning(spark):
    from panelspark.plans import fixtures as fx
    df = fx.period_features(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_discount:double,l_tax:double,l_shipdate" in plan
    p = fx.daily_raw(spark, SF_SMALL).select("aqi")
    assert "l_extendedprice" not in _plan(p)


def test_knn_uses_window_group_limit(spark):
    from panelspark.operators.knn import knn_candidates
    obs = spark.createDataFrame([(2019, "a", 1.0, 1.0, 5.0)], "year int, _oid string, lat double, lon double, v double")
    miss = spark.createDataFrame([(2019, "b", 1.1, 1.0, 0)], "year int, _mid string, lat double, lon double, lvl int")
    plan = _plan(knn_candidates(miss, obs, ["v"], 3, [1.0, 180.0], "year"))
    assert "WindowGroupLimit" in plan
