"""Registered queries of operators that the compositions reach only in part:
filters, casts, renames, name classification, attached predictions, error
routing and the landing readers on files that Spark writes from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions import rules as R
from panelspark.operators import clean as C
from panelspark.operators import joins as J
from panelspark.plans import enrichment as en
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views
from panelspark.session import cut_lineage, read_table
from panelspark.sources import landing as L


@register("measure_rows", with_views(finalize(
    "SELECT geoid, year, defining_param, aqi FROM daily WHERE upper(defining_param) = 'OZONE'",
    ["geoid", "defining_param"]), ["daily"]))
def q_measure_rows(spark, sf_dir):
    """Rows whose first existing measure column has a value, in any case."""
    d = en.clean_daily(fx.daily_raw(spark, sf_dir))
    return C.filter_measure(d, "ozone", ["measure", "defining_param"]).select(
        "geoid", "year", "defining_param", "aqi")


@register("filtered_panel", with_views(finalize(
    "SELECT geoid, year, outcome, aqi_median FROM panel WHERE outcome > 10 AND aqi_median < 60 "
    "AND state_name NOT IN ('CHINA', 'NATION_3') AND year IN (1995, 1996, 1998)", ["geoid"]), ["panel"]))
def q_filtered_panel(spark, sf_dir):
    """Conjunctive predicates (unknown drops the row), value sets in and out."""
    p = C.filter_all(fx.panel(spark, sf_dir), [F.col("outcome") > 10, F.col("aqi_median") < 60])
    p = C.filter_in(C.filter_in(p, "state_name", ["CHINA", "NATION_3"], negate=True), "year", [1995, 1996, 1998])
    return p.select("geoid", "year", "outcome", "aqi_median")


@register("complete_rows", with_views(finalize(
    "SELECT year, count(*) AS n, avg(aqi_max) AS mean_max FROM panel "
    "WHERE outcome IS NOT NULL AND aqi_median IS NOT NULL AND aqi_max IS NOT NULL GROUP BY year"), ["panel"]))
def q_complete_rows(spark, sf_dir):
    """Complete cases."""
    return C.complete_cases(fx.panel(spark, sf_dir), ["outcome", "aqi_median", "aqi_max"]).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("aqi_max").alias("mean_max"))


_NUMERIC = ["outcome", "lower_ci", "upper_ci", "population", "median_income", "poverty_count", "unemployed_count",
            "aqi_median", "aqi_max"]


@register("numeric_means", with_views(finalize(
    "SELECT state_name, " + ", ".join(f"avg({c}) AS {c}" for c in _NUMERIC) + " FROM panel GROUP BY state_name",
    ["state_name"]), ["panel"]))
def q_numeric_means(spark, sf_dir):
    """Means of the numeric columns, taken from the schema."""
    p = fx.panel(spark, sf_dir)
    return p.groupBy("state_name").agg(*[F.avg(c).alias(c) for c in _NUMERIC if c in C.numeric_columns(p, ["year"])])


@register("lenient_casts", with_views(finalize(
    "SELECT geoid, year, TRY_CAST(total_population AS BIGINT) AS total_population, "
    "CAST(population AS DOUBLE) AS population, TRY_CAST(geoid AS INTEGER) AS number FROM panel", ["geoid"]), ["panel"]))
def q_lenient_casts(spark, sf_dir):
    """Rename and cast; what does not parse becomes NULL."""
    p = C.project(fx.panel(spark, sf_dir).withColumn("again", F.col("geoid")), {
        "geoid": "geoid", "year": "year", "total_population": "total_population", "population": "population",
        "again": "number"})
    return C.cast_columns(p, {"total_population": "bigint", "population": "double", "number": "int"})


@register("clean_headers", with_views(finalize(
    "SELECT geoid, year, outcome AS outcome_rate_2020, population AS total_pop FROM panel", ["geoid"]), ["panel"]))
def q_clean_headers(spark, sf_dir):
    """Headers in lower case, other characters as one underscore."""
    p = fx.panel(spark, sf_dir).select(F.col("geoid").alias("GeoID"), F.col("year").alias(" Year "),
                                       F.col("outcome").alias("Outcome Rate (2020)"),
                                       F.col("population").alias("Total--Pop."))
    return C.normalise_columns(p)


# The name of the panel's measure that each line number stands for here
_NAMES = ["daily_aqi_mean", "annual_avg_temp_f", "pct_construction", "pct_insured", "median_income", "Days CO",
          "Days with AQI"]


def _named(spark, sf_dir):
    """Lines with the measure they stand for."""
    names = F.array(*[F.lit(n) for n in _NAMES])
    return read_table(spark, sf_dir, "lineitem").select(
        "l_quantity", names[F.col("l_linenumber") - 1].alias("measure"), F.concat_ws(" ", F.lit("flag"), F.col("l_returnflag")).alias("other"))


_FAMILY_SQL = """CASE measure WHEN 'daily_aqi_mean' THEN 'Daily AQI exposure' WHEN 'annual_avg_temp_f' THEN 'Climate'
  WHEN 'pct_construction' THEN 'Industry composition' WHEN 'pct_insured' THEN 'Education and health access'
  WHEN 'median_income' THEN 'Socioeconomic scale' ELSE 'Annual AQI' END"""
_NAMED_SQL = f"""SELECT l_quantity, list_extract({_NAMES!r}, CAST(l_linenumber AS INTEGER)) AS measure,
  'flag ' || l_returnflag AS other FROM lineitem"""


@register("family_classify", f"""
SELECT family, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM (
  SELECT l_quantity, {_FAMILY_SQL} AS family FROM ({_NAMED_SQL}) UNION ALL
  SELECT l_quantity, 'Other' FROM ({_NAMED_SQL})) GROUP BY family""")
def q_family_classify(spark, sf_dir):
    """P25: every line's measure and flag, classified by ordered rules and added up by family."""
    named = _named(spark, sf_dir)
    both = named.select("l_quantity", F.explode(F.array("measure", "other")).alias("name"))
    return both.groupBy(R.feature_family("name").alias("family")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@register("token_split", f"""
SELECT measure, contains(lower(measure), 'aqi') OR contains(lower(measure), 'co') AS somewhere,
       regexp_matches(lower(measure), '(^|[_ ])(aqi|co)($|[_ ])') AS as_token, count(*) AS n
FROM ({_NAMED_SQL}) GROUP BY ALL""")
def q_token_split(spark, sf_dir):
    """Lines by measure, a token anywhere in its name, and as a whole token."""
    return _named(spark, sf_dir).groupBy(
        "measure", R.match_any_token("measure", ["aqi", "co"]).alias("somewhere"),
        R.match_any_token("measure", ["aqi", "co"], whole_token=True).alias("as_token")).agg(F.count(F.lit(1)).alias("n"))


@register("attached_predictions", with_views(finalize("""
SELECT p.geoid, p.year, q.prediction, CASE WHEN q.prediction IS NULL THEN 'No prediction' ELSE 'Predicted' END AS status
FROM panel p LEFT JOIN (SELECT geoid, avg(outcome) AS prediction FROM panel WHERE year < 1997 GROUP BY geoid) q
  ON q.geoid = p.geoid""", ["geoid", "status"]), ["panel"]))
def q_attached_predictions(spark, sf_dir):
    """Every entity kept, those without a prediction marked."""
    p = fx.panel(spark, sf_dir)
    preds = p.where("year < 1997").groupBy("geoid").agg(F.avg("outcome").alias("prediction"))
    return J.attach_predictions(p.select("geoid", "year"), preds, "geoid")


_BROKEN = "CASE WHEN right(geoid, 1) = '7' THEN 'not json' ELSE payload END"


@register("routed_errors", with_views(finalize(f"""
SELECT parameter, CASE WHEN right(geoid, 1) = '7' THEN 'error' ELSE 'good' END AS side, count(*) AS n
FROM (SELECT geoid, parameter, {_BROKEN} AS payload FROM climate_payloads) GROUP BY ALL""", ["parameter", "side"]),
    ["climate_payloads"]))
def q_routed_errors(spark, sf_dir):
    """Payloads that do not parse go to a side table."""
    p = fx.climate_payloads(spark, sf_dir).withColumn("payload", F.expr(_BROKEN))
    good, bad = en.split_errors(p)
    sides = good.select("parameter", F.lit("good").alias("side")).unionByName(
        bad.select("parameter", F.lit("error").alias("side")))
    return sides.groupBy("parameter", "side").agg(F.count(F.lit(1)).alias("n"))


def _written(spark, name: str) -> str:
    return f"{L.stage_root(spark)}/{name}-{uuid.uuid4().hex}"


@register("bulk_table", with_views(finalize(
    "SELECT '0500000US' || geoid AS GEO_ID, right(geoid, 5) AS geoid, CAST(year AS DOUBLE) AS year, "
    "CAST(population AS DOUBLE) AS population, aqi_max FROM panel", ["GEO_ID", "geoid"]), ["panel"]))
def q_bulk_table(spark, sf_dir):
    """A pipe-delimited bulk table that Spark writes from the panel, read back by key prefix."""
    p = fx.panel(spark, sf_dir)
    path, cols = _written(spark, "bulk"), ["year", "population", "aqi_max"]
    levels = F.explode(F.array(F.lit("0500000US"), F.lit("0400000US"))).alias("level")  # rows of another level, too
    p.select("geoid", *cols, levels).select(F.concat("level", "geoid").alias("GEO_ID"), *cols).write.option(
        "header", True).option("sep", "|").csv(path)
    return L.read_bulk(spark, path, cols)


@register("header_row_json", with_views(finalize(
    "SELECT geoid, CAST(year AS VARCHAR) AS year, CAST(population AS VARCHAR) AS population FROM panel",
    ["geoid", "year", "population"]), ["panel"]))
def q_header_row_json(spark, sf_dir):
    """One payload per entity, an array whose first row names the columns."""
    rows = F.collect_list(F.array(F.col("population").cast("string"), F.col("year").cast("string")))
    payload = F.to_json(F.concat(F.array(F.array(F.lit("population"), F.lit("year"))), rows))
    p = fx.panel(spark, sf_dir).groupBy("geoid").agg(payload.alias("payload"))
    return L.json_rows_to_df(p, "payload", ["year", "population"], ["geoid"])


@register("sources_loaded", with_views(finalize("""
SELECT 'panel' AS source, count(*) AS n, 'loaded' AS status FROM panel UNION ALL
SELECT 'nothing', 0, 'no rows' UNION ALL SELECT 'unkeyed', 0, 'missing columns [''geoid'']'""",
                                                ["source", "status"]), ["panel"]))
def q_sources_loaded(spark, sf_dir):
    """Sources without rows or key columns are skipped and reported."""
    p = fx.panel(spark, sf_dir)
    good, skipped = L.load_or_skip({"panel": lambda: p, "nothing": lambda: p.where("year < 0"),
                                    "unkeyed": lambda: p.drop("geoid")}, required=["geoid"])
    out = spark.createDataFrame([(s, 0, why) for s, why in skipped], "source string, n long, status string")
    for name, df in good:
        out = out.unionByName(df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"),
                                     F.lit("loaded").alias("status")))
    return out


_LANDED = ["geoid", "year", "outcome", "population", "total_population"]


@register("zipped_csv", with_views(finalize(
    "SELECT geoid, year, outcome, CAST(population AS BIGINT) AS population, total_population FROM panel",
    ["geoid", "total_population"]), ["panel"]))
def q_zipped_csv(spark, sf_dir):
    """The panel in zip archives of several CSV members, read back member by member."""
    folder = _written(spark, "zipped")
    L.write_zipped_csv(fx.panel(spark, sf_dir).select(*_LANDED), folder, member_rows=1000)
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("total_population", T.StringType()), ("geoid", T.StringType()), ("year", T.IntegerType()),
        ("outcome", T.DoubleType()), ("population", T.LongType()))])
    return L.read_zipped_csv(spark, f"{folder}/*.zip", schema, path_col=None).select(*_LANDED)


_PAGE = "CAST(geoid AS BIGINT) % 40"


def _paged(spark, sf_dir, where: str) -> tuple[str, str]:
    """(folder, schema) of the panel as pages: files that hold one JSON array each."""
    rows = fx.panel(spark, sf_dir).select("geoid", "year", "population", F.expr(_PAGE).alias("page")).where(where)
    record = F.struct(F.col("geoid").alias("GeoID"), F.col("year").alias("Year"), F.col("population").alias("Population"))
    folder = _written(spark, "pages")
    rows.groupBy("page").agg(F.to_json(F.collect_list(record)).alias("value")).repartition("page").write.partitionBy(
        "page").text(folder)
    return folder, "GeoID string, Year int, Population long, page long"


@register("json_pages", with_views(finalize(
    f"SELECT geoid, year, CAST(population AS BIGINT) AS population, {_PAGE} AS page FROM panel", ["geoid"]), ["panel"]))
def q_json_pages(spark, sf_dir):
    """A table landed as pages of JSON records, read as one."""
    return L.read_json_pages(spark, *_paged(spark, sf_dir, "true"))


@register("missing_pages", with_views(finalize(f"""
SELECT page, count(*) AS lost FROM (SELECT {_PAGE} AS page FROM panel) WHERE page % 7 = 3 GROUP BY page"""), ["panel"]))
def q_missing_pages(spark, sf_dir):
    """Pages that were never landed, with the rows of the panel that they would have."""
    lost = L.missing_pages(L.read_json_pages(spark, *_paged(spark, sf_dir, "page % 7 <> 3")))
    rows = fx.panel(spark, sf_dir).select(F.expr(_PAGE).alias("page"))
    return rows.join(lost, "page").groupBy("page").agg(F.count(F.lit(1)).alias("lost"))


@register("stage_reuse", with_views(finalize("""
SELECT 'built' AS step, year, count(*) AS n, true AS fresh FROM panel GROUP BY year UNION ALL
SELECT 'reused', year, count(*), false FROM panel GROUP BY year UNION ALL
SELECT 'input rewritten', year, 2 * count(*), true FROM panel GROUP BY year UNION ALL
SELECT 'plan changed', year, 2 * count(*), true FROM panel WHERE year > 1995 GROUP BY year""", ["step", "fresh"]), ["panel"]))
def q_stage_reuse(spark, sf_dir):
    """A stage table is reused while its inputs and its plan are the same, and built anew
    when either changes."""
    root, source = _written(spark, "reuse"), _written(spark, "source")
    p = fx.panel(spark, sf_dir).select("geoid", "year")
    out, before = None, None

    def step(name, build):
        nonlocal out, before
        got = L.materialise(spark, "by_year", build, root=root)
        folder = got.inputFiles()[0].rsplit("/table-", 1)[1].split("/")[0]
        rows = cut_lineage(got.withColumns({"step": F.lit(name), "fresh": F.lit(folder != before)}))
        out, before = rows if out is None else out.unionByName(rows), folder

    def build():
        return spark.read.parquet(source).groupBy("year").agg(F.count(F.lit(1)).alias("n"))

    p.write.parquet(source)
    step("built", build)
    step("reused", build)
    p.unionByName(p).write.mode("overwrite").parquet(source)
    step("input rewritten", build)
    step("plan changed", lambda: build().where("year > 1995"))
    return out.select("step", "year", "n", "fresh")
