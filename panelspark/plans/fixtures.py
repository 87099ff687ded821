"""Fixture views: panel-shaped inputs derived from the shared test tables.

The test tables are a TPC-H-like star schema without missing values, so
every panel input (daily readings, a county-year panel, centroids, source
tables with different key sets, long series) is derived here by fixed key
arithmetic.  Each view has a twin SQL definition in ``fixture_sql`` so the
DuckDB oracle computes on exactly the same input.  All derivations are
plain column expressions and partial aggregates; they scale with the
source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.keys import zfill
from panelspark.session import read_table

# The category ladder and pollutant names used for the
# daily stand-in (EPA daily AQI vocabulary).
CATEGORY_LADDER = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"),
                   (200, "Unhealthy")]
CATEGORY_TOP = "Very Unhealthy"
POLLUTANTS = ["PM2.5", "Ozone", "NO2", "CO", "PM10"]
PRIORITY_BANDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["view", "click", "error", "signup", "purchase"]


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (site-)day: state / county codes as unpadded text, date,
    AQI (some missing), category, defining pollutant, sites reporting."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    q5 = F.col("l_quantity") * 5
    cat = None
    for bound, name in CATEGORY_LADDER:
        cat = F.when(q5 <= bound, name) if cat is None else cat.when(q5 <= bound, name)
    return li.select(
        (F.col("l_suppkey") / 1000).cast("bigint").cast("string").alias("state_code"),
        (F.col("l_suppkey") % 1000).cast("string").alias("county_code"),
        F.to_date("l_shipdate").alias("date"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 29 != 0, q5).alias("aqi"),
        cat.otherwise(CATEGORY_TOP).alias("category"),
        F.element_at(F.array(*[F.lit(p) for p in POLLUTANTS]),
                     (F.col("l_linenumber") % 5 + 1).cast("int")).alias("defining_param"),
        F.col("l_linenumber").alias("sites"),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County-year panel stand-in: customer × order year.

    outcome plays the held-out prevalence; median_income carries the
    −666666666 sentinel; aqi_median / aqi_max are partly missing for the
    kNN imputation; total_population is thousands-grouped text.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year"), "o_totalprice")
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    g = orders.groupBy("k", "year").agg(F.count(F.lit(1)).alias("n"),
                                        F.avg("o_totalprice").alias("avg_price"))
    k, y = F.col("k"), F.col("year")
    pop = (F.lit(1000) * F.col("n") + k).cast("bigint")
    outcome = F.when((k + y) % 23 != 0, F.col("avg_price") / 10007)
    return (g.join(cust, "k").join(nation, "c_nationkey")
             .select(zfill(k, 5).alias("geoid"),
                     F.col("c_name").alias("county_name"),
                     F.col("n_name").alias("state_name"),
                     y.alias("year"),
                     outcome.alias("outcome"),
                     (outcome - 1).alias("lower_ci"),
                     (outcome + 1).alias("upper_ci"),
                     F.format_number(pop, 0).alias("total_population"),
                     pop.alias("population"),
                     F.when(k % 50 == 0, F.lit(-666666666.0))
                      .otherwise((F.lit(30000) + (k * 13) % 50000).cast("double"))
                      .alias("median_income"),
                     (pop * (k % 30) / 100.0).alias("poverty_count"),
                     (pop * (k % 17) / 100.0).alias("unemployed_count"),
                     F.when(k % 3 != 0, (F.lit(20) + (k * 7 + y) % 60).cast("double"))
                      .alias("aqi_median"),
                     F.when((k % 3 != 0) & (k % 31 != 0),
                            (F.lit(60) + (k * 11 + y) % 140).cast("double"))
                      .alias("aqi_max")))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One WKT point per (state, county) name pair."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    k = F.col("c_custkey")
    lon = F.lit(-124.0) + ((k * 37) % 5700) / 100.0
    lat = F.lit(25.0) + ((k * 17) % 2400) / 100.0
    return (cust.join(nation, "c_nationkey")
                .select(F.col("n_name").alias("state"), F.col("c_name").alias("county"),
                        F.format_string("POINT (%.2f %.2f)", lon, lat).alias("geolocation")))


def industry_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per order priority per customer (industry-table shape)."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    return o.groupBy(zfill("o_custkey", 5).alias("geoid")).agg(
        F.count(F.lit(1)).alias("employed_total"),
        *[F.count_if(F.col("o_orderpriority") == b).alias(f"band_{i + 1}")
          for i, b in enumerate(PRIORITY_BANDS)])


def education_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per event type per user (education-table shape)."""
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type")
    return e.groupBy(zfill("user_id", 5).alias("geoid")).agg(
        F.count(F.lit(1)).alias("education_total"),
        *[F.count_if(F.col("event_type") == t).alias(f"level_{i + 1}")
          for i, t in enumerate(EVENT_TYPES)])


def health_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per return flag per supplier (health-insurance-table shape)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    return li.groupBy(zfill("l_suppkey", 5).alias("geoid")).agg(
        F.count(F.lit(1)).alias("civilian_total"),
        F.count_if(F.col("l_returnflag") == "A").alias("uninsured_a"),
        F.count_if(F.col("l_returnflag") == "R").alias("uninsured_r"))


def period_features(spark: SparkSession, sf_dir: str, lo: int = 1997, hi: int = 1999
                    ) -> DataFrame:
    """Source-year features available only for ``lo``..``hi`` (ACS shape)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_discount", "l_tax")
    yr = F.year("l_shipdate")
    return (li.where(yr.between(lo, hi))
              .groupBy(zfill("l_suppkey", 5).alias("geoid"), yr.alias("source_year"))
              .agg(F.count(F.lit(1)).alias("source_rows"),
                   F.avg("l_discount").alias("pct_discounted"),
                   F.avg("l_tax").alias("pct_taxed")))


def climate_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(geoid, parameter) → JSON object text ``{"1995": "12.345", …}``.

    Values are built from exact integer sums so the text is identical in
    every engine (no float formatting): tavg = mean quantity, pcp = mean
    line number, each truncated to 3 decimals.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber")
    yearly = li.groupBy(zfill("l_suppkey", 5).alias("geoid"),
                        F.year("l_shipdate").cast("string").alias("yr")).agg(
        (F.sum("l_quantity").cast("bigint") * 1000).alias("q"),
        (F.sum("l_linenumber").cast("bigint") * 1000).alias("ln"),
        F.count(F.lit(1)).alias("n"))

    def milli_text(num):
        m = F.expr(f"{num} div n")
        return F.concat((m / 1000).cast("bigint").cast("string"), F.lit("."),
                        F.lpad((m % 1000).cast("string"), 3, "0"))

    long = yearly.select("geoid", "yr", F.inline(F.array(
        F.struct(F.lit("tavg").alias("parameter"), milli_text("q").alias("v")),
        F.struct(F.lit("pcp").alias("parameter"), milli_text("ln").alias("v")))))
    return (long.groupBy("geoid", "parameter")
                .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("yr", "v"))))
                     .alias("payload")))


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation code → name with one code left out (unmapped → NULL)."""
    n = read_table(spark, sf_dir, "nation")
    return (n.where(F.col("n_nationkey") != 7)
             .select(zfill("n_nationkey", 2).alias("code"), F.col("n_name").alias("label")))


def points2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two embedding coordinates per vector (DBSCAN input)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.col("embedding")[0].cast("double").alias("x"),
                    F.col("embedding")[1].cast("double").alias("y"),
                    F.col("label"))


def vectors(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """Embedding vectors unpacked to double columns f0..f{dims-1}."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), "label",
                    *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(dims)])
