"""Registered landing round trip (S01 S02 S08 S11 S13): the daily stand-in
is written as yearly CSV partitions into the shared stage folder and read
back with the key columns pinned to text."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from panelspark.functions.keys import composite_key
from panelspark.plans import fixtures as fx
from panelspark.plans.catalog import register
from panelspark.plans.fixture_sql import finalize, with_views
from panelspark.sources.landing import read_years, stage_root, write_table


def landed_daily(spark, sf_dir):
    root = os.path.join(stage_root(spark), f"daily_csv_{uuid.uuid4().hex}")  # written anew: never stale
    d = fx.daily_raw(spark, sf_dir).withColumn("year", F.year("date"))
    write_table(d, root, partition_by="year", fmt="csv")
    return read_years(spark, os.path.join(root, "year=*", "*.csv"), "year",
                      pattern=r"year=([0-9]{4})", on="file_path",
                      key=["state_code", "county_code"])


_LANDED_SQL = """
SELECT year, count(*) AS n, sum(aqi) AS aqi_total, count(DISTINCT geoid) AS entities
FROM daily GROUP BY year"""


@register("landed_daily_roundtrip", with_views(finalize(_LANDED_SQL), ["daily"]))
def q_landed_daily_roundtrip(spark, sf_dir):
    """S11 → S08 + S01/S02: yearly CSV partitions written once to the stage
    folder, read back (period from the path, keys as text), summarised."""
    d = landed_daily(spark, sf_dir)
    return d.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("aqi").alias("aqi_total"),
        F.count_distinct(composite_key(("state_code", 2), ("county_code", 3))).alias("entities"))
