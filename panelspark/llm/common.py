"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir, ship_package

#: The characters that count as white space in every operator here.
WS_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: A maximal run of other characters is a word (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage like a checkpoint, compressed, and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch, unless the session says otherwise: Spark's own 10,000 are
#: tens of megabytes of text on both sides of every Python worker.
BATCH_ROWS, SPARKS_OWN = "1000", "10000"


def ready(df: DataFrame) -> SparkSession:
    """The frame's session, with this package importable on its executors and
    Arrow batches of a size that suits whole texts."""
    spark, setting = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    ship_package(spark)
    if spark.conf.get(setting) == SPARKS_OWN:
        spark.conf.set(setting, BATCH_ROWS)
    return spark


def n_words(text):
    """Words of a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores appended, such that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a row number in a column of a free name, and that name.  Of a
    frame read from files the numbers are the same each time it is read."""
    row = free_name(df, "row")
    return df.withColumn(row, F.monotonically_increasing_id()), row
