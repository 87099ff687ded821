"""Exactly-once landing of newly arrived files into a stage table."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.session import ensure_checkpoint_dir


def land_new_files(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                   period_col: str = "year", fmt: str = "csv",
                   pattern: str = r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)",
                   checkpoint: str | None = None) -> int:
    """Append every file of ``source_dir`` not landed before to ``target``
    (Parquet, partitioned by the period taken from the file name) and
    stop: ``trigger(availableNow=True)`` processes the backlog in
    micro-batches; the streaming checkpoint records which files are done,
    so a rerun (or a restarted driver) never lands a file twice.  Returns
    the number of rows landed by this call."""
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "landing",
                                      os.path.basename(target.rstrip("/")))
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(source_dir)
    period = F.nullif(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1), F.lit(""))
    stream = stream.withColumn(period_col, period.try_cast("int"))
    before = _rows(spark, target)
    query = (stream.writeStream.format("parquet").option("path", target)
                   .option("checkpointLocation", ckpt).partitionBy(period_col)
                   .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return _rows(spark, target) - before


def _rows(spark: SparkSession, target: str) -> int:
    """Rows of the stage table (from Parquet footers); none before it exists."""
    try:
        return spark.read.parquet(target).count()
    except AnalysisException:
        return 0
