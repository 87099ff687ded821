"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, chunks, mixing, setjoin, toxicity
from panelspark.llm.common import numbered, stored
from panelspark.session import read_table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go; null and empty texts
    score as the model's constant, rows keep their repeats."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) one row stays.  ``docs`` is read from
    files, so the rows' numbers are the same each time they are read."""
    rowed, row = numbered(docs)
    gone = chunks.exact_dedup(rowed, row_col=row).where(~F.col("kept"))
    return rowed.join(gone.select(F.col("row").alias(row)), row, "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one row stays: the one with the smallest
    id, one without an id last, and among equal ids the first row.  ``docs`` is
    read from files, so the rows' numbers are the same each time they are read."""
    rowed, row = numbered(docs)
    gone = setjoin.superfluous(rowed, row).select(F.col("row").alias(row))
    return rowed.join(gone, row, "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times; texts without
    words have no size and are taken as often as their source's rate says."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digests of ids and decoded text; null
    texts count as empty."""
    return bpe.digests(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("toxicity", toxic), ("exact_dedup", exact_duplicates), ("near_duplicates", near_duplicates),
          ("mixing", mixed), ("bpe", tokens)]

#: Stages that fit a model or sample have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
