"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(id_col, folds: int):
    """crc32 of the id as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, keep, rows: int, most_bytes: int) -> list:
    """At most ``rows`` (text, label) of labelled documents that ``keep``
    holds for and whose text has at most ``most_bytes`` bytes, the first in
    the order of a hash of their id: the same ones in every run.  Of a repeated
    id one text counts, the one with the smallest hash."""
    marks = (labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y_")))
    marks = marks.select(F.col("doc_id").alias("id_"), "y_").where(keep("id_"))
    # only ids are ordered; the texts of those chosen are fetched afterwards
    chosen = marks.orderBy(F.xxhash64(F.col("id_").cast("string")), "id_").limit(rows)
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    got = (docs.select(F.col("doc_id").alias("d_"), t.alias("t_"))
           .where(F.octet_length("t_") <= most_bytes)
           .join(F.broadcast(chosen), F.col("d_") == F.col("id_"))
           .groupBy("id_").agg(F.min_by("t_", F.struct(F.xxhash64("t_"), "t_")).alias("t_"),
                               F.max("y_").cast("int").alias("y_")))
    return [(r["t_"], r["y_"]) for r in sorted(got.collect(), key=lambda r: (r["id_"], r["t_"]))]
