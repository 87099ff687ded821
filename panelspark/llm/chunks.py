"""Exact duplicates by content-defined chunk recipes.

Every text is normalised (white space deleted) and cut where a rolling hash
of its last 16 bytes hits a pattern, so equal passages are cut alike
wherever they stand.  Chunks are then deduplicated across the corpus: each
chunk's bytes travel once, a task's repeats not at all, and the shuffle
verifies that no identifier stands for two different chunks.  From there on
a document is only the ordered list of its verified identifiers (16 bytes
for about two kilobytes of text); documents are equal when these lists are.

Defined results: null texts count as empty; empty (or white-space) texts
equal each other; a null id sorts after all others; a row repeated with the
same id is a copy of itself, and exactly one of the repeats is kept; tables
may be empty and may have any further columns, which are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import WS_BYTES, ready, stored

#: Identifier widths tried in turn: the next one is taken when verification
#: finds two different chunks under one identifier.
ID_BYTES = (16, 32)
MEAN_BITS, LEAST, MOST = 11, 512, 16384


def _gear() -> np.ndarray:
    """256 fixed pseudo-random 32-bit words (a multiplicative sequence)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def cut_points(data: bytes, mean_bits: int = MEAN_BITS, least: int = LEAST,
               most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data``: after at least ``least`` bytes where
    the rolling hash has ``mean_bits`` zero bits, after ``most`` at the latest."""
    n = len(data)
    if n <= least:
        return [n]
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):  # the window doubles: 2, 4, 8, 16 bytes
        g = h.copy()
        g[step:] += h[:-step] << np.uint32(step)
        h = g
    marks = np.flatnonzero((h >> np.uint32(32 - mean_bits)) == 0) + 1
    ends, start, k = [], 0, 0
    while n - start > least:
        k = int(np.searchsorted(marks, start + least))
        end = int(marks[k]) if k < len(marks) else n
        end = min(end, start + most, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def normalised(text: bytes | None) -> bytes:
    return (text or b"").translate(None, WS_BYTES)


def chunk_ids(data: bytes, width: int, **cut) -> list[tuple[bytes, bytes]]:
    """(identifier, bytes) of each chunk in order; an empty text has none."""
    out, start = [], 0
    for end in cut_points(data, **cut) if data else ():
        piece = data[start:end]
        out.append((hashlib.blake2b(piece, digest_size=width).digest(), piece))
        start = end
    return out


def _binary(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def chunk_table(docs: DataFrame, text_col: str, width: int, **cut) -> DataFrame:
    """(chunk_id, chunk) of every chunk of every text."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for text in _binary(batch.column(0)):
                for row in chunk_ids(normalised(text), width, **cut):
                    rows.append(row)
                    size += len(row[1])
                if size > 4_000_000:
                    yield _pairs(rows)
                    rows, size = [], 0
            if rows:
                yield _pairs(rows)

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(
        chunks, "chunk_id binary, chunk binary")


def _pairs(rows) -> pa.RecordBatch:
    ids, pieces = zip(*rows)
    return pa.record_batch([pa.array(ids, pa.binary()), pa.array(pieces, pa.binary())],
                           names=["chunk_id", "chunk"])


def clashes(docs: DataFrame, text_col: str, width: int, **cut) -> int:
    """Identifiers that stand for more than one chunk: the chunks are
    deduplicated by their bytes, then counted by identifier."""
    distinct = chunk_table(docs, text_col, width, **cut).groupBy("chunk_id", "chunk").agg(
        F.count(F.lit(1)).alias("n"))
    return (distinct.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("variants"))
            .where("variants > 1").count())


def recipes(docs: DataFrame, id_col: str, text_col: str, width: int, row_col: str | None = None, **cut) -> DataFrame:
    """(doc_id, n_points, row, recipe, text_sha256): the identifiers of a text
    in order, packed into one binary of ``width`` bytes each."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipe, digest = [], []
            for text in _binary(batch.column(3)):
                data = normalised(text)
                recipe.append(b"".join(i for i, _ in chunk_ids(data, width, **cut)))
                digest.append(hashlib.sha256(data).hexdigest())
            yield pa.record_batch([*batch.columns[:3], pa.array(recipe, pa.binary()), pa.array(digest, pa.string())],
                                  names=["doc_id", "n_points", "row", "recipe", "text_sha256"])

    t = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.length(t), F.lit(0)).cast("long").alias("n_points"),
                       (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
                       t.alias("t")).mapInArrow(
        lists, f"doc_id {id_type}, n_points long, row long, recipe binary, text_sha256 string")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                widths: tuple[int, ...] = ID_BYTES, row_col: str | None = None, **cut) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 and row.  Of equal texts the row with the most code points in
    the original text stays, then the smallest id, then the smallest row
    number (``row_col``, or the rows' order as read)."""
    ready(docs)
    width = next((w for w in widths if not clashes(docs, text_col, w, **cut)), None)
    if width is None:
        raise ValueError(f"chunk identifiers of {widths} bytes all clash")
    rows = stored(recipes(docs, id_col, text_col, width, row_col, **cut), "recipes")
    first = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"),
                           F.col("doc_id").alias("i"), F.col("row").alias("r")))
    groups = stored(rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
                    .where("n > 1").select("recipe", "n", F.col("first.i").alias("keep"),
                                           F.col("first.r").alias("keep_row")), "copies")
    return rows.join(groups, "recipe", "left").select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256", "row")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS p,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
g AS (
  SELECT doc_id, sha256(body) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY p DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
