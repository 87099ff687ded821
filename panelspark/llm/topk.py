"""Exact top-k inner products by block-at-a-time pruning.

Vectors are turned into integers and packed, in the order they are read, into
segments of a bounded number of rows; within a segment similar rows are put next
to each other and cut into blocks of consecutive rows.  A block keeps, for every
dimension (term), its largest and smallest component, and its rows as a matrix
(its forward index).  For a query, the sum over dimensions of the larger product
bounds every score in a block.  Blocks are taken in falling order of that bound and
scored through their forward index, a few more each time, until the next bound is
below the query's kth score (or equal to it with no smaller id to win the tie).

A segment first searches the queries among its own rows, which gives every query k
scores to begin with.  Queries are then compared with the segments' own maxima, and
only those that a segment could still serve are sent to it, in packets of a bounded
number of queries.  Summaries of segments reach the tasks in slices of bounded size.
Each query's results of all segments are merged at the end.  Segments never move
whole to one task, and no set of all queries or all rows is ever in one place.

Defined results: vectors that are null, or hold null or non-finite components, take
no part; missing components of shorter vectors count as 0; rows are told apart by
their number, so another row with the query's own id is a candidate; a null id is no
query, and as a candidate it comes last in a tie; equal ids and scores give equal
rows; fewer than k candidates are all returned; an empty table gives an empty
result; further columns are not read.  Components or scores beyond 64 bits raise.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import ready, stored

#: Rows of a segment and of a block, queries of a packet, segments whose summaries
#: are broadcast at once.
SEGMENT, BLOCK, PACKET, SUMMARIES = 16_384, 64, 512, 8_192
SCALE, TOP, EVERY = 256, 5, 50


def _packed(matrix: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds the matrix."""
    most = int(np.abs(matrix).max()) if matrix.size else 0
    return matrix.astype(np.int16 if most < 2 ** 15 else np.int32 if most < 2 ** 31 else np.int64)


def _wide(matrix: np.ndarray, dims: int) -> np.ndarray:
    return matrix if matrix.shape[1] == dims else np.pad(matrix, ((0, 0), (0, dims - matrix.shape[1])))


def arithmetic(q: np.ndarray, x: np.ndarray):
    """A type in which every inner product of rows of the two is exact."""
    most = (int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))) * max(1, x.shape[1])
    if most >= 2 ** 63:
        raise OverflowError("scores do not fit into 64 bits")
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def similar_first(matrix: np.ndarray) -> np.ndarray:
    """An order that puts rows with like signs in their largest columns together."""
    if not matrix.size:
        return np.arange(len(matrix))
    lead = np.argsort(-np.abs(matrix).sum(0), kind="stable")[:16]
    signs = np.packbits(matrix[:, lead] > matrix[:, lead].mean(0), axis=1)
    top = np.argmax(matrix, axis=1)
    return np.lexsort((*signs.T[::-1], top))


class Segment:
    """Rows of a segment in blocks, with each block's largest and smallest components."""

    def __init__(self, number: int, rows: np.ndarray, ids: np.ndarray, named: np.ndarray, matrix: np.ndarray):
        order = similar_first(matrix)
        self.number, self.rows, self.ids, self.named = number, rows[order], ids[order], named[order]
        self.matrix = _packed(matrix[order])
        starts = np.arange(0, len(rows), BLOCK)
        self.high = np.maximum.reduceat(self.matrix, starts, axis=0)
        self.low = np.minimum.reduceat(self.matrix, starts, axis=0)
        order_id = np.where(self.named, self.ids, np.iinfo(np.int64).max)
        self.least = np.minimum.reduceat(order_id, starts)

    def summary(self) -> tuple:
        return self.number, self.high.max(0), self.low.min(0), int(self.least.min())

    def search(self, queries: np.ndarray, own: np.ndarray, worst: np.ndarray, least: np.ndarray, k: int):
        """For each query (its row number in ``own``): positions and scores of up to ``k``
        rows that can be among its best, given a score and id (``worst``, ``least``) that
        k other rows reach."""
        dims = max(queries.shape[1], self.matrix.shape[1])
        kind = arithmetic(queries, self.matrix)
        q, x = _wide(queries, dims).astype(kind), _wide(self.matrix, dims).astype(kind)
        high, low = _wide(self.high, dims).astype(kind), _wide(self.low, dims).astype(kind)
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        tie = np.where(self.named, self.ids, np.iinfo(np.int64).max)
        for j in range(len(q)):
            order = np.lexsort((self.least, -bounds[j]))
            kth, kth_id = worst[j], least[j]
            at, score = np.zeros(0, np.int64), np.zeros(0, kind)
            done, stride = 0, 1
            while done < len(order):
                some = order[done:done + stride]
                b = bounds[j][some]
                if kth is not None:
                    some = some[(b > kth) | (b == kth) & (self.least[some] <= kth_id)]
                    if not len(some):
                        break  # what follows has no larger bound and, where equal, no smaller id
                done, stride = done + stride, 2 * stride
                new = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                new = new[new < len(x)]
                new = new[self.rows[new] != own[j]]
                at, score = np.concatenate([at, new]), np.concatenate([score, x[new] @ q[j]])
                if len(at) > k:
                    cut = np.partition(score, len(score) - k)[len(score) - k]
                    good = np.flatnonzero(score >= cut)
                    good = good[np.lexsort((tie[at[good]], -score[good]))][:k]
                    at, score = at[good], score[good]
                if len(at) == k:
                    last = np.lexsort((tie[at], -score))[-1]
                    if kth is None or (score[last], -tie[at[last]]) > (kth, -kth_id):
                        kth, kth_id = score[last], tie[at[last]]
            yield at, score


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, vec_id, v) of the rows that take part."""
    x = F.col("v").cast("array<double>")
    whole = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                      F.col(vector_col).alias("v"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return whole.where(F.col("v").isNotNull() & finite).select(
        "row", "vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = int(sizes.max(initial=0))
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    for k, (end, n) in enumerate(zip(np.cumsum(sizes), sizes)):
        out[k, :n] = flat[end - n:end]
    return out


_RESULT = "q_row long, query_id long, vec_id long, score long"


def _results(q_rows, q_ids, found, segment) -> pa.RecordBatch:
    n = [len(at) for at, _ in found]
    at = np.concatenate([a for a, _ in found]).astype(np.int64) if found else np.zeros(0, np.int64)
    score = np.concatenate([s for _, s in found]).astype(np.int64) if found else np.zeros(0, np.int64)
    return pa.record_batch([pa.array(np.repeat(q_rows, n), pa.int64()), pa.array(np.repeat(q_ids, n), pa.int64()),
                            pa.array(segment.ids[at], pa.int64(), mask=~segment.named[at]), pa.array(score, pa.int64())],
                           names=["q_row", "query_id", "vec_id", "score"])


def segments(rows: DataFrame, segment: int) -> DataFrame:
    """(number, summary, packed) of each segment."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, segment - n)
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n == segment:
                    yield one(held)
                    held, n = [], 0
        if n:
            yield one(held)

    def one(held) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("vec_id").combine_chunks()
        named = np.asarray(ids.is_valid())
        row = t.column("row").to_numpy()
        s = Segment(int(row[0]), row, ids.fill_null(0).to_numpy(), named, _matrix(t.column("v").combine_chunks()))
        return pa.record_batch([pa.array([s.number], pa.int64()), pa.array([pickle.dumps(s.summary())], pa.binary()),
                                pa.array([pickle.dumps(s)], pa.binary())], names=["number", "summary", "packed"])

    return rows.mapInArrow(pack, "number long, summary binary, packed binary")


def own_results(packed: DataFrame, every: int, k: int) -> DataFrame:
    """Best rows of its own segment for every query."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                s = pickle.loads(blob.as_py())
                asks = np.flatnonzero(s.named & (s.ids % every == 0))
                for at in range(0, len(asks), PACKET):
                    q = asks[at:at + PACKET]
                    none = [None] * len(q)
                    yield _results(s.rows[q], s.ids[q], list(s.search(s.matrix[q], s.rows[q], none, none, k)), s)

    return packed.select("packed").mapInArrow(search, _RESULT)


def packets(packed: DataFrame, begun: DataFrame, summaries: list, every: int, k: int) -> DataFrame:
    """(number, packet) for each segment of ``summaries``: the queries of a packet that it
    could still serve.  ``begun``: (q_row, worst, least) of the queries that have k scores."""
    shipped = packed.sparkSession.sparkContext.broadcast(summaries)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = shipped.value
        for batch in batches:
            for at in range(0, batch.num_rows, PACKET):
                part = batch.slice(at, PACKET)
                q = _matrix(part.column("v"))
                row, ids, home = (part.column(c).to_numpy() for c in ("q_row", "query_id", "home"))
                worst, least = (part.column(c).to_pylist() for c in ("worst", "least"))
                low = np.array([np.iinfo(np.int64).min if w is None else w for w in worst], np.int64)
                tie = np.array([np.iinfo(np.int64).max if w is None else w for w in least], np.int64)
                for number, high, lowest, first in summaries:
                    dims = max(q.shape[1], len(high))
                    w = _wide(q, dims)
                    kind = arithmetic(w, _wide(np.stack([high, lowest]), dims))
                    x = _wide(np.stack([high, lowest]).astype(kind), dims)
                    bound = (np.maximum(w, 0).astype(kind) @ x[0] + np.minimum(w, 0).astype(kind) @ x[1]).astype(np.int64)
                    go = np.flatnonzero(((bound > low) | (bound == low) & (first <= tie)) & (home != number))
                    if len(go):
                        body = pickle.dumps((row[go], ids[go], _packed(q[go]), [worst[j] for j in go], [least[j] for j in go]))
                        yield pa.record_batch([pa.array([number], pa.int64()), pa.array([body], pa.binary())],
                                              names=["number", "packet"])

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                s = pickle.loads(blob.as_py())
                at = np.flatnonzero(s.named & (s.ids % every == 0))
                if len(at):
                    yield pa.record_batch(
                        [pa.array(s.rows[at]), pa.array(s.ids[at]), pa.array(np.full(len(at), s.number)),
                         pa.array(list(s.matrix[at].astype(np.int64)), pa.list_(pa.int64()))],
                        names=["q_row", "query_id", "home", "v"])

    asks = packed.select("packed").mapInArrow(questions, "q_row long, query_id long, home long, v array<bigint>")
    asks = asks.join(begun, "q_row", "left").select("q_row", "query_id", "home", "v", "worst", "least")
    return asks.mapInArrow(asked, "number long, packet binary")


def served(packed: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """Best rows of each segment for the queries sent to it."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, None)
        for batch in batches:
            for number, blob, packet in zip(*[batch.column(c) for c in ("number", "packed", "packet")]):
                if held[0] != number.as_py():
                    held = number.as_py(), pickle.loads(blob.as_py())
                row, ids, q, worst, least = pickle.loads(packet.as_py())
                yield _results(row, ids, list(held[1].search(q, row, worst, least, k)), held[1])

    both = sent.join(packed.select("number", "packed"), "number").select("number", "packed", "packet")
    return both.mapInArrow(search, _RESULT)


def ranked(results: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return results.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = EVERY, k: int = TOP,
          scale: int = SCALE, segment: int = SEGMENT, summaries: int = SUMMARIES) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` best rows; queries are the rows
    whose id ``every`` divides."""
    ready(df)
    packed = stored(segments(integers(df, id_col, vector_col, scale), segment), "segments")
    first = stored(own_results(packed, every, k), "own")
    begun = stored(first.groupBy("q_row").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        "score", (-F.coalesce("vec_id", F.lit(2 ** 63 - 1))).alias("i"))).alias("m")).where(F.col("n") >= k).select(
        "q_row", F.col("m.score").alias("worst"), (-F.col("m.i")).alias("least")), "begun")
    results, after = first, -2 ** 63
    while True:  # a bounded slice of summaries at a time
        some = [pickle.loads(r["summary"]) for r in packed.where(F.col("number") > after).select(
            "number", "summary").orderBy("number").limit(summaries).collect()]
        if not some:
            break
        after = some[-1][0]
        results = results.unionByName(stored(served(packed, packets(packed, begun, some, every, k), k), "served"))
        if len(some) < summaries:
            break
    return ranked(results, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, d.vec_id,
             CAST(list_sum(list_transform(list_zip(q.x, d.x), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
      FROM v q JOIN v d ON q.r <> d.r WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""
