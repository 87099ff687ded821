"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are covered whole by chunks of 512 bytes that overlap
by half.  Learned filters of eight bytes slide over them byte by byte (a filter
is a table of weights per place and byte, so a convolution is eight look-ups),
a bounded number of half-chunks at a time, however long the text;
each filter's greatest response in a chunk is kept, and the chunks' maxima
are combined, as greatest and as mean over the chunks, by a logistic layer
into one probability.  The network is fitted by gradient descent (through
the places of the maxima) on a bounded sample of labelled documents.

Defined results: null and empty texts are one chunk of zero bytes and get a
score; rows keep their number and repeats; without labels of both kinds
every score is the smoothed share of good labels; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import ready
from panelspark.llm.labelled import fold, sample

#: The training sample's bounds; half a chunk, filter width, filters;
#: documents seen in training (with repeats), batch, step size, shrinkage.
TRAIN_ROWS, TRAIN_BYTES = 3000, 32768
HALF, WIDTH, FILTERS = 256, 8, 16
SEEN, BATCH, STEP, SHRINK, THRESHOLD = 24_000, 32, 0.02, 1e-4, 0.3
#: Bytes per block of texts scored at once, half-chunks of them convolved at once.
BLOCK_BYTES, SLICE = 512 << 10, 1024


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each padded with zeros to whole half-chunks, and the
    first half-chunk of each (and the end)."""
    halves = [max(1, -(-len(t) // HALF)) for t in texts]
    starts = np.concatenate([[0], np.cumsum(halves)])
    flat = b"".join(t.ljust(n * HALF, b"\0") for t, n in zip(texts, halves)) + bytes(WIDTH)
    return np.frombuffer(flat, np.uint8), starts


class Network:
    def __init__(self, table: np.ndarray, bias: np.ndarray, head: np.ndarray, offset: float):
        self.table, self.bias, self.head, self.offset = table, bias, head, offset

    def responses(self, flat: np.ndarray, last: np.ndarray) -> np.ndarray:
        """(half-chunks, places, filters) of whole half-chunks and the bytes that follow them;
        ``last`` marks the last one of a text, whose last places, which reach into the next
        text, are left out."""
        n = len(last)
        out = self.table[0][flat[:n * HALF]]
        for k in range(1, WIDTH):
            out += self.table[k][flat[k:n * HALF + k]]
        out = out.reshape(n, HALF, -1)
        out[last, 1 - WIDTH:] = -np.inf
        return out

    def maxima(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Greatest response of each filter in each half-chunk, a slice at a time."""
        last = np.zeros(int(starts[-1]), bool)
        last[starts[1:] - 1] = True
        return np.concatenate([
            self.responses(flat[at * HALF:(at + SLICE) * HALF + WIDTH], last[at:at + SLICE]).max(1)
            for at in range(0, len(last), SLICE)])

    def pooled(self, halves: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of the overlapping chunks (two half-chunks each; the last
        half of a text stands alone), and the features of the texts."""
        following = np.minimum(np.arange(1, len(halves) + 1), len(halves) - 1)
        last = np.zeros(len(halves), bool)
        last[starts[1:] - 1] = True
        chunk = np.maximum(halves, np.where(last[:, None], -np.inf, halves[following]))
        chunk = np.maximum(chunk + self.bias, 0)
        count = np.diff(starts)[:, None]
        return chunk, np.concatenate([np.maximum.reduceat(chunk, starts[:-1]),
                                      np.add.reduceat(chunk, starts[:-1]) / count], 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        flat, starts = laid_out(texts)
        halves = self.maxima(flat, starts)
        return 1 / (1 + np.exp(-np.clip(self.pooled(halves, starts)[1] @ self.head + self.offset, -30, 30)))


class Adam:
    def __init__(self, step: float):
        self.step, self.m, self.v, self.t = step, {}, {}, 0

    def move(self, name: str, x: np.ndarray, g: np.ndarray) -> None:
        m = self.m[name] = 0.9 * self.m.get(name, 0.0) + 0.1 * g
        v = self.v[name] = 0.99 * self.v.get(name, 0.0) + 0.01 * g * g
        x -= self.step * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-7)


def fit(rows: list[tuple[bytes, int]], seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    y = np.array([float(v) for _, v in rows])
    share = (y.sum() + 1) / (len(y) + 2)
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        net.head[:] = 0
        return net
    adam, offset = Adam(STEP), np.array([net.offset], np.float32)
    for _ in range(-(-SEEN // len(y))):
        order = rng.permutation(len(y))
        for b in range(0, len(order), BATCH):
            pick = order[b:b + BATCH]
            flat, starts = laid_out([rows[i][0] for i in pick])
            n = int(starts[-1])
            last = np.zeros(n, bool)
            last[starts[1:] - 1] = True
            all_ = net.responses(flat, last)
            where = all_.argmax(1)
            halves = np.take_along_axis(all_, where[:, None], 1)[:, 0]
            chunk, feats = net.pooled(halves, starts)
            p = 1 / (1 + np.exp(-np.clip(feats @ net.head + offset[0], -30, 30)))
            g = ((p - y[pick]) / len(pick)).astype(np.float32)
            dfeat = g[:, None] * net.head
            size, text = np.diff(starts), np.repeat(np.arange(len(pick)), np.diff(starts))
            dchunk = (dfeat[:, FILTERS:] / size[:, None])[text]
            top = chunk == feats[text, :FILTERS]  # the text's greatest chunk, the first of equals
            first = np.zeros_like(top)
            for d in range(len(pick)):
                s = slice(starts[d], starts[d + 1])
                first[starts[d] + top[s].argmax(0), np.arange(FILTERS)] = True
            dchunk = (dchunk + np.where(first, dfeat[text, :FILTERS], 0)) * (chunk > 0)
            # a chunk's maximum stands in its first half or in the following one
            second = ~last[:, None] & (halves[np.minimum(np.arange(1, n + 1), n - 1)] > halves)
            dhalf = np.where(second, 0, dchunk)
            dhalf[1:] += np.where(second, dchunk, 0)[:-1]
            h, f = np.nonzero(dhalf)
            at = h * HALF + where[h, f]
            dtable = np.zeros_like(net.table)
            for k in range(WIDTH):
                np.add.at(dtable[k], (flat[at + k], f), dhalf[h, f])
            adam.t += 1
            adam.move("table", net.table, dtable)
            adam.move("bias", net.bias, dchunk.sum(0))
            adam.move("head", net.head, feats.T.astype(np.float32) @ g + SHRINK * net.head)
            adam.move("offset", offset, g.sum(keepdims=True))
    net.offset = float(offset[0])
    return net


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """A network fitted on labels of the training folds."""
    got = sample(docs, labels, "quality", lambda c: fold(c, 5) != 0, rows, TRAIN_BYTES)
    return fit([(t.encode(), y) for t, y in got])


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    spark = ready(docs)
    shipped = spark.sparkContext.broadcast(net)
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shipped.value
        for batch in batches:
            result, block, size = [], [], 0
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                block.append(text or b"")
                size += len(block[-1]) + HALF
                if size >= BLOCK_BYTES:
                    result.append(net.scores(block))
                    block, size = [], 0
            result.append(net.scores(block))
            yield pa.record_batch([batch.column(0), pa.array(np.concatenate(result).astype(float))], names=out.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(scores, out)


def quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, trained(docs, labels, rows)).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
