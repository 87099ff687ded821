"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-case words and the five-letter stems of longer
ones, hashed into a fixed number of buckets; presence counts, not number.
The score adds a weight per term and, for every pair of terms, the product
of their learned vectors: pairs such as an insult with the mention of a
group count more (or less) than the two alone.  The model is fitted in
numpy on a bounded sample of labelled documents, once on the terms that tell
the kinds apart by themselves and once, with stronger shrinkage, on all that
two documents have, whatever their own rates, so that terms which matter only
together are learned too; the one with the smaller loss on a part of the sample
kept back is fitted on the whole sample.  Its size is bounded by the hash space.
Scoring reads every whole text, block by block.

Defined results: null and empty texts score as the model's constant; rows
keep their number and repeats; without labels of both kinds every score is
the smoothed share of toxic labels; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.common import numbered, ready, stored
from panelspark.llm.labelled import fold, sample

#: The training sample's bounds, the hash space, the vectors' length, how
#: many training documents must have a term, steps, step size, shrinkage, and how
#: many standard errors a term's shares among the two kinds must differ by, where
#: terms are screened; where not, how many documents must have a term, its
#: shrinkage in documents; the part of the sample that decides between the two.
TRAIN_ROWS, TRAIN_BYTES, BUCKETS, RANK, LEAST_DOCS = 6000, 65536, 1 << 18, 6, 4
STEPS, STEP, SHRINK, SIGMAS, THRESHOLD = 72_000, 0.2, 1e-4, 5.0, 0.7
ALL_DOCS, PRIOR, DECIDES = 2, 1.0, 4
WORDS = re.compile(r"[^\W\d_]+")
STEM = 5
#: Words of a text are remembered by each task: so many, of at most so many letters.
REMEMBERED, LONGEST = 100_000, 64


def buckets(word: str) -> tuple[int, ...]:
    h = zlib.crc32(word.encode())
    if len(word) <= STEM:
        return (h % BUCKETS,)
    return h % BUCKETS, zlib.crc32(b"^" + word[:STEM].encode()) % BUCKETS


def terms(text: str) -> set[int]:
    return {b for w in set(WORDS.findall(text.lower())) for b in buckets(w)}


class Machine:
    """w0 + Σ w_i + ½ Σ_f [(Σ v_if)² − Σ v_if²] over the terms present."""

    def __init__(self, bias: float, slot: dict[int, int], weight: np.ndarray, vector: np.ndarray):
        self.bias, self.slot, self.weight, self.vector = bias, slot, weight, vector

    def raw(self, at: np.ndarray) -> float:
        if not len(at):
            return self.bias
        v = self.vector[at]
        s = v.sum(0)
        return float(self.bias + self.weight[at].sum() + 0.5 * (s @ s - (v * v).sum()))

    def score(self, at: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(at), -30, 30))))

    def slots(self, found) -> np.ndarray:
        get = self.slot.get
        return np.array(sorted(k for k in map(get, found) if k is not None), np.int64)


def fit(rows: list[tuple[str, int]], seed: int = 11) -> Machine:
    """The machine on screened or on all terms, whichever has the smaller loss
    on one example in DECIDES when fitted on the others."""
    sets = [np.array(sorted(terms(t)), np.int64) for t, _ in rows]
    y = np.array([float(v) for _, v in rows])
    held = np.random.default_rng(seed).permutation(len(rows)) % DECIDES == 0
    part, test = ([s for s, h in zip(sets, held) if h == k] for k in (False, True))
    few, all_ = (loss(machine(part, y[~held], screened, seed), test, y[held]) for screened in (True, False))
    return machine(sets, y, all_ >= few, seed)


def loss(model: Machine, sets: list[np.ndarray], y: np.ndarray) -> float:
    """Sum of the logistic losses."""
    p = [model.score(model.slots(s.tolist())) for s in sets]
    return -sum(float(np.log(q if v else 1 - q)) for q, v in zip(p, y))


def counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all sets, and how many sets have each."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *sets]), return_counts=True)


def machine(sets: list[np.ndarray], y: np.ndarray, screened: bool, seed: int) -> Machine:
    """AdaGrad on the logistic loss, examples (sorted terms) in a fixed random order."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        return Machine(bias, {}, np.zeros(0), np.zeros((0, RANK)))
    kept, n = counted(sets)
    if screened:  # do the kinds have a term differently, beyond chance?
        some, among = counted([s for s, v in zip(sets, y) if v])
        toxic = np.zeros(len(kept))
        toxic[np.searchsorted(kept, some)] = among
        ones, zeros = y.sum(), len(y) - y.sum()
        p = n / len(y)
        apart = np.abs(toxic / ones - (n - toxic) / zeros)
        keep = (n >= LEAST_DOCS) & (apart >= SIGMAS * (p * (1 - p) * (1 / ones + 1 / zeros)) ** 0.5)
    else:
        keep = n >= ALL_DOCS
    kept, n = kept[keep], n[keep]
    shrink = np.full(len(kept), SHRINK) if screened else PRIOR / n
    model = Machine(bias, dict(zip(kept.tolist(), range(len(kept)))), np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), RANK)))
    at = [np.searchsorted(kept, s[np.isin(s, kept, assume_unique=True)]) for s in sets]
    w, v = model.weight, model.vector
    gw, gv, gb = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for _ in range(-(-STEPS // len(y))):
        for k in rng.permutation(len(y)):
            i = at[k]
            g = model.score(i) - y[k]
            gb += g * g
            model.bias -= STEP * g / gb ** 0.5
            if not len(i) or abs(g) < 1e-3:
                continue
            dw = g + shrink[i] * w[i]
            gw[i] += dw * dw
            w[i] -= STEP * dw / np.sqrt(gw[i])
            x = v[i]
            dv = g * (x.sum(0) - x) + shrink[i][:, None] * x
            gv[i] += dv * dv
            v[i] -= 0.3 * STEP * dv / np.sqrt(gv[i])
    return model


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """A machine fitted on labels of the training folds."""
    return fit(sample(docs, labels, "toxic", lambda c: fold(c, 3) != 1, rows, TRAIN_BYTES))


def scored(docs: DataFrame, model: Machine, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and the score of every row's text; nothing else passes
    through Python."""
    shipped = ready(docs).sparkContext.broadcast(model)
    out = T.StructType([*[docs.schema[c] for c in keep], T.StructField("score", T.DoubleType())])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shipped.value, {}  # word → its slots
        get = model.slot.get
        for batch in batches:
            result = []
            for text in batch.column(len(keep)):
                found = set()
                for w in set(WORDS.findall((text.as_py() or "").lower())):
                    k = known.get(w)
                    if k is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        k = tuple(s for s in map(get, buckets(w)) if s is not None)
                        if len(w) <= LONGEST:
                            known[w] = k
                    if k:
                        found.update(k)
                result.append(model.score(np.array(sorted(found), np.int64)))
            yield pa.record_batch([*batch.columns[:len(keep)], pa.array(result, pa.float64())], names=out.names)

    text = F.col(text_col).cast("string").alias("text_of_")
    return docs.select(*[F.col(c) for c in keep], text).mapInArrow(scores, out)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(docs, trained(docs, labels, rows), ("doc_id",)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, read from files, without the rows that the machine rejects.  Only
    row numbers and texts pass through Python; the numbers of rejected rows are
    stored, and the rows themselves are read again."""
    rowed, row = numbered(docs)
    gone = scored(rowed, trained(docs, labels, rows), (row,)).where(F.col("score") >= threshold).select(row)
    return rowed.join(stored(gone, "rejected"), row, "left_anti").select(*docs.columns)
