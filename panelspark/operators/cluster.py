"""Clustering and cluster evaluation.

* PCA is a Spark ML job over an assembled vector column; k-means runs all its
  restarts in the same passes over the rows.
* Calinski–Harabasz comes from per-cluster sums (one grouped aggregate).
* The silhouette uses squared Euclidean distances, which per-cluster sums
  give exactly; a Euclidean one would need every pair of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import cut_lineage, ship_package


def latest(df: DataFrame, period: str = "year") -> DataFrame:
    """Rows of the last period (scalar subquery, partition-prunable)."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def assemble(df: DataFrame, feats: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(feats), outputCol=out).transform(df)


def pca_embed(df: DataFrame, feats: Sequence[str], k: int = 2, prefix: str = "pca_"
              ) -> tuple[DataFrame, list[list[float]], list[float]]:
    """Principal components of (already standardised) features.
    Each component's sign is fixed so its largest absolute loading is
    positive.  Returns (rows with pca_1..k, loadings, explained variance)."""
    vec = assemble(df, feats, "_v")
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vec)
    pc = model.pc.toArray()  # d × k
    signs = []
    for j in range(k):
        col = pc[:, j]
        signs.append(-1.0 if col[abs(col).argmax()] < 0 else 1.0)
    # centre as scikit-learn does (Spark's PCA projects uncentred data)
    means = vec.agg(*[F.avg(c).alias(c) for c in feats]).first()
    proj = []
    for j in range(k):
        expr = None
        for i, c in enumerate(feats):
            term = (F.col(c) - F.lit(means[c])) * F.lit(float(pc[i, j]) * signs[j])
            expr = term if expr is None else expr + term
        proj.append(expr.alias(f"{prefix}{j + 1}"))
    loadings = [[float(pc[i, j]) * signs[j] for j in range(k)] for i in range(len(feats))]
    return df.select("*", *proj), loadings, list(model.explainedVariance.toArray())


def kmeans(df: DataFrame, feats: Sequence[str], k: int, restarts: int = 25, seed: int = 42,
           max_iter: int = 300, out: str = "cluster") -> tuple[DataFrame, float]:
    """K-means with several seeds, keeping the lowest within-cluster
    sum of squares (scikit-learn ``n_init``)."""
    rows = cut_lineage(df)
    best = kmeans_many(rows, feats, [k], restarts, seed, max_iter)
    return assigned(rows, feats, best[k][0], out), best[k][1]


#: Rows from which the first centres are drawn, at most; entries of a task's distance
#: table; centres that move less than this share of the variance stand still.
INIT_ROWS, TABLE, STILL = 4000, 4_000_000, 1e-10


def kmeans_many(rows: DataFrame, feats: Sequence[str], ks: Sequence[int], restarts: int, seed: int = 42,
                max_iter: int = 300) -> dict[int, tuple[np.ndarray, float]]:
    """(centres, cost) of the best of ``restarts`` runs for each k.

    All runs of all k advance together: one pass over the rows per iteration
    adds up, in each task, the members and sums of every run's clusters, and
    only those reach the driver.  ``rows`` should be stored."""
    sample = rows.select(_features(feats).alias("x")).orderBy(F.xxhash64("x"), "x").limit(INIT_ROWS).collect()
    sample = np.array([r["x"] for r in sample], float).reshape(-1, len(feats))
    if not len(sample):
        return {k: (np.zeros((k, len(feats))), 0.0) for k in ks}
    runs = [(k, _first_centres(sample, k, np.random.default_rng([seed, k, r]))) for k in ks for r in range(restarts)]
    packed = _packed(rows, feats)
    cost, moving = [float("inf")] * len(runs), list(range(len(runs)))
    still = STILL * max(float(sample.var(0).sum()), 1e-300)
    for _ in range(max_iter):
        sums = _lloyd(packed, len(feats), [runs[i][1] for i in moving])
        left = []
        for i, (n, s, q) in zip(moving, sums):
            k, old = runs[i]
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], old)
            runs[i], cost[i] = (k, new), q
            if ((new - old) ** 2).sum() > still:
                left.append(i)
        moving = left
        if not moving:
            break
    best = {}
    for i, (k, centres) in enumerate(runs):
        if k not in best or cost[i] < best[k][1]:
            best[k] = (centres, cost[i])
    return best


def _features(feats: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in feats])


def _first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample."""
    centres = [x[rng.integers(len(x))]]
    far = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k:
        at = rng.choice(len(x), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(x))
        centres.append(x[at])
        far = np.minimum(far, ((x - x[at]) ** 2).sum(1))
    return np.array(centres)


def _matrices(batches: Iterator[pa.RecordBatch], column: int, dims: int, wide: int):
    """(batch slice, matrix) of bounded size."""
    step = max(1, TABLE // max(1, wide))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _stretches(sizes: Sequence[int]) -> list[tuple[int, int]]:
    """(from, to) of the stretches of equal sizes."""
    ends = [i for i in range(1, len(sizes) + 1) if i == len(sizes) or sizes[i] != sizes[i - 1]]
    return list(zip([0, *ends], ends))


#: Rows of a packed block; entries of its distance table that stay near the processor.
BLOCK, NEAR_TABLE = 4096, 250_000


def _packed(rows: DataFrame, feats: Sequence[str]) -> DataFrame:
    """(x): the features as blocks of doubles, stored, so that a pass reads bytes instead of rows."""
    dims = len(feats)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _matrices(batches, 0, dims, TABLE // BLOCK):
            if len(x):
                yield pa.record_batch([pa.array([np.ascontiguousarray(x, dtype=float).tobytes()], pa.binary())], names=["x"])

    spark = rows.sparkSession
    ship_package(spark)
    x = rows.select(_features(feats).alias("x"))
    tasks = spark.sparkContext.defaultParallelism
    if x.rdd.getNumPartitions() < tasks:
        x = x.repartition(tasks)
    return cut_lineage(x.mapInArrow(pack, "x binary"))


def _lloyd(packed: DataFrame, dims: int, runs: list[np.ndarray]) -> list:
    """(members, sums, cost) of every run's clusters, in one pass."""
    sizes = [len(c) for c in runs]
    starts = np.cumsum([0, *sizes])
    alike = [(starts[i], i, j, sizes[i]) for i, j in _stretches(sizes)]
    # of runs of one size, all first centres lie side by side, then all second ones
    place = np.concatenate([np.arange(a, a + k * (j - i)).reshape(j - i, k).T.ravel() for a, i, j, k in alike])
    centres = np.vstack(runs)[place]
    shipped = packed.sparkSession.sparkContext.broadcast(np.hstack([-2 * centres, (centres * centres).sum(1)[:, None]]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shipped.value
        total, cost = np.zeros((len(centres), dims + 1)), np.zeros(len(sizes))
        step = max(1, NEAR_TABLE // max(1, len(centres)))
        for batch in batches:
            for block in batch.column(0):
                whole = np.frombuffer(block.as_buffer(), float).reshape(-1, dims)
                whole = np.hstack([whole, np.ones((len(whole), 1))])
                for at in range(0, len(whole), step):
                    x = whole[at:at + step]
                    far = centres @ x.T  # distances less the row's own square
                    square = np.einsum("ij,ij->i", x, x) - 1.0
                    for a, i, j, k in alike:
                        table = far[a:a + k * (j - i)].reshape(k, j - i, -1)
                        least = table.min(0)
                        cost[i:j] += np.maximum(least + square, 0.0).sum(1)
                        free = np.ones(least.shape, bool)
                        for one in table:  # of equally near centres the first counts
                            mine = one == least
                            mine &= free
                            free ^= mine
                            one[:] = mine
                    total += far @ x
        ordered = np.empty_like(total)
        ordered[place] = total
        flat = np.concatenate([ordered.ravel(), cost])
        yield pa.record_batch([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["cell", "v"])

    got = packed.mapInArrow(add, "cell int, v double").groupBy("cell").agg(
        F.sum("v").alias("v")).collect()  # as many rows as the centres have coordinates
    flat = np.zeros(starts[-1] * (dims + 1) + len(sizes))
    for r in got:
        flat[r["cell"]] = r["v"]
    total = flat[:starts[-1] * (dims + 1)].reshape(-1, dims + 1)
    return [(total[a:b, -1], total[a:b, :-1], flat[starts[-1] * (dims + 1) + r])
            for r, (a, b) in enumerate(zip(starts, starts[1:]))]


def assigned(rows: DataFrame, feats: Sequence[str], centres: np.ndarray, out: str) -> DataFrame:
    """``rows`` with the number of the nearest centre, the first of equally near ones."""
    x = _features(feats)
    apart = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda u, w: (u - w) * (u - w)),
                         F.lit(0.0), lambda t, v: t + v) for c in centres]
    return rows.withColumn("_d", F.array(*apart)).withColumn(
        out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d")


def assigned_all(rows: DataFrame, feats: Sequence[str], centres: Sequence[np.ndarray], key: str = "id") -> DataFrame:
    """(key, labels): the number of each row's nearest centre, as assigned() has it, for every
    set of centres."""
    ship_package(rows.sparkSession)
    dims = len(feats)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 1, dims, max((len(c) for c in centres), default=1)):
            columns = np.ascontiguousarray(x.T, dtype=float)
            found = np.empty((len(x), len(centres)), np.int32)
            for j, some in enumerate(centres):
                far = np.zeros((len(some), len(x)))
                for d in range(dims):  # added up in the order of assigned()
                    far += (columns[d] - some[:, d, None]) ** 2
                found[:, j] = far.argmin(0)
            labels = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(centres), pa.int32()), pa.array(found.ravel()))
            yield pa.record_batch([part.column(0), labels], names=[key, "labels"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, _features(feats).alias("x")).mapInArrow(label, f"`{key}` {kind}, labels array<int>")


def _centred(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    """``df`` with ``_x``, the features less their means, so that sums of
    squares keep their digits."""
    means = df.agg(F.array(*[F.avg(F.col(c).cast("double")) for c in feats]).alias("m")).scalar()
    x = F.array(*[F.col(c).cast("double") for c in feats])
    return df.withColumn("_m", means).withColumn("_x", F.zip_with(x, "_m", lambda v, m: v - m)).drop("_m")


def _cluster_sums(df: DataFrame, label: str, size: int) -> DataFrame:
    """(label, n, s, q): members, sums of ``_x`` and of its squares."""
    per = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("_x")[k]).alias(f"s{k}") for k in range(size)],
        F.sum(F.aggregate("_x", F.lit(0.0), lambda t, v: t + v * v)).alias("q"))
    return per.select(label, "n", F.array(*[f"s{k}" for k in range(size)]).alias("s"), "q")


def calinski_harabasz(df: DataFrame, feats: Sequence[str], label: str) -> DataFrame:
    """Between / within dispersion ratio from per-cluster sums."""
    per = _cluster_sums(_centred(df, feats), label, len(feats)).withColumn(
        "between", F.aggregate("s", F.lit(0.0), lambda t, v: t + v * v) / F.col("n"))
    tot = per.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"), F.sum("between").alias("ssb"),
                  F.sum(F.col("q") - F.col("between")).alias("ssw"))
    spread = F.col("ssw") / F.nullif(F.col("n_total") - F.col("k"), F.lit(0))
    return tot.select("*", F.when(F.col("k") >= 2, F.col("ssb") / (F.col("k") - 1)
                                  / F.nullif(spread, F.lit(0.0))).alias("calinski_harabasz"))


def silhouette(df: DataFrame, feats: Sequence[str], label: str, exclude=(-1,)) -> DataFrame:
    """(n, silhouette) over rows whose label is not in ``exclude``, with
    squared Euclidean distances.

    The mean squared distance of a point to a cluster follows from the
    cluster's size, sum and sum of squares, so the exact value takes one
    aggregate and one pass over the points: O(rows · clusters), the same
    definition at every size, and no pairs.  s = (b − a) / max(a, b); a point
    alone in its cluster, or with a = b = 0, scores 0; with fewer than two
    clusters the mean is NULL."""
    keep = _centred(df.where(~F.col(label).isin(list(exclude))) if exclude else df, feats)
    sums = _cluster_sums(keep, label, len(feats))
    table = sums.agg(F.sort_array(F.collect_list(F.struct(F.col(label).alias("l"), "n", "s", "q")))).scalar()
    far = lambda x, c: F.greatest(F.lit(0.0), (  # noqa: E731  sum of squared distances to the members
        c["n"] * F.aggregate(x, F.lit(0.0), lambda t, v: t + v * v) + c["q"]
        - 2 * F.aggregate(F.zip_with(x, c["s"], lambda u, v: u * v), F.lit(0.0), lambda t, v: t + v)))
    each = keep.withColumn("_c", table).select(F.col(label).alias("_l"), F.transform("_c", lambda c: F.struct(
        c["l"].alias("l"), c["n"].alias("n"), far(F.col("_x"), c).alias("d"))).alias("_d"))
    own = F.filter("_d", lambda c: c["l"] == F.col("_l"))[0]
    others = F.transform(F.filter("_d", lambda c: c["l"] != F.col("_l")), lambda c: c["d"] / c["n"])
    each = each.select(own["n"].alias("n"), (own["d"] / F.nullif(own["n"] - 1, F.lit(0))).alias("a"),
                       F.array_min(others).alias("b"))
    score = F.when(F.col("b").isNull(), F.lit(None).cast("double")).when(
        (F.col("n") <= 1) | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return each.agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("silhouette"))


#: Bytes of all settings' cluster sums up to which they are broadcast; rows that a task
#: adds up at once.
BROADCAST_SUMS, ADDED = 8_000_000, 16_384


def search_scores(rows: DataFrame, labels: DataFrame, feats: Sequence[str], key: str = "id", setting: str = "params",
                  label: str = "cluster", noise: int = -1) -> DataFrame:
    """(setting, silhouette, calinski_harabasz) of every setting in ``labels`` (setting, key,
    label), as silhouette() and calinski_harabasz() have them for one, without noise."""
    names = [r[0] for r in labels.select(setting).distinct().orderBy(setting).collect()]  # a row per setting
    per_row = labels.groupBy(key).agg(F.collect_list(F.struct(F.col(setting).alias("s"), F.col(label).cast("int").alias("l"))).alias("_s"))
    def under(name):
        return F.get(F.filter("_s", lambda c: c["s"] == F.lit(name)), F.lit(0))["l"]

    each = F.array(*[under(n) for n in names])
    scores = GridScores(rows, per_row.select(key, each.alias("labels")), [feats], len(names), key, noise)
    named = labels.sparkSession.createDataFrame(list(enumerate(names)), f"_setting int, `{setting}` {labels.schema[setting].dataType.simpleString()}")
    return named.join(scores.silhouettes(), "_setting").join(scores.dispersion(0), "_setting").select(
        setting, F.col("silhouette0").alias("silhouette"), "calinski_harabasz")


def _some_rows(batches: Iterator[pa.RecordBatch], sizes: Sequence[int], settings: int, wide: int):
    """(matrices, labels, which are known) of a bounded number of rows at a time."""
    held, n, most = [], 0, max(1, min(ADDED, TABLE // max(1, wide)))

    def matrices():
        table = pa.Table.from_batches(held).combine_chunks()
        flat = [pc.list_flatten(table.column(k)).combine_chunks() for k in range(len(sizes) + 1)]
        xs = [v.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, size) for v, size in zip(flat, sizes)]
        known = flat[-1].is_valid().to_numpy(zero_copy_only=False).reshape(-1, settings)
        return xs, flat[-1].fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, settings), known

    for batch in batches:
        for at in range(0, batch.num_rows, most):
            held.append(batch.slice(at, most))
            n += held[-1].num_rows
            if n >= most:
                yield matrices()
                held, n = [], 0
    if n:
        yield matrices()


class GridScores:
    """Scores of all settings of a search from ``labels`` (key, labels): one row per key with
    its label under every setting (null: none).  The rows of all ``feature_sets`` meet the
    labels once; sums of clusters and distances to them are products of matrices in the tasks."""

    def __init__(self, rows: DataFrame, labels: DataFrame, feature_sets: Sequence[Sequence[str]], settings: int,
                 key: str = "id", noise: int = -1):
        spark = rows.sparkSession
        ship_package(spark)
        self.sizes, self.settings, self.noise = [len(f) for f in feature_sets], settings, noise
        xs = [f"_x{k}" for k in range(len(feature_sets))]
        for name, feats in zip(xs, feature_sets):
            rows = _centred(rows, feats).withColumnRenamed("_x", name)
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        joined = rows.select(key, *xs).join(labels, key).repartition(tasks, key)
        self.wide = cut_lineage(joined.select(*xs, "labels"))
        self.sums = cut_lineage(self._sums())

    def _sums(self) -> DataFrame:
        """(_setting, _l, n, s and q of each feature set) of every cluster, noise included."""
        sizes, settings = self.sizes, self.settings
        cells = [f"{c}{k}" for k, size in enumerate(sizes) for c in (*[f"s{k}_{d}_" for d in range(size)], "q")]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for xs, labels, known in _some_rows(batches, sizes, settings, settings):
                x = np.hstack([m for one in xs for m in (one, (one * one).sum(1)[:, None])])
                for j in range(settings):
                    rows = np.flatnonzero(known[:, j])
                    if not len(rows):
                        continue
                    rows = rows[labels[rows, j].argsort(kind="stable")]
                    mine = labels[rows, j]
                    start = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    total = np.add.reduceat(x[rows], start, 0)
                    yield pa.record_batch([pa.array(np.full(len(start), j, np.int32)), pa.array(mine[start].astype(np.int64)),
                                           pa.array(np.diff(np.r_[start, len(rows)])), *[pa.array(c) for c in total.T.copy()]],
                                          names=["_setting", "_l", "n", *cells])

        got = self.wide.mapInArrow(add, "_setting int, _l long, n long, " + ", ".join(f"{c} double" for c in cells))
        got = got.groupBy("_setting", "_l").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cells])
        return got.select("_setting", "_l", "n", *[c for k, size in enumerate(sizes) for c in (
            F.array(*[f"s{k}_{d}_{k}" for d in range(size)]).alias(f"s{k}"), F.col(f"q{k}"))])

    def _clusters(self) -> DataFrame:
        return self.sums.where(F.col("_l") != self.noise)

    def counts(self) -> DataFrame:
        """(_setting, clusters, noise_pct) of every setting with rows."""
        own = F.col("_l") == self.noise
        return self.sums.groupBy("_setting").agg(
            F.count_if(~own & (F.col("_l") >= 0)).alias("clusters"),
            (F.sum(F.when(own, F.col("n")).otherwise(0)) / F.sum("n")).alias("noise_pct"))

    def dispersion(self, k: int) -> DataFrame:
        """(_setting, calinski_harabasz) by the feature set ``k``."""
        s, q, size = f"s{k}", f"q{k}", self.sizes[k]
        square = lambda c: F.aggregate(c, F.lit(0.0), lambda t, v: t + v * v)
        spread = self._clusters().withColumn("b", square(s) / F.col("n")).groupBy("_setting").agg(
            F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows"), F.sum("b").alias("ssb"), F.sum(F.col(q) - F.col("b")).alias("ssw"),
            square(F.array(*[F.sum(F.col(s)[d]) for d in range(size)])).alias("off"))
        ssb = F.col("ssb") - F.col("off") / F.col("rows")  # the rows' own mean, noise left out
        inner = F.col("ssw") / F.nullif(F.col("rows") - F.col("k"), F.lit(0))
        return spread.select("_setting", F.when(F.col("k") >= 2, ssb / (F.col("k") - 1) / F.nullif(inner, F.lit(0.0)))
                             .alias("calinski_harabasz"))

    def silhouettes(self) -> DataFrame:
        """(_setting, silhouette0, silhouette1, ... of the feature sets) of every setting with clusters."""
        sizes = {r[0]: r[1] for r in self._clusters().groupBy("_setting").agg(F.count(F.lit(1))).collect()}  # a row per setting
        room = BROADCAST_SUMS // (8 * (sum(self.sizes) + 3 * len(self.sizes)))
        parts = [self._silhouettes(group) for group in _batched(sizes, room)] or [self._silhouettes([])]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    def _silhouettes(self, group: list) -> DataFrame:
        """Of some settings: a task holds the sums of all their clusters and finds its rows'
        distances to them as a product of matrices."""
        sizes, settings = self.sizes, self.settings
        table: dict = {j: [] for j in group}
        for r in self._clusters().where(F.col("_setting").isin(group)).collect():
            table[r["_setting"]].append(r)
        shipped = self.wide.sparkSession.sparkContext.broadcast([
            (j, np.array([r["_l"] for r in mine], np.int64), np.array([r["n"] for r in mine], float),
             [(np.array([r[f"s{k}"] for r in mine], float).reshape(-1, size), np.array([r[f"q{k}"] for r in mine], float))
              for k, size in enumerate(sizes)])
            for j in group for mine in [sorted(table[j], key=lambda r: r["_l"])]])
        names = [f"{c}{k}" for k in range(len(sizes)) for c in "tk"]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            clusters = shipped.value
            total, count = np.zeros((len(sizes), len(clusters))), np.zeros((len(sizes), len(clusters)), np.int64)
            for xs, labels, known in _some_rows(batches, sizes, settings, max((len(c[1]) for c in clusters), default=1)):
                squares, whole = [(x * x).sum(1) for x in xs], [~np.isnan(x).any(axis=1) for x in xs]
                for at, (j, own, n, sums) in enumerate(clusters):
                    if len(own) < 2:
                        continue
                    place = np.minimum(np.searchsorted(own, labels[:, j]), len(own) - 1)
                    rows = np.flatnonzero(known[:, j] & (own[place] == labels[:, j]))  # without noise
                    if not len(rows):
                        continue
                    mine = place[rows]
                    members, turn = n[mine], np.arange(len(rows))
                    for k, (s, q) in enumerate(sums):
                        far = xs[k][rows] @ (-2 * s.T)
                        far += squares[k][rows][:, None] * n
                        far += q
                        np.maximum(far, 0.0, out=far)
                        with np.errstate(all="ignore"):
                            a = far[turn, mine] / (members - 1)
                            far /= n
                            far[turn, mine] = np.inf
                            b = np.fmin.reduce(far, axis=1)
                            top = np.maximum(a, b)
                            score = np.where((members <= 1) | (top == 0), 0.0, (b - a) / top)
                        good = whole[k][rows]
                        total[k, at] += score[good].sum()
                        count[k, at] += good.sum()
            yield pa.record_batch([pa.array([c[0] for c in clusters], pa.int32()),
                                   *[pa.array(v[k]) for k in range(len(sizes)) for v in (total, count)]], names=["_setting", *names])

        schema = "_setting int, " + ", ".join(f"t{k} double, k{k} long" for k in range(len(sizes)))
        return self.wide.mapInArrow(add, schema).groupBy("_setting").agg(*[
            (F.sum(f"t{k}") / F.nullif(F.sum(f"k{k}"), F.lit(0))).alias(f"silhouette{k}") for k in range(len(sizes))])


def _batched(sizes: dict, most: int) -> list[list]:
    """The settings in lists of at most ``most`` clusters together; a setting with more
    has a list of its own."""
    out, room = [], 0
    for name in sorted(sizes, key=str):
        if not out or sizes[name] > room:
            out.append([])
            room = most
        out[-1].append(name)
        room -= sizes[name]
    return out


def cluster_summary(df: DataFrame, label: str) -> DataFrame:
    """Number of clusters (noise excluded) and noise share."""
    return df.agg(F.count_distinct(F.when(F.col(label) >= 0, F.col(label))).alias("clusters"),
                  F.avg((F.col(label) == -1).cast("double")).alias("noise_pct"),
                  F.count(F.lit(1)).alias("n"))


def standardised_profile(profile: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Cluster profile → long, each measure z-scored across clusters
    (population std; 0 when the std is 0)."""
    from panelspark.operators.reshape import melt
    long = melt(profile.select(label, *cols), [label], cols, "measure", "value")
    st = long.groupBy("measure").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    return (long.join(st, "measure")
                .select(label, "measure", "value",
                        F.coalesce((F.col("value") - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)),
                                   F.when(F.col("value").isNotNull(), F.lit(0.0))).alias("z")))
