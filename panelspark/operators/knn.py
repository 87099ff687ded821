"""k-nearest-neighbour imputation by great-circle distance.

Definition (per period): *observed* rows have every target column, *missing*
rows have none (partly missing rows are left alone).  Each missing row takes
the inverse-distance weighted mean Σ(v/d)/Σ(1/d) of its ``k`` nearest
observed rows of the same period.  A neighbour at distance 0 would give an
infinite weight; then the mean of the zero-distance neighbours is used.  A
period with fewer than ``k`` observed rows uses all of them; a period with
none leaves its missing rows missing.

Execution is exact without an all-pairs join.  Observed rows are counted in
lat/lon cells of every level at once, each level's cells twice as large as the
last one's, and the counts of every 3×3 block are added up (a pyramid of counts).
They choose each missing row's level before any candidate is joined: the finest
one whose block around the row holds enough observed rows that the ``k`` nearest
are very likely among them, and not many more.  The row then meets the rows of
that block (an equi-join on (period, level, cell)), keeps its ``k`` nearest
(``row_number() <= k`` is planned as a window group limit, so each task trims to
``k`` rows per missing point before the shuffle), and the answer is accepted when
the k-th distance is within the radius that the block is guaranteed to cover.  The
few rows for which it is not go one level up; the coarsest level covers the globe.
The levels start fine enough that no cell holds a large share of the rows, unless
they stand at one place, where no more than ``k`` of them count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.geo import haversine
from panelspark.session import cut_lineage


def _grid(size: float) -> tuple[float, int]:
    """Uniform longitude width (an integer number of columns round the
    globe, so wrapped neighbours are exact) for a latitude cell size."""
    ncols = max(1, int(360.0 // size))
    return 360.0 / ncols, ncols


def _cells(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    width, ncols = _grid(size)
    ci = F.floor((lat + 90.0) / size).cast("int")
    cj = F.pmod(F.floor((lon + 180.0) / width).cast("int"), F.lit(ncols))
    return ci, cj


def _guarantee(lat: Column, lon: Column, size: float) -> Column:
    """Smallest central angle from the point to the outside of its 3×3
    block of cells (radians).  Latitude edges are meridian arcs (capped by
    the distance to the pole, beyond which other longitudes are reachable);
    a longitude edge is a meridian, at angle asin(cos φ · sin Δλ)."""
    width, _ = _grid(size)
    y = lat + 90.0
    x = lon + 180.0
    ci = F.floor(y / size)
    cj = F.floor(x / width)
    south = F.least(y - (ci - 1) * size, y)
    north = F.least((ci + 2) * size - y, 180.0 - y)
    west = x - (cj - 1) * width
    east = (cj + 2) * width - x
    dlat = F.radians(F.least(south, north))
    dlon = F.radians(F.least(F.least(west, east), F.lit(90.0)))
    return F.least(dlat, F.asin(F.cos(F.radians(lat)) * F.sin(dlon)))


def _leveled(lat: Column, lon: Column, sizes: Sequence[float]) -> Column:
    """Array of the (ci, cj) cells of a place on every level."""
    return F.array(*[F.struct(ci.alias("ci"), cj.alias("cj")) for ci, cj in (_cells(lat, lon, s) for s in sizes)])


def _around(sizes: Sequence[float]) -> Column:
    """The 3×3 block of the cell (ci, cj) of level ``lvl``, each cell once; columns wrap
    round the globe."""
    ncols = F.array(*[F.lit(_grid(s)[1]) for s in sizes])[F.col("lvl")]
    block = F.array(*[F.struct((F.col("ci") + a).alias("ci"), F.pmod(F.col("cj") + b, ncols).cast("int").alias("cj"))
                      for a in (-1, 0, 1) for b in (-1, 0, 1)])
    return F.explode(F.array_distinct(block)).alias("c")


def knn_candidates(missing: DataFrame, observed: DataFrame, cols: Sequence[str], k: int,
                   sizes: Sequence[float], period: str) -> DataFrame:
    """Top-k observed candidates for every missing row (period, _mid, lat, lon, lvl) from
    its 3×3 block on its level; returns one row per missing id with the weighted
    values, the candidate count, the k-th distance and the guarantee."""
    tie = F.col("_key") if "_key" in observed.columns else F.col("_oid")
    cells = F.posexplode(_leveled(F.col("lat"), F.col("lon"), sizes)).alias("lvl", "c")
    probe = missing.select(period, "_mid", "lat", "lon", "lvl", _leveled(F.col("lat"), F.col("lon"), sizes)[
        F.col("lvl")].alias("c")).select(period, "_mid", "lat", "lon", "lvl", "c.ci", "c.cj")
    probe = probe.select(period, "_mid", "lat", "lon", "lvl", _around(sizes)).select(
        period, "_mid", "lat", "lon", "lvl", "c.ci", "c.cj")
    obs = observed.select(period, F.col("_oid"), tie.alias("_tie"), F.col("lat").alias("olat"),
                          F.col("lon").alias("olon"), *[F.col(c).alias(f"_v_{c}") for c in cols], cells)
    obs = obs.withColumns({"ci": F.col("c.ci"), "cj": F.col("c.cj")}).drop("c")
    on = [period, "lvl", "ci", "cj"]
    obs = obs.join(probe.select(*on).distinct(), on, "left_semi")  # only cells that are asked for
    pairs = probe.join(obs, on)
    pairs = pairs.withColumn("d", haversine(F.col("lat"), F.col("lon"), F.col("olat"),
                                            F.col("olon")))
    w = Window.partitionBy("_mid").orderBy("d", "_tie", "_oid")
    top = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    zero = F.col("d") == 0
    aggs = [F.count(F.lit(1)).alias("_n"), F.max("d").alias("_kth"),
            F.count_if(zero).alias("_nz"),
            F.sum(F.when(~zero, 1.0 / F.col("d"))).alias("_wsum")]
    for c in cols:
        aggs.append(F.sum(F.when(~zero, F.col(f"_v_{c}") / F.col("d"))).alias(f"_ws_{c}"))
        aggs.append(F.avg(F.when(zero, F.col(f"_v_{c}"))).alias(f"_z_{c}"))
    res = top.groupBy("_mid", "lat", "lon", "lvl").agg(*aggs)
    guard = F.array(*[_guarantee(F.col("lat"), F.col("lon"), s) for s in sizes])[F.col("lvl")]
    return res.select("_mid", "_n", "_kth", guard.alias("_guard"),
                      *[F.when(F.col("_nz") > 0, F.col(f"_z_{c}"))
                         .otherwise(F.col(f"_ws_{c}") / F.col("_wsum")).alias(c) for c in cols])


def _start_cell(observed: DataFrame, k: int, period: str) -> float:
    """First cell size from the densest period: radius holding ``k`` points
    at its mean density, divided by 8 so regions up to 64× denser than the
    mean still finish with few candidates; sparse rows climb the levels.  One small aggregate (a row per period) reaches the driver."""
    dens = (observed.groupBy(period)
                    .agg(F.count(F.lit(1)).alias("n"),
                         ((F.max("lat") - F.min("lat") + 0.01)
                          * (F.max("lon") - F.min("lon") + 0.01)).alias("area"))
                    .select((F.col("n") / F.col("area")).alias("rho"))
                    .agg(F.max("rho")).first()[0])
    if not dens:
        return 180.0
    return float(min(180.0, max(0.001, math.sqrt(k / (math.pi * dens)) / 8)))


#: A block with this many times ``k`` rows very likely holds the k nearest within its
#: guaranteed radius; halvings of the first cell size for places denser than others.
ENOUGH, FINER = 4, 6


def _counts(observed: DataFrame, sizes: Sequence[float], period: str) -> DataFrame:
    """(period, lvl, ci, cj, n): observed rows in the cells of every level."""
    cells = F.posexplode(_leveled(F.col("lat"), F.col("lon"), sizes)).alias("lvl", "c")
    return observed.select(period, cells).groupBy(period, "lvl", F.col("c.ci").alias("ci"), F.col("c.cj").alias("cj")).agg(
        F.count(F.lit(1)).alias("n"))


def _at_levels(todo: DataFrame, counts: DataFrame, sizes: Sequence[float], k: int, period: str) -> DataFrame:
    """``todo`` with ``lvl``, the finest level whose block around the row has enough
    observed rows, or the coarsest."""
    blocks = counts.select(period, "lvl", "n", _around(sizes)).groupBy(
        period, "lvl", F.col("c.ci").alias("ci"), F.col("c.cj").alias("cj")).agg(F.sum("n").alias("n")).where(
        F.col("n") >= ENOUGH * k)
    cells = F.posexplode(_leveled(F.col("lat"), F.col("lon"), sizes)).alias("lvl", "c")
    asked = todo.select(period, "_mid", cells).select(period, "_mid", "lvl", "c.ci", "c.cj")
    first = asked.join(blocks, [period, "lvl", "ci", "cj"]).groupBy("_mid").agg(F.min("lvl").alias("lvl"))
    return todo.join(first, "_mid", "left").withColumn("lvl", F.coalesce("lvl", F.lit(len(sizes) - 1)))


def knn_impute(df: DataFrame, cols: Sequence[str], k: int = 10, period: str = "year",
               key: str = "geoid", lat: str = "lat", lon: str = "lon",
               min_cell: float | None = None) -> DataFrame:
    """Fill rows missing every column of ``cols`` from their ``k`` nearest
    observed rows of the same period (see module doc).  Adds a boolean
    ``imputed`` column."""
    cols = list(cols)
    all_present = F.lit(True)
    all_missing = F.lit(True)
    for c in cols:
        all_present = all_present & F.col(c).isNotNull()
        all_missing = all_missing & F.col(c).isNull()
    geo_ok = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    # rows are told apart by a row number that is fixed before it is used, so
    # several rows of one (key, period) each get their own neighbours
    base = cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()))
    observed = (base.where(all_present & geo_ok)
                    .select(period, F.col("_rid").alias("_oid"), F.col(key).alias("_key"), F.col(lat).alias("lat"),
                            F.col(lon).alias("lon"), *cols))
    # co-located observed rows tie on distance and are taken in id order,
    # so no more than k of them per exact location can ever be chosen:
    # keep those (exact) — a hot spot of identical coordinates shrinks to k
    w = Window.partitionBy(period, "lat", "lon").orderBy("_key", "_oid")
    observed = observed.withColumn("_dup", F.row_number().over(w)).where(F.col("_dup") <= k) \
                       .drop("_dup")
    todo = (base.where(all_missing & geo_ok)
                .select(period, F.col("_rid").alias("_mid"), F.col(lat).alias("lat"),
                        F.col(lon).alias("lon")))
    if min_cell is None:
        min_cell = _start_cell(observed, k, period) / 2 ** FINER
    sizes = []
    s = min_cell
    while s < 180.0:
        sizes.append(s)
        s *= 2
    sizes.append(180.0)
    observed, last = cut_lineage(observed), len(sizes) - 1
    todo = cut_lineage(_at_levels(todo, _counts(observed, sizes, period), sizes, k, period))
    done = []
    while True:
        cand = cut_lineage(knn_candidates(todo, observed, cols, k, sizes, period))
        rows = todo.select("_mid", "lvl")
        ok = (F.col("_n") >= k) & (F.col("_kth") <= F.col("_guard"))
        done.append(cand.join(rows, "_mid").where(ok | (F.col("lvl") == last)).select("_mid", *cols))
        todo = cut_lineage(todo.where(F.col("lvl") < last).join(cand.where(ok).select("_mid"), "_mid", "left_anti")
                           .withColumn("lvl", F.col("lvl") + 1))
        if todo.isEmpty():
            break
    filled = done[0]
    for d in done[1:]:
        filled = filled.unionByName(d)
    filled = filled.select(F.col("_mid").alias("_rid"),
                           *[F.col(c).alias(f"_f_{c}") for c in cols])
    out = base.join(filled, "_rid", "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_f_{c}")).alias(c) if c in cols
                        else F.col(c) for c in df.columns],
                      F.col(f"_f_{cols[0]}").isNotNull().alias("imputed"))
