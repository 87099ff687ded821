"""Exact DBSCAN on two coordinates (J09, K03), for many settings at once,
without an all-pairs join.

Semantics (scikit-learn): the ε-neighbourhood is ``distance ≤ eps`` and
includes the point itself; a core point has at least ``min_samples``
neighbours; clusters are the connected components of core points linked
within ε, numbered by their smallest row id (the order scikit-learn
visits them); a non-core point within ε of a core point joins the
smallest-numbered such cluster; everything else is noise (−1).

Execution.  Points are bucketed into square cells of side
δ = ε / (2√2), so any two points of cells at most one apart (a 3×3 block)
are within ε of each other, and cells four apart never have such points.

* Core points: where a block holds ``min_samples`` points, all points of its
  middle cell are core, by count alone.  Only points of sparse blocks look at
  the cells two and three away, point by point where such a cell is partly
  in reach.  A cell has few sparse cells near it, and those few points, so a
  point takes part in a bounded number of comparisons however dense its cell.
* Clusters: the nodes are cells with core points, not points.  Neighbouring
  ones are linked as they stand; of two cells further apart one core point each
  is compared first.  What is in different components after that is settled
  by halving the cells: of the boxes around the core points of both cells'
  parts only those pairs go on that could still reach and whose own two
  representatives do not, until a pair of points within ε is found or none
  can be.  Two clumps just out of reach never produce their pairs.
* Border points are in sparse blocks, so the pairs that counted them are all
  the pairs they need.

Every step carries the setting in its keys: ``dbscan_many`` runs a whole
search in the jobs of one run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.components import connected_components
from panelspark.operators.windows import ordinal
from panelspark.session import cut_lineage

RING = 3
_TOL = 1e-9
#: Parts of a cell's side at each halving of undecided cells.
SPLIT = 4


def _gap(a, lo, hi):
    """Distance from coordinate ``a`` to the interval."""
    return F.greatest(lo - a, F.lit(0.0), a - hi)


def _probe(pts: DataFrame, least: int = 0) -> DataFrame:
    """(point, neighbour cell, kind) for the cells that are not out of reach and at
    least ``least`` away."""
    offs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                     for a in range(-RING, RING + 1) for b in range(-RING, RING + 1) if max(abs(a), abs(b)) >= least])
    p = pts.select("e", "eps", "delta", "id", "x", "y", "cx", "cy", F.explode(offs).alias("o"))
    p = p.select("e", "eps", "id", "x", "y", "delta", (F.col("cx") + F.col("o.a")).alias("ncx"),
                 (F.col("cy") + F.col("o.b")).alias("ncy"))
    delta = F.col("delta")
    lo_x, lo_y = F.col("ncx") * delta, F.col("ncy") * delta
    hi_x, hi_y = lo_x + delta, lo_y + delta
    near = F.pow(_gap(F.col("x"), lo_x, hi_x), 2) + F.pow(_gap(F.col("y"), lo_y, hi_y), 2)
    far = (F.pow(F.greatest(F.abs(F.col("x") - lo_x), F.abs(F.col("x") - hi_x)), 2)
           + F.pow(F.greatest(F.abs(F.col("y") - lo_y), F.abs(F.col("y") - hi_y)), 2))
    e2 = F.col("eps") * F.col("eps")
    kind = (F.when(far <= e2 * (1 - _TOL), "inside")
             .when(near > e2 * (1 + _TOL), "outside").otherwise("partial"))
    return p.withColumn("kind", kind).where(F.col("kind") != "outside")


def _within(ax, ay, bx, by, eps):
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy <= eps * eps


def _points(df: DataFrame, epses: Sequence[float], id_col: str, x: str, y: str) -> DataFrame:
    """(e, eps, delta, id, x, y, cx, cy): every point under every ε."""
    grid = F.explode(F.array(*[F.struct(F.lit(k).alias("e"), F.lit(float(v)).alias("eps"),
                                        F.lit(float(v) / (2 * math.sqrt(2))).alias("delta"))
                               for k, v in enumerate(epses)])).alias("s")
    pts = df.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), grid)
    pts = pts.select("s.e", "s.eps", "s.delta", "id", "x", "y")
    return pts.withColumns({"cx": F.floor(F.col("x") / F.col("delta")), "cy": F.floor(F.col("y") / F.col("delta"))})


def _cell(df: DataFrame, *more) -> DataFrame:
    return df.select("e", F.col("cx").alias("ncx"), F.col("cy").alias("ncy"), *more)


def eps_degree(df: DataFrame, eps: float, id_col: str = "id", x: str = "x", y: str = "y"
               ) -> DataFrame:
    """Number of points within ``eps`` of each point (itself
    included), from whole cells' counts plus exact partial-cell checks."""
    pts = _points(df, [eps], id_col, x, y)
    probe = _probe(pts)
    cells = _cell(pts.groupBy("e", "cx", "cy").agg(F.count(F.lit(1)).alias("n")), "n")
    inside = probe.where(F.col("kind") == "inside").join(cells, ["e", "ncx", "ncy"]).groupBy("id").agg(
        F.sum("n").alias("deg_in"))
    other = _cell(pts, F.col("x").alias("ox"), F.col("y").alias("oy"))
    part = probe.where(F.col("kind") == "partial").join(other, ["e", "ncx", "ncy"]).where(
        _within("x", "y", "ox", "oy", F.col("eps"))).groupBy("id").agg(F.count(F.lit(1)).alias("deg_part"))
    return (pts.select("id").join(inside, "id", "left").join(part, "id", "left")
            .select(F.col("id").alias(id_col), (F.coalesce("deg_in", F.lit(0)) + F.coalesce("deg_part", F.lit(0))).alias("degree")))


def dbscan(df: DataFrame, eps: float, min_samples: int, id_col: str = "id", x: str = "x",
           y: str = "y") -> DataFrame:
    """Labels every row: (id, label, is_core).  Noise = −1."""
    return dbscan_many(df, [eps], [min_samples], id_col, x, y).select(id_col, "label", "is_core")


def dbscan_many(df: DataFrame, epses: Sequence[float], min_samples: Sequence[int], id_col: str = "id", x: str = "x",
                y: str = "y") -> DataFrame:
    """(eps, min_samples, id, label, is_core) of every row under every setting."""
    each = _labelled(df, epses, min_samples, id_col, x, y).select("eps", "id", F.explode("at").alias("s"))
    return each.select("eps", F.col("s.m").alias("min_samples"), F.col("id").alias(id_col), "s.label", "s.is_core")


def dbscan_grid(df: DataFrame, epses: Sequence[float], min_samples: Sequence[int], id_col: str = "id", x: str = "x",
                y: str = "y") -> DataFrame:
    """(id, labels): one row per point with its labels under all settings, min_samples
    by min_samples within eps by eps."""
    each = _labelled(df, epses, min_samples, id_col, x, y).select("e", "id", F.col("at.label").alias("labels"))
    per = each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("e", "labels"))).alias("s"))
    return per.select(F.col("id").alias(id_col), F.flatten("s.labels").alias("labels"))


def _labelled(df: DataFrame, epses: Sequence[float], min_samples: Sequence[int], id_col: str, x: str, y: str) -> DataFrame:
    """(e, eps, id, at): every point under every ε, with (m, label, is_core) for each min_samples."""
    pts = _points(df, epses, id_col, x, y)
    cells = pts.groupBy("e", "cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    # points of the 3×3 block around each cell
    block = _cell(cells, "n").select("e", F.explode(_offsets(1)).alias("o"), "ncx", "ncy", "n").select(
        "e", (F.col("ncx") + F.col("o.a")).alias("cx"), (F.col("ncy") + F.col("o.b")).alias("cy"), "n").groupBy(
        "e", "cx", "cy").agg(F.sum("n").alias("n3"))
    pts = cut_lineage(pts.join(block, ["e", "cx", "cy"]))
    sparse = pts.where(F.col("n3") < max(min_samples))
    probe = cut_lineage(_probe(sparse, 2))
    inside = probe.where(F.col("kind") == "inside").select("e", "id", "ncx", "ncy")
    other = _cell(pts, F.col("id").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("n3").alias("on3"))
    pairs = cut_lineage(probe.where(F.col("kind") == "partial").join(other, ["e", "ncx", "ncy"]).where(
        _within("x", "y", "ox", "oy", F.col("eps"))).select("e", "id", "oid", "on3", "ncx", "ncy"))
    further = inside.join(_cell(cells, "n"), ["e", "ncx", "ncy"]).select("e", "id", "n").unionByName(
        pairs.select("e", "id", F.lit(1).cast("long").alias("n"))).groupBy("e", "id").agg(F.sum("n").alias("more"))
    # exact where a block is sparse; elsewhere at least the greatest min_samples
    pts = cut_lineage(pts.join(further, ["e", "id"], "left").withColumn(
        "degree", F.col("n3") + F.coalesce("more", F.lit(0))).drop("more"))
    settings = F.explode(F.array(*[F.lit(int(m)) for m in min_samples])).alias("m")
    each = pts.select("*", settings).withColumn("is_core", F.col("degree") >= F.col("m"))
    cores = each.where("is_core")
    nodes = cores.groupBy("e", "m", "cx", "cy").agg(
        F.min("id").alias("first"), F.min(F.struct("x", "y")).alias("p"), F.first("eps").alias("eps"),
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    nodes = cut_lineage(ordinal(nodes, ["e", "m", "first"], "node"))
    parts = _clusters(nodes, cores)
    # numbered by smallest id within each setting
    firsts = parts.groupBy("e", "m", "component").agg(F.min("first").alias("first"))
    ranks = ordinal(firsts, ["e", "m", "first"], "k")
    ranks = cut_lineage(ranks)
    start = ranks.groupBy("e", "m").agg(F.min("k").alias("k0"))
    named = ranks.join(F.broadcast(start), ["e", "m"]).select(  # a row per setting
        "e", "m", "component", (F.col("k") - F.col("k0")).cast("int").alias("label"))
    label = cut_lineage(parts.join(named, ["e", "m", "component"]).select("e", "m", "cx", "cy", "label"))
    # a label a column and min_samples: a point meets its cells once, not once a setting
    least = [int(m) for m in min_samples]
    ls = [f"l{k}" for k in range(len(least))]
    label = cut_lineage(label.groupBy("e", "cx", "cy").agg(
        *[F.min(F.when(F.col("m") == m, F.col("label"))).alias(c) for c, m in zip(ls, least)]))
    block = label.select("e", F.explode(_offsets(1)).alias("o"), "cx", "cy", *ls).select(
        "e", (F.col("cx") + F.col("o.a")).alias("cx"), (F.col("cy") + F.col("o.b")).alias("cy"), *ls).groupBy(
        "e", "cx", "cy").agg(*[F.min(c).alias(f"near_{c}") for c in ls])
    border = _border(label, ls, least, inside, pairs, pts).toDF("e", "id", *[f"border_{c}" for c in ls])
    cell = ["e", "cx", "cy"]
    out = pts.select("e", "eps", "id", "cx", "cy", "degree").join(label, cell, "left").join(block, cell, "left").join(
        border, ["e", "id"], "left")

    def at(c: str, m: int):
        core = F.col("degree") >= F.lit(m)
        found = F.when(core, F.col(c)).otherwise(F.least(f"near_{c}", f"border_{c}"))
        return F.struct(F.lit(m).alias("m"), F.coalesce(found, F.lit(-1)).cast("int").alias("label"), core.alias("is_core"))

    return out.select("e", "eps", "id", F.array(*[at(c, m) for c, m in zip(ls, least)]).alias("at"))


def _offsets(ring: int):
    return F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                     for a in range(-ring, ring + 1) for b in range(-ring, ring + 1)])


def _clusters(nodes: DataFrame, cores: DataFrame) -> DataFrame:
    """``nodes`` (cells with core points) with their component."""
    ahead = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                      for a in range(0, RING + 1) for b in range(-RING, RING + 1) if (a, b) > (0, 0)])
    a = nodes.select("e", "m", "eps", F.col("node").alias("a"), F.col("p").alias("pa"), *_box("a"), "cx", "cy",
                     F.explode(ahead).alias("o"))
    a = a.withColumns({"ncx": F.col("cx") + F.col("o.a"), "ncy": F.col("cy") + F.col("o.b"),
                       "touch": F.greatest(F.abs("o.a"), F.abs("o.b")) <= 1}).drop("o", "cx", "cy")
    b = nodes.select("e", "m", F.col("cx").alias("ncx"), F.col("cy").alias("ncy"), F.col("node").alias("b"),
                     F.col("p").alias("pb"), *_box("b"))
    both = a.join(b, ["e", "m", "ncx", "ncy"]).where(F.col("touch") | _boxes_reach())
    both = cut_lineage(both.withColumn("linked", F.col("touch") | _within("pa.x", "pa.y", "pb.x", "pb.y", F.col("eps")))
                       .select("e", "m", "eps", "a", "b", "linked"))
    parts = cut_lineage(connected_components(nodes, both.where("linked"), "node", "a", "b"))
    of = parts.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    side = lambda k: of.select(F.col("_n").alias(k), F.col("_c").alias(f"c{k}"))
    open_ = cut_lineage(both.where(~F.col("linked")).join(side("a"), "a").join(side("b"), "b").where("ca <> cb").select(
        "eps", "a", "b", "ca", "cb"))
    links = _settled(open_, nodes, cores)
    if links is not None:
        whole = connected_components(parts.select("component").distinct(), links, "component", "ca", "cb").toDF("component", "_w")
        parts = parts.join(whole, "component").select("node", F.col("_w").alias("component"))
    return nodes.join(parts, "node").select("e", "m", "cx", "cy", "first", "component")


def _box(k: str) -> list:
    return [F.col(c).alias(c + k) for c in ("x0", "x1", "y0", "y1")]


def _boxes_reach():
    dx = F.greatest(F.col("x0a") - F.col("x1b"), F.lit(0.0), F.col("x0b") - F.col("x1a"))
    dy = F.greatest(F.col("y0a") - F.col("y1b"), F.lit(0.0), F.col("y0b") - F.col("y1a"))
    return dx * dx + dy * dy <= F.col("eps") * F.col("eps")


def _settled(open_: DataFrame, nodes: DataFrame, cores: DataFrame) -> DataFrame | None:
    """(ca, cb) of the pairs of components that a pair of core points links, from pairs of
    cells in question; None if there are none.  Each turn cuts both cells' boxes."""
    if open_.isEmpty():
        return None
    cells = open_.select(F.col("a").alias("node")).union(open_.select("b")).distinct()
    keep = cut_lineage(cores.join(nodes.join(cells, "node", "left_semi").select("e", "m", "cx", "cy", "node", *_box("")),
                                  ["e", "m", "cx", "cy"]).select("node", "x", "y", *_box("")).withColumn(
        "box", F.col("node")))
    links, pairs = None, open_.select("eps", "ca", "cb", F.col("a").alias("boxa"), F.col("b").alias("boxb"))
    while True:
        # each box's points fall into SPLIT × SPLIT smaller ones, which shrink to their points
        at = lambda v, lo, hi: F.least(F.lit(SPLIT - 1), F.floor(
            SPLIT * F.coalesce((F.col(v) - F.col(lo)) / F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)), F.lit(0.0))))
        keep = keep.withColumn("sub", at("x", "x0", "x1") * SPLIT + at("y", "y0", "y1"))
        boxes = keep.groupBy("box", "sub").agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
            F.min(F.struct("x", "y")).alias("p")).withColumn("next", F.xxhash64("box", "sub"))
        boxes = cut_lineage(boxes)
        side = lambda k: boxes.select(F.col("box").alias(f"box{k}"), F.col("next").alias(f"next{k}"),
                                      F.col("p").alias(f"p{k}"), *_box(k))
        both = pairs.join(side("a"), "boxa").join(side("b"), "boxb").where(_boxes_reach())
        both = cut_lineage(both.withColumn("linked", _within("pa.x", "pa.y", "pb.x", "pb.y", F.col("eps"))).select(
            "eps", "ca", "cb", F.col("nexta").alias("boxa"), F.col("nextb").alias("boxb"), "linked"))
        found = cut_lineage(both.where("linked").select("ca", "cb").distinct())
        links = found if links is None else links.unionByName(found)
        pairs = cut_lineage(both.where(~F.col("linked")).join(found, ["ca", "cb"], "left_anti").select(
            "eps", "ca", "cb", "boxa", "boxb").distinct())
        if pairs.isEmpty():
            return links
        left = pairs.select(F.col("boxa").alias("next")).union(pairs.select("boxb")).distinct()
        keep = cut_lineage(keep.select("x", "y", "box", "sub").join(boxes.join(left, "next", "left_semi").select(
            "box", "sub", "next", *_box("")), ["box", "sub"]).select("x", "y", F.col("next").alias("box"), *_box("")))


def _border(label: DataFrame, ls: Sequence[str], least: Sequence[int], inside: DataFrame, pairs: DataFrame,
            pts: DataFrame) -> DataFrame:
    """(e, id, a column for each of ``ls``): the smallest label among the core points within ε
    of the points in sparse blocks, and outside these blocks."""
    near = _cell(label, *ls)
    there = inside.join(near, ["e", "ncx", "ncy"]).select("e", "id", *ls)
    degree = pts.select("e", F.col("id").alias("oid"), F.col("degree").alias("od"))
    single = pairs.join(degree, ["e", "oid"]).where(F.col("od") >= min(least)).join(near, ["e", "ncx", "ncy"]).select(
        "e", "id", *[F.when(F.col("od") >= m, F.col(c)).alias(c) for c, m in zip(ls, least)])
    return there.unionByName(single).groupBy("e", "id").agg(*[F.min(c).alias(c) for c in ls])
