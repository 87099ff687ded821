"""Connected components of an edge DataFrame (used by DBSCAN).

Large-star and small-star steps: a large-star step hangs every larger
neighbour of a node on the smallest of the node and its neighbours, a
small-star step does the same with the smaller neighbours and the node
itself.  Alternating them turns every component into one star around its
smallest node.  The smallest neighbour of each node is a partial aggregate,
so a hub costs nothing there; only the join that brings it back to the
node's edges puts all edges of a node into one task.  That join is split:
the edges of hubs, whose number is bounded by the number of edges over the
size that makes a hub, take their hub's value from a broadcast table of just
those hubs; all other nodes have few edges and are joined by shuffling.

Where no node has that many edges, the smallest neighbour comes from a window over the
node's edges, and a round is one job of three exchanges.

Rounds are distributed jobs on the edge table, which is written with a
reliable checkpoint every round, so a lost executor never replays earlier
rounds and the convergence test reads the checkpoint.  Edges that are stars
already take no round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

#: A node with more edges than this many times an even share of a task is a hub, if it
#: has more than HUB_LEAST.
HUB_SHARES, HUB_LEAST = 0.5, 256


def split_join(rows: DataFrame, key: str, table: DataFrame, hub_rows: int) -> DataFrame:
    """``rows`` joined with ``table`` (one row per ``key``, with ``degree``, its number
    of ``rows``): hubs by broadcast, which holds at most rows / hub_rows of them, the others
    by a shuffle."""
    hubs = F.broadcast(table.where(F.col("degree") > hub_rows).drop("degree"))
    few = table.where(F.col("degree") <= hub_rows).drop("degree")
    return rows.join(hubs, key).unionByName(rows.join(hubs.select(key), key, "left_anti").join(few, key))


def _star(neighbours: DataFrame, hub_rows: int, hubs: bool) -> DataFrame:
    """(u, v, m) of (u, v): with the smallest of u and its v; ``hubs``: some u may
    have more than ``hub_rows`` edges."""
    if not hubs:
        return neighbours.withColumn("m", F.least(F.min("v").over(Window.partitionBy("u")), F.col("u")))
    least = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return split_join(neighbours, "u", least, hub_rows)


def _shape(edges: DataFrame) -> tuple[int, int, int, bool]:
    """Of edges (u, v), u > v, each once: their number, the most edges of a node, the most
    smaller neighbours of one, and whether they are stars, each around its smallest node."""
    ends = edges.select("u", F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up")))
    per = ends.groupBy("u").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("degree"))
    r = per.agg(F.sum("up").alias("n"), F.max("degree").alias("degree"), F.max("up").alias("up"),
                F.max((F.col("up") > 0) & (F.col("degree") > 1)).alias("open")).first()
    return r["n"] or 0, r["degree"] or 0, r["up"] or 0, not r["open"]


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "id",
                         src: str = "src", dst: str = "dst") -> DataFrame:
    """(node) + directed or undirected edges → (node, component) where the
    component is the smallest node id in it.  Rounds go on until the edges
    are stars."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    u, v = F.col(src).alias("u"), F.col(dst).alias("v")
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()
    pairs = cut_lineage(pairs)  # every edge once, the larger node first
    while True:
        n, degree, up, stars = _shape(pairs)
        if stars:
            break
        hub_rows = max(HUB_LEAST, int(HUB_SHARES * 2 * n / parts))
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, hub_rows, degree > hub_rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if degree > hub_rows:
            large = cut_lineage(large.distinct())
        starred = _star(large, hub_rows, up > hub_rows)  # no node gets more smaller neighbours than it had
        small = starred.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            starred.select("u", F.col("m").alias("v")))
        pairs = cut_lineage(small.where("u > v").distinct())
    roots = pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    ids = nodes.select(F.col(node))
    return ids.join(roots, F.col(node) == F.col("_u"), "left").select(
        node, F.coalesce("_m", node).alias("component"))
